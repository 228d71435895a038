"""URL filters: a temporal list join.

Dated entries for domains become validity intervals; captures are judged as of their fetch time by
the entry, of those active then, for the longest suffix of their host. Hosts are judged once a fetch
time, so that a host with a third of the captures is a few rows in the join with the list.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)"


def validity_intervals(entries: DataFrame) -> DataFrame:
    """domain, action, valid_from, valid_to (exclusive, null: still valid) from dated entries domain, action, dated.

    An entry holds until the domain's next one. Of several of one domain and date the least action counts
    ('allow' before 'block'); entries with nulls are left out.
    """
    clean = entries.where("domain IS NOT NULL AND action IS NOT NULL AND dated IS NOT NULL").groupBy(F.lower("domain").alias("domain"), "dated").agg(F.min("action").alias("action"))
    return clean.selectExpr("domain", "action", "dated AS valid_from", "lead(dated) OVER (PARTITION BY domain ORDER BY dated) AS valid_to")


#: Days of the buckets that intervals and fetch times are joined in, so that only entries of about its time meet a capture.
BUCKET_DAYS = 64


def filter_captures(captures: DataFrame, entries: DataFrame, url_col: str = "url", time_col: str = "fetched") -> DataFrame:
    """``captures``, every column, with host, matched_domain, action and blocked, as of ``time_col``.

    A URL without a host, a null URL or a null time matches nothing and isn't blocked; repeated rows are each judged. A new
    column whose name the captures have already is called so with ``url_`` before it. An empty table gives an empty one.
    """
    rows = captures.select(F.struct("*").alias("row"), F.expr(f"lower(nullif(rtrim('.', regexp_extract(`{url_col}`, r'{HOST}', 1)), ''))").alias("host"), F.col(time_col).alias("at"))
    distinct = rows.where("host IS NOT NULL AND at IS NOT NULL").select("host", "at").distinct()
    bucket = f"unix_date(CAST({{}} AS DATE)) DIV {BUCKET_DAYS}"
    suffixes = distinct.selectExpr("host AS of_host", "at AS of_at", f"{bucket.format('at')} AS bucket", "explode(transform(sequence(1, size(split(host, r'\\.'))), k -> substring_index(host, '.', -k))) AS domain")
    ends = distinct.selectExpr(f"min({bucket.format('at')}) AS least", f"max({bucket.format('at')}) AS most")
    held = validity_intervals(entries).join(F.broadcast(ends)).selectExpr("*", f"greatest(least, {bucket.format('valid_from')}) AS since", f"least(most, coalesce({bucket.format('valid_to')}, most)) AS till")
    listed = held.where("since <= till").selectExpr("domain", "action", "valid_from", "valid_to", "explode(sequence(since, till)) AS bucket")
    active = suffixes.join(listed, ["domain", "bucket"]).where("of_at >= valid_from AND (valid_to IS NULL OR of_at < valid_to)")
    judged = active.groupBy("of_host", "of_at").agg(F.expr("max_by(struct(domain, action), length(domain))").alias("hit"))
    joined = rows.join(judged, F.expr("host = of_host AND at = of_at"), "left")
    taken = {c.lower() for c in captures.columns}
    new = {"host": F.col("host"), "matched_domain": F.col("hit.domain"), "action": F.col("hit.action"), "blocked": F.expr("coalesce(hit.action = 'block', FALSE)")}
    return joined.select(*(F.col("row").getField(c).alias(c) for c in captures.columns), *(column.alias(f"url_{n}" if n in taken else n) for n, column in new.items()))

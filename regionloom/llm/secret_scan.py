"""Secret scans with multipart credential linking, in SQL functions only.

Base spans stand alone: assignments, access ids, long hexadecimal runs. Weak candidates (other
access ids, bare 40-character secrets, endpoints) count only where the complementary parts of a
credential lie within the same scope: parts are dealt to scopes and joined on document, scope
and distance, so that a join meets only the few parts that fit into a scope.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regionloom.llm.common import packed_rows, unpacked

#: Fixed patterns, in the order in which kinds are listed.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
WEAK_ACCESS = r"(?<![A-Za-z0-9])(?:ABIA|ACCA|AIDA|AROA|ASIA)[A-Z0-9]{12,}"
#: May follow "=", as in KEY=value, but not end before it: that is padding.
WEAK_SECRET = r"(?<![A-Za-z0-9+/])[A-Za-z0-9+/]{40}(?![A-Za-z0-9+/=])"
#: What a bare 40-character secret must have besides.
MIXED = "m RLIKE '[0-9]' AND m RLIKE '[A-Z]' AND m RLIKE '[a-z]'"
ENDPOINT = r"""https?://[^\s"'<>]+"""
KINDS = ("assign", "access", "hex", "weak_access", "weak_secret", "endpoint")
ROLES = {"assign": "secret", "access": "id", "hex": "secret", "weak_access": "id", "weak_secret": "secret", "endpoint": "endpoint"}
LEAST_VALUE = 8
#: Code points within which the parts of a credential belong together.
SCOPE = 400
REDACTED = "[secret]"

_SPAN = "array<struct<start:bigint,kind:int,end:bigint>>"
_RUN = "array<struct<start:bigint,end:bigint>>"
#: Items that one fold appends to an array, which copies it: long arrays are folded in chunks, so that time grows in proportion.
CHUNK = 64


def _bound(value: str, name: str, body: str) -> str:
    """SQL for ``body`` with the value worked out once under a name."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _chunks(items: str) -> str:
    return f"transform(sequence(0, greatest(0, (size({items}) - 1) DIV {CHUNK})), i -> slice({items}, i * {CHUNK} + 1, {CHUNK}))"


def _spans(pattern: str, kind: int, text: str, value_group: int | None = None, also: str | None = None) -> str:
    """SQL for the spans of a pattern's matches, in code points: gaps between and lengths of the matches added up."""
    p = "r'" + pattern.replace("'", "\\x27") + "'"
    hits = f"zip_with(split({text}, {p}, -1), regexp_extract_all({text}, {p}, 0), (g, m) -> struct(length(g) AS gap, length(m) AS size, {also or 'TRUE'} AS also))"
    keep = "h.also"
    if value_group is not None:
        hits = f"zip_with({hits}, regexp_extract_all({text}, {p}, {value_group}), (h, v) -> struct(h.gap AS gap, h.size AS size, length(v) AS value))"
        keep = f"h.value >= {LEAST_VALUE}"
    step = f"struct(a.at + h.gap + h.size AS at, IF({keep}, array_append(a.found, struct(a.at + h.gap AS start, {kind} AS kind, a.at + h.gap + h.size AS end)), a.found) AS found)"
    inner = f"aggregate(c, struct(s.at AS at, CAST(array() AS {_SPAN}) AS found), (a, h) -> {step})"
    outer = f"aggregate({_chunks('hs')}, struct(0L AS at, CAST(array() AS array<{_SPAN}>) AS found), (s, c) -> {_bound(inner, 'n', 'struct(n.at AS at, array_append(s.found, n.found) AS found)')}, s -> flatten(s.found))"
    return f"CASE WHEN {text} RLIKE {p} THEN {_bound(f'filter({hits}, h -> h.size IS NOT NULL)', 'hs', outer)} ELSE CAST(array() AS {_SPAN}) END"


def find_spans(rows: DataFrame) -> DataFrame:
    """``rows`` (with txt) and base (spans of assign, access and hex) and weak (candidates), each by start."""
    base = [_spans(ASSIGN, 0, "txt", 2), _spans(ACCESS, 1, "txt"), _spans(HEX, 2, "txt")]
    weak = [_spans(WEAK_ACCESS, 3, "txt"), _spans(WEAK_SECRET, 4, "txt", also=MIXED), _spans(ENDPOINT, 5, "txt")]
    return rows.selectExpr("*", f"array_sort(concat({', '.join(base)})) AS base", f"array_sort(concat({', '.join(weak)})) AS weak")


def link_parts(parts: DataFrame, keys: list[str]) -> DataFrame:
    """The weak parts that have their complement within SCOPE: keys and span.

    parts: keys and span (start, kind, end). An id needs a secret, a secret needs an id, an endpoint needs both.
    """
    roles = "CASE span.kind " + " ".join(f"WHEN {k} THEN '{ROLES[kind]}'" for k, kind in enumerate(KINDS)) + " END"
    dealt = parts.selectExpr(*keys, "span", f"{roles} AS role", f"span.start DIV {SCOPE} AS scope")
    weak = dealt.where("span.kind >= 3").selectExpr(*keys, "span", "role", "explode(array(scope - 1, scope, scope + 1)) AS scope")
    others = dealt.where("role <> 'endpoint'").selectExpr(*keys, "span.start AS other_start", "role AS other_role", "scope")
    near = weak.join(others, [*keys, "scope"]).where(f"abs(span.start - other_start) <= {SCOPE} AND role <> other_role")
    seen = near.groupBy(*keys, "span", "role").agg(F.bool_or(F.expr("other_role = 'id'")).alias("ids"), F.bool_or(F.expr("other_role = 'secret'")).alias("secrets"))
    return seen.where("CASE role WHEN 'id' THEN secrets WHEN 'secret' THEN ids ELSE ids AND secrets END").select(*keys, "span")


def _scanned(rows: DataFrame) -> DataFrame:
    """``rows`` (row, doc, txt) with base and every (base and linked weak spans by start): arrays of (start, kind, end), ends exclusive."""
    found = find_spans(rows.selectExpr("*", "xxhash64(txt) AS hash"))
    candidates = found.where("size(weak) > 0 AND size(base) + size(weak) > 1").selectExpr("coalesce(doc, -1) AS doc", "hash", "explode(concat(base, weak)) AS span").distinct()
    linked = link_parts(candidates, ["doc", "hash"]).groupBy("doc", "hash").agg(F.collect_list("span").alias("linked")).withColumnsRenamed({"doc": "of_doc", "hash": "of_hash"})
    joined = found.join(linked, F.expr("coalesce(doc, -1) = of_doc AND hash = of_hash"), "left")
    return joined.selectExpr("row", "doc", "txt", "base", "CASE WHEN linked IS NULL THEN base ELSE array_sort(concat(base, linked)) END AS every")


def _joined(spans: str) -> str:
    names = "array(" + ", ".join(f"'{k}'" for k in KINDS) + ")"
    return f"array_join(transform({spans}, s -> concat({names}[s.kind], ':', s.start, ':', s.end)), ',')"


def secret_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256 (of the base spans as kind:start:end) and spans (all, written so).

    Null and empty texts have no spans; the same row again gets the same spans; null ids are kept; an empty table gives
    an empty one. Kinds index KINDS.
    """
    rows = packed_rows(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")))
    counts = {f"n_{kind}": F.expr(f"CAST(size(filter(base, s -> s.kind = {k})) AS BIGINT)") for k, kind in enumerate(KINDS[:3])}
    return _scanned(rows).select(F.col("doc").alias("doc_id"), *(c.alias(n) for n, c in counts.items()), F.expr(f"sha2({_joined('base')}, 256)").alias("base_sha256"), F.expr(_joined("every")).alias("spans"))


def _runs(spans: str) -> str:
    """SQL for the maximal runs that spans in order cover; a run that is open is put aside when the next begins."""
    step = f"IF(s.start <= a.end, struct(a.start AS start, greatest(a.end, s.end) AS end, a.done AS done), struct(s.start AS start, s.end AS end, array_append(a.done, struct(a.start AS start, a.end AS end)) AS done))"
    inner = f"aggregate(c, struct(o.start AS start, o.end AS end, CAST(array() AS {_RUN}) AS done), (a, s) -> {step})"
    kept = "struct(n.start AS start, n.end AS end, array_append(o.done, n.done) AS done)"
    return f"aggregate({_chunks(spans)}, struct({spans}[0].start AS start, {spans}[0].end AS end, CAST(array() AS array<{_RUN}>) AS done), (o, c) -> {_bound(inner, 'n', kept)}, o -> array_append(flatten(o.done), struct(o.start AS start, o.end AS end)))"


def _cut(runs: str, text: str) -> str:
    """SQL for the text with each run replaced; chunks of runs are cut from the part of the text that they lie in."""
    before = f"IF(j = 0 AND i = 0, 0L, {runs}[i * {CHUNK} + j - 1].end)"
    part = f"substring({text}, CAST(IF(i = 0, 0L, {runs}[i * {CHUNK} - 1].end) AS INT) + 1, CAST(element_at(c, -1).start - IF(i = 0, 0L, {runs}[i * {CHUNK} - 1].end) AS INT))"
    offset = f"IF(i = 0, 0L, {runs}[i * {CHUNK} - 1].end)"
    pieces = f"array_join(transform(c, (r, j) -> concat(substring(w, CAST({before} - {offset} AS INT) + 1, CAST(r.start - {before} AS INT)), '{REDACTED}')), '')"
    return f"concat(array_join(transform({_chunks(runs)}, (c, i) -> {_bound(part, 'w', pieces)}), ''), substring({text}, CAST(element_at({runs}, -1).end AS INT) + 1))"


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs``, every column, with every span in the text but endpoints, overlapping ones together, replaced by REDACTED.

    Texts without spans come back as they were, null ones too; repeated rows are each redacted; an empty table gives an empty one.
    """
    found = _scanned(packed_rows(docs, id_col, text_col)).selectExpr("row", "txt", "filter(every, s -> s.kind < 5) AS spans")
    clean = f"IF(size(spans) = 0, txt, {_bound(_runs('spans'), 'runs', _cut('runs', 'txt'))})"
    cleaned = found.selectExpr("row", f"{clean} AS clean", "size(spans) = 0 AS same")
    return unpacked(cleaned, docs.columns, **{text_col: F.expr(f"IF(same, row.`{text_col}`, clean)")})

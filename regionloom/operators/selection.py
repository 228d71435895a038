"""Dropping, choosing and naming of boxes by windows and joins within pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regionloom.functions import boxes as B
from regionloom.operators.joins import cell_join

_CLASH = "2 * ({i}) > a.w * a.h + r.w * r.h - ({i})"
_I = "greatest(least(a.x + a.w, r.x + r.w) - greatest(a.x, r.x), 0) * greatest(least(a.y + a.h, r.y + r.h) - greatest(a.y, r.y), 0)"


def without_unions(boxes: DataFrame, keys: list[str], tenths: int = 8, least: int = 2) -> DataFrame:
    """Without boxes that cover ``tenths`` / 10 or more of ``least`` or more smaller boxes with the same keys."""
    part = boxes.select(*keys, "pos", "x", "y", "w", "h")
    covered = (F.expr("r_w * r_h < l_w * l_h")) & (10 * B.intersection(B.box("l_"), B.box("r_")) >= tenths * F.expr("r_w * r_h"))
    unions = cell_join(part, part, keys, covered).groupBy(*keys, F.col("l_pos").alias("pos")).agg(F.count("*").alias("n")).where(F.col("n") >= least)
    return boxes.join(unions.drop("n"), [*keys, "pos"], "left_anti")


def without_area_outliers(boxes: DataFrame, keys: list[str], least: int = 5, times: int = 4) -> DataFrame:
    """Without boxes of over ``times`` the median area of their keys, where those have ``least`` boxes or more and a median above 0."""
    stats = boxes.groupBy(*keys).agg(F.count("*").alias("_n"), F.median(F.expr("w * h")).alias("_mid"))
    return boxes.join(stats, keys).where(f"NOT (_n >= {least} AND _mid > 0 AND w * h > {times} * _mid)").drop("_n", "_mid")


def first_by(rows: DataFrame, keys: list[str], order: list[Column | str], n: int = 1) -> DataFrame:
    """The first ``n`` rows of each key in a stated order; a limit as the feature."""
    from pyspark.sql import Window

    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("_n") <= n).drop("_n")


def numbered_names(rows: DataFrame, kind: str, zone: str, order: list[str]) -> DataFrame:
    """``rows`` with name: '<kind> - <zone> - NN', counted within kind and zone over all pages."""
    return rows.selectExpr("*", f"format_string('%s - %s - %02d', {kind}, {zone}, row_number() OVER (PARTITION BY {kind}, {zone} ORDER BY {', '.join(order)})) AS name")


def merged_intervals(rows: DataFrame, keys: list[str], start: str, end: str, gap: int) -> DataFrame:
    """keys, start, end, parts: intervals with a gap of at most ``gap`` to what lies before them are one.

    Both windows name the same columns, so rows are sorted once and equal intervals can't change places in between.
    """
    by = ", ".join(keys)
    order = f"PARTITION BY {by} ORDER BY start NULLS LAST, end NULLS LAST ROWS"
    named = rows.selectExpr(*keys, f"{start} AS start", f"{end} AS end")
    marked = named.selectExpr("*", f"max(end) OVER ({order} BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before")
    runs = marked.selectExpr("*", f"sum(IF(start <= before + {gap}, 0, 1)) OVER ({order} UNBOUNDED PRECEDING) AS run")
    return runs.groupBy(*keys, "run").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.count("*").alias("parts")).drop("run")


def resolve_overlaps(boxes: DataFrame, keys: list[str], exempt: Column) -> DataFrame:
    """keys, pos of the boxes that stay when pairs are gone through by pos: above IoU .5 the less confident goes, on ties the later.

    A box that goes ends its own comparisons. Exempt boxes neither go nor drop others. A page is one row.
    """
    items = F.array_sort(F.collect_list(F.struct("pos", "x", "y", "w", "h", "conf_milli", exempt.alias("exempt"))))
    inner = f"aggregate(filter(items, r -> r.pos > a.pos AND NOT r.exempt), struct(dead AS dead, FALSE AS gone), (s, r) -> CASE WHEN s.gone OR array_contains(s.dead, r.pos) OR NOT ({_CLASH.format(i=_I)}) THEN s WHEN a.conf_milli >= r.conf_milli THEN struct(array_append(s.dead, r.pos) AS dead, FALSE AS gone) ELSE struct(array_append(s.dead, a.pos) AS dead, TRUE AS gone) END).dead"
    fold = f"aggregate(items, CAST(array() AS array<bigint>), (dead, a) -> IF(a.exempt OR array_contains(dead, a.pos), dead, {inner}))"
    gone = boxes.groupBy(*keys).agg(items.alias("items")).selectExpr(*keys, "items", f"{fold} AS dead")
    return gone.selectExpr(*keys, "explode(array_except(transform(items, i -> i.pos), dead)) AS pos")


def hold_one_out(scores: DataFrame) -> DataFrame:
    """document, chosen, located, predictions: each document's score under the candidate chosen on all others.

    scores: document, candidate (0 is the default), located, predictions. On the others a candidate's precision mustn't fall
    below the default's (compared crosswise, without division); of those the one that locates most is chosen, the first on ties.
    """
    totals = scores.groupBy("candidate").agg(F.sum("located").alias("all_l"), F.sum("predictions").alias("all_p"))
    rest = scores.join(totals, "candidate").selectExpr("document", "candidate", "located", "predictions", "all_l - located AS l", "all_p - predictions AS p")
    base = rest.where("candidate = 0").selectExpr("document", "l AS l0", "p AS p0")
    fit = rest.join(base, "document").where("l * p0 >= l0 * p")
    best = F.min_by(F.struct("candidate", "located", "predictions"), F.struct(-F.col("l"), "candidate"))
    return fit.groupBy("document").agg(best.alias("b")).selectExpr("document", "b.candidate AS chosen", "b.located", "b.predictions")


def resolved_by_context(rows: DataFrame, group: list[str], kind: str, ambiguous: dict[str, str]) -> DataFrame:
    """``rows`` with ``resolved``: an ambiguous class takes its other class where a row of the group carries that on its own."""
    out = F.col(kind)
    for name, target in ambiguous.items():
        there = F.bool_or((F.col(kind) == target) & ~F.col(kind).isin(list(ambiguous))).over(Window.partitionBy(*group))
        out = F.when((F.col(kind) == name) & there, F.lit(target)).otherwise(out)
    return rows.withColumn("resolved", out)


def deficit_split(sizes: DataFrame, group: str, size: str, ratios: tuple[int, int, int], pinned: list | None = None) -> DataFrame:
    """The groups and their split: train, val or test.

    Pinned groups are for the test. The others go, the largest first (of equal ones the smaller key), whole, to the split
    that lacks most items of its share; of equal lacks to the first. Choices hang on all before them, so the table of
    group sizes, not that of items, is folded in one row. An empty table gives an empty one.
    """
    is_pinned = F.col(group).isin(pinned or [])
    whole = sum(ratios)
    all_sizes = sizes.select(F.col(group).alias("g"), F.col(size).cast("long").alias("n"), is_pinned.alias("pinned"))
    row = all_sizes.agg(F.sum("n").alias("t"), F.coalesce(F.sum(F.expr("IF(pinned, n, 0L)")), F.lit(0)).cast("long").alias("p"), F.expr("array_sort(collect_list(IF(pinned, NULL, struct(-n AS n, g))))").alias("gs"))
    lacks = [f"{r} * t - {whole} * s.{c}" for r, c in zip(ratios, "abc", strict=True)]
    step = f"IF({lacks[0]} >= greatest({lacks[1]}, {lacks[2]}), 'train', IF({lacks[1]} >= {lacks[2]}, 'val', 'test'))"
    kind = sizes.schema[group].dataType.simpleString()
    fold = f"aggregate(gs, struct(0L AS a, 0L AS b, p AS c, CAST(array() AS array<struct<g:{kind},split:string>>) AS done), (s, r) -> transform(array({step}), k -> struct(s.a - IF(k = 'train', r.n, 0L) AS a, s.b - IF(k = 'val', r.n, 0L) AS b, s.c - IF(k = 'test', r.n, 0L) AS c, array_append(s.done, struct(r.g AS g, k AS split)) AS done))[0], s -> s.done)"
    dealt = row.selectExpr(f"inline({fold})")
    return dealt.unionByName(all_sizes.where("pinned").selectExpr("g", "'test' AS split")).withColumnRenamed("g", group)

"""Greedy, order-dependent operators: folds over a page's boxes in a stated order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_ITEM = "struct<o:bigint,pos:bigint,x:bigint,y:bigint,w:bigint,h:bigint>"
_INTER = "greatest(least(k.x + k.w, r.x + r.w) - greatest(k.x, r.x), 0) * greatest(least(k.y + k.h, r.y + r.h) - greatest(k.y, r.y), 0)"


def suppress(boxes: DataFrame, keys: list[str], tenths: int = 3, strict: bool = False, order: str = "-conf_milli") -> DataFrame:
    """Greedy non-maximum suppression on each page: keys and pos of the boxes kept.

    Boxes are taken by ``order``, then pos; one goes if its IoU with a kept box is ``tenths`` / 10 or more (or only
    above it, if ``strict``). The test is on whole numbers.
    """
    over = f"10 * ({_INTER}) {'>' if strict else '>='} {tenths} * (k.w * k.h + r.w * r.h - ({_INTER}))"
    items = F.array_sort(F.collect_list(F.expr(f"struct(CAST({order} AS BIGINT) AS o, pos, x, y, w, h)")))
    grouped = boxes.groupBy(*keys).agg(items.alias("items"))
    fold = f"aggregate(items, CAST(array() AS array<{_ITEM}>), (a, r) -> IF(exists(a, k -> {over}), a, array_append(a, r)))"
    return grouped.select(*keys, F.explode(F.expr(fold)).alias("b")).select(*keys, "b.pos")


def match_greedily(pred: DataFrame, gt: DataFrame, keys: list[str], tenths: int = 5) -> DataFrame:
    """One-to-one matches in prediction order: each takes the unmatched ground truth of highest IoU, if ``tenths`` / 10 or more.

    Ties go to the smaller ground-truth pos. keys, pred_pos, gt_pos. IoU is compared as whole millionths.
    """
    a = pred.select(*keys, *(F.col(c).alias(f"a_{c}") for c in ("pos", "x", "y", "w", "h")))
    pairs = a.join(gt.select(*keys, *(F.col(c).alias(f"b_{c}") for c in ("pos", "x", "y", "w", "h"))), keys)
    inter = "greatest(least(a_x + a_w, b_x + b_w) - greatest(a_x, b_x), 0) * greatest(least(a_y + a_h, b_y + b_h) - greatest(a_y, b_y), 0)"
    scored = pairs.withColumn("i", F.expr(inter)).withColumn("u", F.expr("a_w * a_h + b_w * b_h - i")).where(f"10 * i >= {tenths} * u AND i > 0")
    items = F.array_sort(F.collect_list(F.expr("struct(a_pos AS p, -(i * 1000000 DIV u) AS s, b_pos AS g)")))
    fold = "aggregate(items, CAST(array() AS array<struct<p:bigint,s:bigint,g:bigint>>), (a, r) -> IF(exists(a, k -> k.p = r.p OR k.g = r.g), a, array_append(a, r)))"
    return scored.groupBy(*keys).agg(items.alias("items")).select(*keys, F.explode(F.expr(fold)).alias("m")).select(*keys, F.col("m.p").alias("pred_pos"), F.col("m.g").alias("gt_pos"))


def cap_by_budget(rows: DataFrame, keys: list[str], size: str, order: str, budget: int) -> DataFrame:
    """Largest first while the total stays within ``budget``; rows that would overflow are skipped, later ones may still fit."""
    items = F.array_sort(F.collect_list(F.expr(f"struct(-CAST({size} AS BIGINT) AS s, CAST({order} AS BIGINT) AS o)")))
    start = "struct(0L AS total, CAST(array() AS array<bigint>) AS kept)"
    fold = f"aggregate(items, {start}, (a, r) -> IF(a.total - r.s <= {budget}, struct(a.total - r.s AS total, array_append(a.kept, r.o) AS kept), a)).kept"
    return rows.groupBy(*keys).agg(items.alias("items")).select(*keys, F.explode(F.expr(fold)).alias(order))

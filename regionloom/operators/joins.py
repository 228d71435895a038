"""Spatial joins within pages. Cells of a grid make them equi-joins, so that a page of any size spreads out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regionloom.functions import boxes as B

CELL = 256


def _prefixed(df: DataFrame, prefix: str, keys: list[str]) -> DataFrame:
    return df.select(*keys, *(F.col(c).alias(f"{prefix}{c}") for c in df.columns if c not in keys))


def cell_join(left: DataFrame, right: DataFrame, keys: list[str], condition: Column, reach: int = 0, cell: int = CELL) -> DataFrame:
    """Pairs (columns l_*, r_*) of the same keys whose boxes, the left ones inflated by ``reach``, share a grid cell and that hold ``condition``.

    Each pair comes once: in the cell of the larger of both boxes' first cells.
    """

    def cells(prefix: str, grow: int) -> list[Column]:
        return [F.expr(f"sequence((`{prefix}{o}` - {grow} + 1000000) DIV {cell}, (`{prefix}{o}` + `{prefix}{s}` + {grow} + 1000000) DIV {cell})") for o, s in (("x", "w"), ("y", "h"))]

    def dealt(df: DataFrame, prefix: str, grow: int) -> DataFrame:
        cx, cy = cells(prefix, grow)
        wide = _prefixed(df, prefix, keys).withColumns({f"{prefix}cx": cx, f"{prefix}cy": cy})
        wide = wide.withColumn("cx", F.explode(f"{prefix}cx")).withColumn("cy", F.explode(f"{prefix}cy"))
        return wide.withColumns({f"{prefix}cx": F.col(f"{prefix}cx")[0], f"{prefix}cy": F.col(f"{prefix}cy")[0]})

    met = dealt(left, "l_", reach).join(dealt(right, "r_", 0), [*keys, "cx", "cy"])
    once = (F.col("cx") == F.greatest("l_cx", "r_cx")) & (F.col("cy") == F.greatest("l_cy", "r_cy"))
    return met.where(once & condition).drop("cx", "cy", "l_cx", "l_cy", "r_cx", "r_cy")


def overlapping_pairs(df: DataFrame, keys: list[str]) -> DataFrame:
    """Pairs l_pos < r_pos of a page that overlap strictly."""
    return cell_join(df, df, keys, (F.col("l_pos") < F.col("r_pos")) & (B.intersection(B.box("l_"), B.box("r_")) > 0))


def smallest_containing(inner: DataFrame, outer: DataFrame, keys: list[str]) -> DataFrame:
    """For each inner box the smallest outer box that holds its centre (ties: smaller pos): keys, pos, outer_pos."""
    met = cell_join(inner, outer, keys, B.holds_centre(B.box("r_"), B.box("l_")))
    best = F.expr("min_by(r_pos, struct(r_w * r_h AS a, r_pos))")
    return met.groupBy(*keys, F.col("l_pos").alias("pos")).agg(best.alias("outer_pos"))


def nearest_within(left: DataFrame, right: DataFrame, keys: list[str], reach: int) -> DataFrame:
    """For each left box the right box of nearest centre, at most ``reach`` away (ties: smaller pos): keys, pos, nearest_pos, dist4 (4 x squared distance)."""
    dist4 = F.expr("(2 * l_x + l_w - 2 * r_x - r_w) * (2 * l_x + l_w - 2 * r_x - r_w) + (2 * l_y + l_h - 2 * r_y - r_h) * (2 * l_y + l_h - 2 * r_y - r_h)")
    met = cell_join(left, right, keys, dist4 <= 4 * reach * reach, reach).withColumn("dist4", dist4)
    return met.groupBy(*keys, F.col("l_pos").alias("pos")).agg(F.expr("min_by(r_pos, struct(dist4, r_pos))").alias("nearest_pos"), F.min("dist4").alias("dist4"))


def echoes(left: DataFrame, right: DataFrame, keys: list[str], tolerance: int) -> DataFrame:
    """Left boxes that some right box equals within ``tolerance`` in each of x, y, w, h."""
    same = None
    for c in "xywh":
        part = F.abs(F.col(f"l_{c}") - F.col(f"r_{c}")) <= tolerance
        same = part if same is None else same & part
    return cell_join(left, right, keys, same, tolerance).select(*keys, F.col("l_pos").alias("pos")).distinct()

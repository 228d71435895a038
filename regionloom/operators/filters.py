"""Validators and filters that account for every dropped box."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regionloom.functions import boxes as B


def drop_reason(width: int, height: int, least_area: int, least_conf_milli: int) -> Column:
    """The first rule that a box breaks, in this order; null for a kept box."""
    b = B.box()
    return (
        F.when((b.x < 0) | (b.y < 0), "negative")
        .when((b.w <= 0) | (b.h <= 0), "zero_area")
        .when((b.x >= width) | (b.y >= height), "outside")
        .when(~B.in_bounds(b, width, height), "out_of_bounds")
        .when(b.area < least_area, "small")
        .when(b.w > 8 * b.h, "flat")
        .when(F.col("conf_milli") < least_conf_milli, "low_confidence")
    )


def drop_account(boxes: DataFrame, keys: list[str], reason: Column) -> DataFrame:
    """keys, reason ('kept' for none) and how many boxes."""
    return boxes.groupBy(*keys, F.coalesce(reason, F.lit("kept")).alias("reason")).agg(F.count("*").alias("n"))


def clamp(boxes: DataFrame, width: int, height: int) -> DataFrame:
    """Boxes cut to the page; those left without an area go."""
    b = B.box()
    x, y = F.greatest(b.x, F.lit(0)), F.greatest(b.y, F.lit(0))
    right, bottom = F.least(b.right, F.lit(width)), F.least(b.bottom, F.lit(height))
    return boxes.withColumns({"x": x, "y": y, "w": right - x, "h": bottom - y}).where("w > 0 AND h > 0")

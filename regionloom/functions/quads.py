"""Four-cornered outlines as arrays of (x, y) arrays, and what follows from them, as Column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def quad(left: Column, top: Column, right: Column, bottom: Column) -> Column:
    """The corners from the upper left one on, clockwise on a page whose y grows downwards, cut to whole numbers."""
    x1, y1, x2, y2 = (c.cast("long") for c in (left, top, right, bottom))
    return F.array(F.array(x1, y1), F.array(x2, y1), F.array(x2, y2), F.array(x1, y2))


def _axis(outline: Column, k: int) -> Column:
    return F.transform(outline, lambda p: p[k])


def centroid(outline: Column) -> tuple[Column, Column]:
    """Mean of the corners."""
    return tuple(F.aggregate(_axis(outline, k), F.lit(0).cast("long"), lambda a, v: a + v) / F.size(outline) for k in (0, 1))


def extent(outline: Column) -> tuple[Column, Column, Column, Column]:
    """left, top, right, bottom."""
    return F.array_min(_axis(outline, 0)), F.array_min(_axis(outline, 1)), F.array_max(_axis(outline, 0)), F.array_max(_axis(outline, 1))


def turned_back(outline: Column, height: int) -> Column:
    """An outline found on a page turned clockwise by a quarter, in the page's own places; ``height`` is the page's."""
    return F.transform(outline, lambda p: F.array(p[1], F.lit(height - 1) - p[0]))


def moved(outline: Column, dx: Column, dy: Column) -> Column:
    return F.transform(outline, lambda p: F.array(p[0] + dx, p[1] + dy))


def axis_gap(low: Column, high: Column, other_low: Column, other_high: Column) -> Column:
    """Space between two extents on an axis, 0 where they meet."""
    return F.greatest(low - other_high, other_low - high, F.lit(0))


def shrink_factor(width: Column, height: Column, most: int) -> Column:
    """What to scale a page by so that no side is over ``most``; pages never grow."""
    return F.least(F.lit(1.0), F.lit(float(most)) / F.greatest(width, height))

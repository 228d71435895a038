"""Box algebra as Column functions. Boxes are (x, y, w, h) columns unless said otherwise."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F


class Box(NamedTuple):
    x: Column
    y: Column
    w: Column
    h: Column

    @property
    def right(self) -> Column:
        return self.x + self.w

    @property
    def bottom(self) -> Column:
        return self.y + self.h

    @property
    def area(self) -> Column:
        return F.greatest(self.w, F.lit(0)) * F.greatest(self.h, F.lit(0))


def box(prefix: str = "") -> Box:
    return Box(*(F.col(f"{prefix}{c}") for c in "xywh"))


def intersection(a: Box, b: Box) -> Column:
    """Common area; 0 for boxes that only touch."""
    w = F.least(a.right, b.right) - F.greatest(a.x, b.x)
    h = F.least(a.bottom, b.bottom) - F.greatest(a.y, b.y)
    return F.greatest(w, F.lit(0)) * F.greatest(h, F.lit(0))


def ratio(top: Column, bottom: Column) -> Column:
    """Quotient, 0 without a denominator."""
    return F.coalesce(F.try_divide(top.cast("double"), bottom.cast("double")), F.lit(0.0))


def iou(a: Box, b: Box) -> Column:
    common = intersection(a, b)
    return ratio(common, a.area + b.area - common)


def containment(a: Box, b: Box) -> Column:
    """Common area over that of the smaller box."""
    return ratio(intersection(a, b), F.least(a.area, b.area))


def giou(a: Box, b: Box) -> Column:
    """IoU less the share of the hull outside a 'union' that takes IoU times the smaller area off the sum."""
    hull = (F.greatest(a.right, b.right) - F.least(a.x, b.x)) * (F.greatest(a.bottom, b.bottom) - F.least(a.y, b.y))
    value = iou(a, b)
    return value - ratio(hull - (a.area + b.area - value * F.least(a.area, b.area)), hull)


def diou(a: Box, b: Box) -> Column:
    """IoU less the squared centre distance over the squared diagonal of the hull."""
    dx, dy = a.x + a.w / 2 - b.x - b.w / 2, a.y + a.h / 2 - b.y - b.h / 2
    hw, hh = F.greatest(a.right, b.right) - F.least(a.x, b.x), F.greatest(a.bottom, b.bottom) - F.least(a.y, b.y)
    return iou(a, b) - ratio(dx * dx + dy * dy, hw * hw + hh * hh)


def holds_centre(outer: Box, inner: Box) -> Column:
    """The inner box's centre lies in the outer box, edges included; in halves, so that integers stay exact."""
    cx, cy = 2 * inner.x + inner.w, 2 * inner.y + inner.h
    return (cx >= 2 * outer.x) & (cx <= 2 * outer.right) & (cy >= 2 * outer.y) & (cy <= 2 * outer.bottom)


def near(a: Box, b: Box, reach: int) -> Column:
    """The boxes meet when inflated by ``reach`` on each axis, edges included."""
    return (a.x - reach <= b.right) & (b.x - reach <= a.right) & (a.y - reach <= b.bottom) & (b.y - reach <= a.bottom)


def in_bounds(a: Box, width: int, height: int) -> Column:
    return (a.x >= 0) & (a.y >= 0) & (a.right <= width) & (a.bottom <= height)


def elongation(a: Box) -> Column:
    """Longer over shorter side; null for a degenerate box."""
    return F.when((a.w > 0) & (a.h > 0), F.greatest(a.w, a.h) / F.least(a.w, a.h))

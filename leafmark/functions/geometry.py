"""Measures of boxes (structs of x0, y0, x1, y1) as arithmetic on columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def area(b: Column) -> Column:
    return F.greatest(b["x1"] - b["x0"], F.lit(0.0)) * F.greatest(b["y1"] - b["y0"], F.lit(0.0))


def intersection(a: Column, b: Column) -> Column:
    width = F.least(a["x1"], b["x1"]) - F.greatest(a["x0"], b["x0"])
    height = F.least(a["y1"], b["y1"]) - F.greatest(a["y0"], b["y0"])
    return F.greatest(width, F.lit(0.0)) * F.greatest(height, F.lit(0.0))


def iou(a: Column, b: Column) -> Column:
    shared = intersection(a, b)
    union = area(a) + area(b) - shared
    return F.when(union > 0, shared / union).otherwise(F.lit(0.0))


def overlap_ratio(a: Column, b: Column) -> Column:
    """Shared area by the smaller area."""
    least = F.least(area(a), area(b))
    return F.when(least > 0, intersection(a, b) / least).otherwise(F.lit(0.0))


def holds_centre(outer: Column, inner: Column) -> Column:
    x, y = (inner["x0"] + inner["x1"]) / 2, (inner["y0"] + inner["y1"]) / 2
    return x.between(outer["x0"], outer["x1"]) & y.between(outer["y0"], outer["y1"])


def is_valid(b: Column) -> Column:
    finite = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf"))
    return finite(b["x0"]) & finite(b["y0"]) & finite(b["x1"]) & finite(b["y1"]) & (b["x1"] > b["x0"]) & (b["y1"] > b["y0"])

"""Box arithmetic on columns; boxes are x1, y1, x2, y2 with the origin at the top left."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def overlap_share(a1: Column, a2: Column, b1: Column, b2: Column) -> Column:
    """Part of the interval a that lies in b; 0 for an empty a."""
    shared = F.greatest(F.least(a2, b2) - F.greatest(a1, b1), F.lit(0.0))
    return F.when(a2 > a1, shared / (a2 - a1)).otherwise(F.lit(0.0))


def gap(a1: Column, a2: Column, b1: Column, b2: Column) -> Column:
    """Distance between two intervals; 0 if they meet."""
    return F.when(a2 <= b1, b1 - a2).when(b2 <= a1, a1 - b2).otherwise(F.lit(0.0))


def union_box(prefix: str = "") -> list[Column]:
    """Aggregates of the box around all boxes of a group."""
    least, most = (lambda c: F.min(prefix + c)), (lambda c: F.max(prefix + c))
    return [least("x1").alias("x1"), least("y1").alias("y1"), most("x2").alias("x2"), most("y2").alias("y2")]


def scaled_box(box: Column) -> Column:
    """A box in thousandths or in shares as shares within [0, 1]; null if it is none."""
    scale = F.when(F.array_max(box) > 1.0, 1000.0).otherwise(1.0)
    inside = F.transform(box, lambda v: F.greatest(F.lit(0.0), F.least(F.lit(1.0), v / scale)))
    sound = (F.size(box) == 4) & ~F.exists(box, lambda v: v.isNull())
    return F.when(sound & (inside[2] > inside[0]) & (inside[3] > inside[1]), inside)

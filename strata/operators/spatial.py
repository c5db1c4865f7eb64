"""Planar radius filter and distance join on lon/lat."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def within(x: Column, y: Column, at: tuple[float, float], radius: float) -> Column:
    """Whether a point lies within the radius, in degrees: a box that a scan can push down, then the distance. Null points don't."""
    a, b = at
    box = x.between(a - radius, a + radius) & y.between(b - radius, b + radius)
    return F.coalesce(box & ((x - a) * (x - a) + (y - b) * (y - b) <= radius * radius), F.lit(False))


def distance_join(left: DataFrame, right: DataFrame, radius: float, x: str = "x", y: str = "y") -> DataFrame:
    """Pairs of rows within the radius: both sides fall into cells of that size and meet by equal cell, the right side in the nine around it.

    left and right must have different names for all columns but x and y; the result has left's columns, right's without x
    and y, and distance2. A crowded cell is split by AQE's skew join.
    """
    cell = lambda c: F.floor(F.col(c) / radius).cast("long")
    l = left.where(F.col(x).isNotNull() & F.col(y).isNotNull()).withColumns({"__cx": cell(x), "__cy": cell(y)})  # noqa: E741
    steps = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)])
    r = right.where(F.col(x).isNotNull() & F.col(y).isNotNull()).withColumns({"__rx": F.col(x), "__ry": F.col(y), "__d": F.explode(steps)})
    r = r.withColumns({"__cx": F.floor(F.col("__rx") / radius).cast("long") + F.col("__d.i"), "__cy": F.floor(F.col("__ry") / radius).cast("long") + F.col("__d.j")}).drop(x, y, "__d")
    d2 = (F.col(x) - F.col("__rx")) * (F.col(x) - F.col("__rx")) + (F.col(y) - F.col("__ry")) * (F.col(y) - F.col("__ry"))
    return l.join(r, ["__cx", "__cy"]).withColumn("distance2", d2).where(F.col("distance2") <= radius * radius).drop("__cx", "__cy", "__rx", "__ry")

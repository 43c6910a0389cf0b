"""Rectangles that meet, by a grid of one level per size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CORNERS = ("x0", "x1", "y0", "y1")


def _level(lo: str, hi: str, lo2: str, hi2: str) -> Column:
    """The exponent of the smallest power of two that a rectangle's longer side does not exceed."""
    return F.ceil(F.log2(F.greatest(F.col(hi) - F.col(lo), F.col(hi2) - F.col(lo2), F.lit(1e-9)))).cast("int")


def _in_cells(t: DataFrame) -> DataFrame:
    """Once for each cell of its level ``l`` that a rectangle reaches into: at most four."""
    width = F.pow(F.lit(2.0), F.col("l"))
    cells = lambda lo, hi: F.explode(F.sequence(F.floor(F.col(lo) / width), F.floor(F.col(hi) / width)))
    return t.withColumn("gx", cells("x0", "x1")).withColumn("gy", cells("y0", "y1"))


def meeting(a: DataFrame, b: DataFrame, by: Sequence[str], one: str = "a", two: str = "b") -> DataFrame:
    """Pairs of (by.., id, x0, x1, y0, y1) whose rectangles share a point, bounds included: (by.., one, two, and the shared x0, x1, y0, y1).

    A rectangle lives in cells as wide as the power of two above its longer side, and visits the wider cells of the levels that the other table has
    above its own. A pair meets at the level of its larger side, and only where that one lives: what is small never meets what is small in
    a cell that is large for another's sake. Of the cells that both reach, the one with the lowest corner of what they share reports it.
    Both sides are sorted and merged: files of numbers in a row are a tenth of their rows, so Spark would take them for small enough to broadcast.
    Rectangles whose upper bound is below the lower one or null, and null keys, meet nothing. Empty tables give no rows.
    """
    by = list(by)
    live = [t.select(*by, F.col("id").alias(n), *CORNERS).where("x0 <= x1 and y0 <= y1").withColumn("own", _level("x0", "x1", "y0", "y1")) for t, n in ((a, one), (b, two))]

    def visits(t: DataFrame, other: DataFrame) -> DataFrame:
        levels = other.select(*by, F.col("own").alias("l")).distinct()  # as many as there are sizes
        return _in_cells(t.join(levels, by).where("l > own"))

    home = [_in_cells(t.withColumn("l", F.col("own"))) for t in live]
    side = lambda t, n, p: t.select(*by, "l", "gx", "gy", n, *(F.col(c).alias(f"{p}{c}") for c in CORNERS))
    met = lambda s, t: side(s, one, "p").join(side(t, two, "q").hint("merge"), [*by, "l", "gx", "gy"])
    every = met(home[0], home[1].unionByName(visits(live[1], live[0]))).unionByName(met(visits(live[0], live[1]), home[1]))
    width = F.pow(F.lit(2.0), F.col("l"))
    shared = every.select(*by, "l", "gx", "gy", one, two, F.greatest("px0", "qx0").alias("x0"), F.least("px1", "qx1").alias("x1"), F.greatest("py0", "qy0").alias("y0"), F.least("py1", "qy1").alias("y1"))
    here = (F.floor(F.col("x0") / width) == F.col("gx")) & (F.floor(F.col("y0") / width) == F.col("gy"))
    return shared.where(here & F.expr("x0 <= x1 and y0 <= y1")).select(*by, one, two, *CORNERS)

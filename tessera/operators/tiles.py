"""Acquisition metadata: names, rounds, tiles and boxes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.rectangles import meeting


def round_number(x: Column) -> Column:
    """R01, r1 or 1 -> 1; null for anything else."""
    return F.regexp_extract(F.trim(x), r"^[Rr]?(\d+)$", 1).try_cast("int")


def version_name(x: Column) -> Column:
    """V3, v03 or 3 -> V03; blank stays blank; null for anything else."""
    digits = F.regexp_extract(F.trim(x), r"^[Vv]?(\d+)$", 1)
    number = digits.try_cast("int").cast("string")
    return F.when(F.trim(x) == "", "").when(digits != "", F.concat(F.lit("V"), F.when(F.length(number) < 2, F.lpad(number, 2, "0")).otherwise(number)))


def scene_of_region(region: Column) -> Column:
    """S0 -> scene01."""
    n = (F.regexp_replace(region, "[^0-9]", "").try_cast("int") + 1).cast("string")
    return F.concat(F.lit("scene"), F.when(F.length(n) < 2, F.lpad(n, 2, "0")).otherwise(n))


def split_stem(df: DataFrame, stem: str, fields: tuple[str, ...], folds: dict[str, str] | None = None) -> DataFrame:
    """Columns of a file stem's fields between underscores; only stems with exactly those fields stay, :func:`other_stems` are the others.

    ``folds`` says what names with an underscore of their own become, by default ``AF`` for those of combined background channels.
    """
    name = F.col(stem)
    for old, new in (folds if folds is not None else {"AF_FITC": "AF", "FITC_AF": "AF"}).items():
        name = F.replace(name, F.lit(old), F.lit(new))
    parts = F.split(name, "_")
    return df.where(F.size(parts) == len(fields)).select("*", *(F.trim(parts[i]).alias(f) for i, f in enumerate(fields)))


def other_stems(df: DataFrame, stem: str, fields: int, folds: dict[str, str] | None = None) -> DataFrame:
    """Rows whose stems do not have that many fields, to be reported."""
    name = F.col(stem)
    for old, new in (folds if folds is not None else {"AF_FITC": "AF", "FITC_AF": "AF"}).items():
        name = F.replace(name, F.lit(old), F.lit(new))
    return df.where(F.coalesce(F.size(F.split(name, "_")) != fields, F.lit(True)))


def nearest_round(df: DataFrame, ties_to_larger: bool, is_reference: Column, by: str = "slide_id", order: str = "round_n") -> DataFrame:
    """For each other row the nearest reference round of its group: the last before it and the first after it.

    Two running windows per group replace the join of all rounds with all references.
    """
    w = Window.partitionBy(by).orderBy(order)
    ref = F.when(is_reference, F.col(order))
    before = F.last(ref, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    after = F.first(ref, ignorenulls=True).over(w.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    d = df.withColumn("_b", before).withColumn("_a", after).where(~is_reference)
    left, right = F.col(order) - F.col("_b"), F.col("_a") - F.col(order)
    later = F.col("_b").isNull() | (right <= left if ties_to_larger else right < left)
    return d.withColumn("nearest", F.when(F.coalesce(later, F.lit(False)), F.col("_a")).otherwise(F.col("_b"))).drop("_a", "_b")


def nth_match(left: DataFrame, right: DataFrame, key: str, left_order: str, right_order: str) -> DataFrame:
    """The i-th row of a key on the left joins its i-th row on the right."""
    n = lambda t, o: t.withColumn("_i", F.row_number().over(Window.partitionBy(key).orderBy(o)))
    return n(left, left_order).join(n(right, right_order), [key, "_i"]).withColumnRenamed("_i", "occurrence")


def dense_renumber(df: DataFrame, by: str, order: str) -> DataFrame:
    return df.withColumn("new_number", F.dense_rank().over(Window.partitionBy(by).orderBy(order)) - 1)


def best_ties(df: DataFrame, by: list[str], value: str) -> DataFrame:
    return df.withColumn("_m", F.max(value).over(Window.partitionBy(*by))).where(F.col(value) == F.col("_m")).drop("_m")


def largest_subgroup(df: DataFrame, by: str, sub: str) -> DataFrame:
    """Rows in the subgroup with most rows of each group, all of them on ties."""
    n = df.groupBy(by, sub).agg(F.count("*").alias("_n"))
    best = n.withColumn("_m", F.max("_n").over(Window.partitionBy(by))).where("_n = _m").select(by, sub)
    return df.join(best, [by, sub])


def missing_combinations(df: DataFrame, a: str, b: str) -> DataFrame:
    """Pairs of a and b, both of which occur, that do not occur together. Both sides are distinct names, and few."""
    return df.select(a).distinct().join(df.select(b).distinct()).join(df.select(a, b).distinct(), [a, b], "left_anti")


def _near_cells(tiles: DataFrame, by: str, x: str, y: str, size: float) -> tuple[DataFrame, DataFrame]:
    """Tiles with their grid cell, and again with every cell around it, so that overlap becomes an equi-join."""
    cell = tiles.withColumn("gx", F.floor(F.col(x) / size)).withColumn("gy", F.floor(F.col(y) / size))
    around = cell.withColumn("gx", F.explode(F.array(*(F.col("gx") + k for k in (-1, 0, 1))))).withColumn("gy", F.explode(F.array(*(F.col("gy") + k for k in (-1, 0, 1)))))
    return cell, around


def tile_overlaps(tiles: DataFrame, by: str = "slide", x: str = "stage_x", y: str = "stage_y", w: str = "width_px", h: str = "height_px") -> DataFrame:
    """Pairs (a, b), a < b, of tiles of a slide whose rectangles meet, bounds included, with the shared box.

    Tiles of any sizes may lie side by side; see :func:`tessera.operators.rectangles.meeting`.
    """
    ends = {"x0": F.col(x), "x1": F.col(x) + F.col(w), "y0": F.col(y), "y1": F.col(y) + F.col(h)}
    boxes = tiles.select(by, F.col("tile").alias("id"), *(e.alias(c) for c, e in ends.items()))
    return meeting(boxes, boxes, [by]).where("a < b").select(by, "a", "b", "x0", "y0", "x1", "y1")


def tile_neighbours(tiles: DataFrame, by: str = "slide", size: float = 2040.0) -> DataFrame:
    """Left, right, upper and lower neighbour: aligned within 10 % of the size, gap up to 1.3 sizes; the largest tile number wins.

    ``l_n`` has the larger x and ``r_n`` the smaller one, ``u_n`` the larger y and ``d_n`` the smaller one. The join is a merge, as compressed
    files of tiles look small enough to broadcast.
    """
    one, two = _near_cells(tiles, by, "stage_x", "stage_y", size * 1.3 + 1e-9)
    a = one.select(by, "gx", "gy", "tile", F.col("stage_x").alias("ax"), F.col("stage_y").alias("ay"))
    b = two.select(by, "gx", "gy", F.col("tile").alias("other"), (F.col("stage_x")).alias("bx"), F.col("stage_y").alias("by_"))
    j = a.join(b.hint("merge"), [by, "gx", "gy"]).where("tile <> other").withColumn("dx", F.col("bx") - F.col("ax")).withColumn("dy", F.col("by_") - F.col("ay"))
    near = lambda along, across, sign: F.max(F.when((F.abs(across) < 0.1 * size) & (sign * F.col(along) > 0) & (sign * F.col(along) <= 1.3 * size), F.col("other")))
    found = j.groupBy(by, "tile").agg(
        near("dx", F.col("dy"), 1).alias("l_n"), near("dx", F.col("dy"), -1).alias("r_n"), near("dy", F.col("dx"), 1).alias("u_n"), near("dy", F.col("dx"), -1).alias("d_n"))
    return tiles.select(by, "tile").join(found.hint("merge"), [by, "tile"], "left")


def iou(overlaps: DataFrame, area: float) -> DataFrame:
    """Intersection over union of pairs of equal-sized boxes."""
    shared = (F.col("x1") - F.col("x0")) * (F.col("y1") - F.col("y0"))
    return overlaps.withColumn("iou", shared / (2 * area - shared))


def canvas_positions(tiles: DataFrame, by: str = "slide", px: float = 1.0, factor: float = 4.0) -> DataFrame:
    """Stage positions as canvas centres: (stage / px - least + size / 2) / factor, rounded half to even."""
    w = Window.partitionBy(by)
    at = lambda c, size: F.bround((F.col(c) / px - F.min(F.col(c) / px).over(w) + F.col(size) / 2) / factor).cast("long")
    return tiles.select(by, "tile", at("stage_x", "width_px").alias("cx"), at("stage_y", "height_px").alias("cy"))


def box_iou(reference: DataFrame, query: DataFrame, by: str = "slide") -> DataFrame:
    """Intersection over union of each reference box (a) with each query box (b) of its slide, 0 where they do not meet: (by, a, b, iou).

    Both sides have (name, x0, y0, x1, y1). A slide has a few boxes, and only boxes of one slide meet.
    """
    one = lambda t, n: t.select(by, F.col("name").alias(n), *(F.col(c).alias(f"{n}{c}") for c in ("x0", "y0", "x1", "y1")))
    j = one(reference, "a").join(one(query, "b"), by)
    size = lambda n: (F.col(f"{n}x1") - F.col(f"{n}x0")) * (F.col(f"{n}y1") - F.col(f"{n}y0"))
    wide = lambda c: F.greatest(F.lit(0.0), F.least(f"a{c}1", f"b{c}1") - F.greatest(f"a{c}0", f"b{c}0"))
    both = wide("x") * wide("y")
    return j.select(by, "a", "b", F.coalesce(both / F.nullif(size("a") + size("b") - both, F.lit(0.0)), F.lit(0.0)).alias("iou"))

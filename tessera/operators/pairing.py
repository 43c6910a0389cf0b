"""Image listings: which image serves as whose reference, and which offset estimate of a tile pair counts.

An image listing has slide_id, scene_id, channel_id, round_n, version, marker_id, QC_include and file_name.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

GROUP = ("slide_id", "scene_id", "channel_id")
#: Markers that have no background of their own to take away.
WITHOUT_BACKGROUND = ("AF", "BLANK", "DAPI", "NA")


def nearest_background(images: DataFrame) -> DataFrame:
    """For each round of a slide, scene and channel the background image of the nearest round; ties go to the earlier one.

    One row per round takes part in the windows, whatever the number of images; no round meets all others.
    """
    usable = (F.col("marker_id") == "AF") & (F.col("QC_include") == 1)
    rounds = images.groupBy(*GROUP, "round_n").agg(F.min(F.when(usable, F.col("file_name"))).alias("af"))
    rounds = rounds.withColumn("x", F.when(F.col("af").isNotNull(), F.struct(F.col("round_n").alias("n"), "af")))
    w = Window.partitionBy(*GROUP).orderBy("round_n")
    before = F.last("x", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    after = F.first("x", ignorenulls=True).over(w.rowsBetween(0, Window.unboundedFollowing))
    rounds = rounds.withColumn("b", before).withColumn("a", after)
    later = F.col("a.n") - F.col("round_n") < F.col("round_n") - F.col("b.n")
    return rounds.select(*GROUP, "round_n", F.when(F.col("b").isNull() | later, F.col("a.af")).otherwise(F.col("b.af")).alias("nearest"))


def pair_backgrounds(images: DataFrame) -> DataFrame:
    """The background image of each included marker image: file_name, af_file, how.

    The round that ``ref_round_af`` names comes first, then the nearest background round, then the first file name of the channel.
    """
    by_round = images.groupBy(*GROUP, F.col("round_n").alias("ref_round_af")).agg(F.min("file_name").alias("named"))
    any_ = images.groupBy(*GROUP).agg(F.min("file_name").alias("same"))
    marked = images.where((F.col("QC_include") == 1) & F.col("marker_id").isNotNull() & ~F.col("marker_id").isin(*WITHOUT_BACKGROUND))
    marked = marked.where(F.upper("marker_id") != F.upper("channel_id"))
    j = marked.join(by_round, [*GROUP, "ref_round_af"], "left").join(nearest_background(images), [*GROUP, "round_n"], "left").join(any_, list(GROUP), "left")
    how = F.when(F.col("named").isNotNull(), "named").when(F.col("nearest").isNotNull(), "nearest").otherwise("channel")
    return j.select("file_name", F.coalesce("named", "nearest", "same").alias("af_file"), how.alias("how"))


def resolve_references(images: DataFrame, round_n: int, version: str | None = None, overrides: DataFrame | None = None) -> DataFrame:
    """Per slide and scene the reference round and version, and a status.

    ``overrides`` (slide_id, scene_id, round_o, version_o; nulls leave the default) go before the defaults. Without a version
    the round must have exactly one. Faults are rows of their own status: no_round, ambiguous_version, no_version, unused_override.
    """
    key = ["slide_id", "scene_id"]
    scenes = images.select(*key).distinct()
    if overrides is None:
        wanted = scenes.withColumn("round_o", F.lit(None).cast("int")).withColumn("version_o", F.lit(None).cast("string"))
        unused = wanted.where("false")
    else:
        wanted, unused = scenes.join(overrides, key, "left"), overrides.join(scenes, key, "left_anti")
    wanted = wanted.select(*key, F.coalesce("round_o", F.lit(round_n)).alias("round_n"), F.coalesce("version_o", F.lit(version).cast("string")).alias("asked"))
    present = images.groupBy(*key, "round_n").agg(F.countDistinct("version").alias("k"), F.min("version").alias("only"), F.collect_set("version").alias("all"))
    j = wanted.join(present, [*key, "round_n"], "left")
    status = F.when(F.col("k").isNull(), "no_round").when(F.col("asked").isNull() & (F.col("k") > 1), "ambiguous_version")
    status = status.when(F.col("asked").isNotNull() & ~F.array_contains("all", F.col("asked")), "no_version").otherwise("ok")
    j = j.withColumn("status", status)
    rows = j.select(*key, "round_n", F.when(F.col("status") == "ok", F.coalesce("asked", "only")).alias("version"), "status")
    return rows.unionByName(unused.select(*key, F.col("round_o").alias("round_n"), F.col("version_o").alias("version"), F.lit("unused_override").alias("status")))


def mark_references(images: DataFrame, resolved: DataFrame) -> DataFrame:
    """``is_reference``: the image is of its scene's reference round and version."""
    r = resolved.where("status = 'ok'").select("slide_id", "scene_id", "round_n", "version", F.lit(True).alias("is_reference"))
    return images.join(r, ["slide_id", "scene_id", "round_n", "version"], "left").withColumn("is_reference", F.coalesce("is_reference", F.lit(False)))


def pair_with_reference(images: DataFrame, resolved: DataFrame) -> DataFrame:
    """Each image that is not of its scene's reference round and version with the scene's reference image of its channel: (file_name, ref_file).

    Scenes whose reference is not resolved have no rows; a channel that the reference lacks gives a null. Several reference images of a channel are an error.
    """
    marked = mark_references(images, resolved)
    ref = marked.where("is_reference").groupBy(*GROUP).agg(F.min("file_name").alias("ref_file"), F.count("*").alias("n"))
    scenes = resolved.where("status = 'ok'").select("slide_id", "scene_id").distinct()
    if several := ref.where("n > 1").limit(20).collect():
        raise ValueError(f"several reference images: {[tuple(x[c] for c in GROUP) for x in several]}")
    return marked.where("not is_reference").join(scenes, ["slide_id", "scene_id"], "left_semi").join(ref.drop("n"), list(GROUP), "left").select("file_name", "ref_file")


def counterparts(images: DataFrame, resolved: DataFrame) -> DataFrame:
    """For each image the one of the reference round with its slide, scene and channel: file_name, ref_file, exact.

    The resolved version comes first, then any version of the round; the first file name of several.
    """
    r = images.join(resolved.where("status = 'ok'").select("slide_id", "scene_id", "round_n", F.col("version").alias("v")), ["slide_id", "scene_id", "round_n"])
    r = r.groupBy(*GROUP).agg(F.min(F.when(F.col("version") == F.col("v"), F.col("file_name"))).alias("one"), F.min("file_name").alias("any"))
    return images.join(r, list(GROUP), "left").select("file_name", F.coalesce("one", "any").alias("ref_file"), F.col("one").isNotNull().alias("exact"))


def natural_left(left: DataFrame, right: DataFrame) -> DataFrame:
    """Left join on all shared column names."""
    return left.join(right, [c for c in left.columns if c in right.columns], "left")


def scans(images: DataFrame) -> DataFrame:
    """Per scene a map from round and version (R1/V01) to the first file name."""
    one = images.groupBy("slide_id", "scene_id", "round_n", "version").agg(F.min("file_name").alias("f"))
    entry = F.struct(F.concat(F.lit("R"), F.col("round_n").cast("string"), F.lit("/"), F.col("version")), "f")
    return one.groupBy("slide_id", "scene_id").agg(F.map_from_entries(F.sort_array(F.collect_list(entry))).alias("scans"))


def every_round(images: DataFrame) -> DataFrame:
    """Every slide with every round and version that any slide has. The latter are few names; Spark picks the join."""
    return images.select("slide_id").distinct().join(images.select("round_n", "version").distinct())


def best_estimates(estimates: DataFrame) -> DataFrame:
    """Of (pair, method, score, dx, dy) the row with the highest score per pair; null counts as 0, ties go to the first method."""
    e = estimates.withColumn("score", F.coalesce("score", F.lit(0.0)))
    top = e.groupBy("pair").agg(F.min_by(F.struct(*e.columns), F.struct(-F.col("score"), "method")).alias("e"))
    return top.select("e.*")


def first_agreement(estimates: DataFrame, order: Sequence[str], within: float = 5.0) -> DataFrame:
    """Per pair the first method in ``order`` that agrees with a later one: neither component exceeds the other's by ``within``.

    The difference is signed, earlier less later. A pair has at most one row per method, so a few. Pairs without
    agreement go; the largest overlap ``area`` comes first.
    """
    rank = F.array_position(F.array(*map(F.lit, order)), F.col("method"))
    e = estimates.withColumn("i", rank).where("i > 0").groupBy("pair").agg(F.array_sort(F.collect_list(F.struct("i", "method", "dx", "dy", "area"))).alias("e"))
    agrees = lambda m: F.exists("e", lambda o: (o["i"] > m["i"]) & (F.greatest(m["dx"] - o["dx"], m["dy"] - o["dy"]) < within))
    first = F.get(F.filter("e", agrees), F.lit(0))
    found = e.select("pair", first["method"].alias("method"), first["dx"].alias("dx"), first["dy"].alias("dy"), first["area"].alias("area"))
    return found.where("method is not null").orderBy(F.desc("area"), "pair")


def stage_coordinates(tiles: DataFrame, by: str = "channel", px: float = 1.0) -> DataFrame:
    """Stage positions in pixels, counted from the least of each ``by``; the least values are aggregated and joined back."""
    least = tiles.groupBy(by).agg(F.min("stage_x").alias("_x"), F.min("stage_y").alias("_y"))
    return tiles.join(least, by).select(by, "tile", ((F.col("stage_x") - F.col("_x")) / px).alias("x"), ((F.col("stage_y") - F.col("_y")) / px).alias("y"))


def overlap_share(tiles: DataFrame, by: str = "slide") -> DataFrame:
    """1 - distance / size of the two lowest levels of each axis, and the mean of both axes."""

    def axis(c: str, size: str) -> DataFrame:
        low = tiles.groupBy(by).agg(F.min(c).alias("a"))
        two = tiles.join(low, by).where(F.col(c) > F.col("a")).groupBy(by, "a").agg(F.min(c).alias("b"))
        return two.crossJoin(tiles.agg(F.max(size).alias("s"))).select(by, (1 - (F.col("b") - F.col("a")) / F.col("s")).alias(c))  # one row

    x, y = axis("stage_x", "width_px"), axis("stage_y", "height_px")
    return x.join(y, by).select(by, F.col("stage_x").alias("overlap_x"), F.col("stage_y").alias("overlap_y"), ((F.col("stage_x") + F.col("stage_y")) / 2).alias("overlap"))


def tiles_in_boxes(tiles: DataFrame, boxes: DataFrame, by: str = "slide") -> DataFrame:
    """Tiles whose rectangle meets a box of their slide; per tile the regions it meets. A slide has few boxes."""
    j = tiles.join(boxes, by)
    j = j.where("stage_x < x1 and stage_x + width_px > x0 and stage_y < y1 and stage_y + height_px > y0")
    return j.select(by, "tile", "region", "channel")


def neighbours_of_best(pairs: DataFrame, neighbours: DataFrame) -> DataFrame:
    """For a tile's partner of largest overlap, that partner's neighbours which have no pair with the tile yet: (a, b, via)."""
    best = pairs.groupBy("a").agg(F.min_by("b", F.struct(-F.col("area"), "b")).alias("via"))
    more = best.join(neighbours.select(F.col("tile").alias("via"), F.col("other").alias("b")), "via").where("a <> b")
    return more.join(pairs.select("a", "b"), ["a", "b"], "left_anti").select("a", "b", "via").distinct()

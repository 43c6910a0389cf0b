"""Overlaps of tiles across rounds: pairs, groups, winners, and which offset of a pair counts."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.rectangles import CORNERS, meeting
from tessera.plans.lineage import cut, discard

#: Methods in order of priority, those whose vote counts twice, and the least votes.
PRIORITY = ("imreg_dft", "cv2", "aa", "chi2_no_angle", "phase_cross_correlation_no_angle", "imreg_dft_no_angle", "thunder_no_angle")
DOUBLE = ("imreg_dft", "cv2")
LEAST_VOTES = 3
LEAST_AREA = 0.00005


def pair_boxes(reference: DataFrame, query: DataFrame, by: Sequence[str] = ("slide", "scene")) -> DataFrame:
    """Every reference tile with every query tile of its slide and scene that it overlaps: (by.., a, b, x0, x1, y0, y1), bounds included.

    Both sides have (tile, x0, x1, y0, y1), of any sizes side by side; see :func:`tessera.operators.rectangles.meeting`.
    """
    named = lambda t: t.select(*by, F.col("tile").alias("id"), *CORNERS)
    return meeting(named(reference), named(query), by)


def area() -> Column:
    return (F.col("x1") - F.col("x0")) * (F.col("y1") - F.col("y0"))


def pair_area_filter(pairs: DataFrame, tile_area: float, least: float = LEAST_AREA) -> DataFrame:
    """Pairs whose overlap is at least a share of a tile's area."""
    return pairs.where(area() >= least * tile_area)


def extend_pairs(pairs: DataFrame, neighbours: DataFrame, coordinates: DataFrame, tile_area: float, least: float = LEAST_AREA) -> DataFrame:
    """Further pairs for each reference tile a: the neighbours b of its partner of largest overlap (the smaller tile on ties) that have no pair with it, or
    one below the least area. The box is the partner's, shifted by the stage distance of both tiles.

    ``pairs``: (a, b, x0, x1, y0, y1); ``neighbours``: (tile, other); ``coordinates``: (tile, x, y). All joins are merges, as each table may be as long as that of
    tiles, whose compressed files look small enough to broadcast.
    """
    best = pairs.groupBy("a").agg(F.min_by(F.struct("b", "x0", "x1", "y0", "y1"), F.struct(-area(), "b")).alias("p")).select("a", F.col("p.b").alias("via"), "p.x0", "p.x1", "p.y0", "p.y1")
    at = lambda c: coordinates.select(F.col("tile").alias(c), F.col("x").alias(f"{c}_x"), F.col("y").alias(f"{c}_y")).hint("merge")
    j = best.join(neighbours.select(F.col("tile").alias("via"), F.col("other").alias("b")).distinct().hint("merge"), "via").join(at("via"), "via").join(at("b"), "b")
    good = pair_area_filter(pairs, tile_area, least).select("a", "b").hint("merge")
    dx, dy = F.col("via_x") - F.col("b_x"), F.col("via_y") - F.col("b_y")
    moved = [(F.col(c) - d).alias(c) for c, d in (("x0", dx), ("x1", dx), ("y0", dy), ("y1", dy))]
    return j.join(good, ["a", "b"], "left_anti").select("a", "b", "via", *moved)


def overlap_groups(tiles: DataFrame, by: Sequence[str] = ("scene",), most_members: int = 16) -> DataFrame:
    """Regions that two, three, .. tiles of a scene share: (by.., members, size, x0, x1, y0, y1), members sorted.

    Pairs are closed under union: two groups whose boxes meet make the group of all their members, until nothing new comes up. Of several boxes of
    one group that of the smallest corner counts. Each round can double the members of the largest group, and rounds go on until none is new.
    Tiles that overlap lie side by side, so groups stay small; n tiles that all share one place have 2^n groups, so a group of more than
    ``most_members`` raises an error instead.
    """
    own = lambda c: F.col(c)
    pairs = pair_boxes(tiles, tiles, by).where("a < b")
    box = ["x0", "x1", "y0", "y1"]
    groups = cut(pairs.select(*by, F.array_sort(F.array("a", "b")).alias("members"), *box), "groups")
    new = groups
    while True:
        # each new group with all groups that share a member: boxes that meet in one place have members in common through it
        key = lambda t, x: t.withColumn("m", F.explode("members")).select(*by, "m", *(F.col(c).alias(f"{x}_{c}") for c in ("members", *box)))
        j = key(new, "p").join(key(groups, "q").hint("merge"), [*by, "m"]).where("p_members <> q_members").select(
            *by, F.array_sort(F.array_union("p_members", "q_members")).alias("members"), F.greatest("p_x0", "q_x0").alias("x0"), F.least("p_x1", "q_x1").alias("x1"),
            F.greatest("p_y0", "q_y0").alias("y0"), F.least("p_y1", "q_y1").alias("y1")).where("x0 <= x1 and y0 <= y1")
        found = j.groupBy(*by, "members").agg(F.min(F.struct(*box)).alias("b")).select(*by, "members", *(own(f"b.{c}").alias(c) for c in box))
        found = cut(found.join(groups.select(*by, "members").hint("merge"), [*by, "members"], "left_anti"), "groups")
        if found.isEmpty():
            discard(found)
            break
        if not found.where(F.size("members") > most_members).isEmpty():
            raise ValueError(f"more than {most_members} tiles share one place")
        groups, new = cut(groups.unionByName(found), "groups"), found
    return groups.withColumn("size", F.size("members"))


def overlap_winners(groups: DataFrame, scores: DataFrame) -> DataFrame:
    """Per group the member of the highest score (null counts as 0), ties to the smallest id as a string; ``rank`` 1 wins, further ranks fill its holes.

    ``scores``: (members, tile, score). Larger groups overwrite smaller ones where a pixel has several.
    """
    from pyspark.sql import Window

    one = groups.withColumn("tile", F.explode("members")).join(scores.hint("merge"), ["members", "tile"], "left")
    w = Window.partitionBy("members").orderBy(F.desc(F.coalesce("score", F.lit(0.0))), F.col("tile").cast("string"))
    return one.withColumn("rank", F.row_number().over(w))


def fill_overlaps(px: DataFrame, winners: DataFrame) -> DataFrame:
    """Pixels (tile, r, c, v) of overlapping tiles as one image (r, c, v): the winner of the largest group at a place, and, where it is zero, the next ranks of it that are not."""
    j = px.join(winners.select("tile", "rank", "size", "x0", "x1", "y0", "y1"), "tile").where("r >= x0 and r < x1 and c >= y0 and c < y1")
    order = F.struct((F.col("v") == 0).cast("int"), -F.col("size"), "rank")
    return j.groupBy("r", "c").agg(F.min_by("v", order).alias("v"))


def pair_offset_filter(offsets: DataFrame, overlap: float, width: float, height: float, most: float = 300.0) -> DataFrame:
    """Offsets (direction, along, across) of neighbour tiles that are plausible: half to one and a half of the overlap along the direction (signed:
    negative for ``left`` and ``up``), less than 1 % drift across it, and below ``most`` pixels.
    """
    size = F.when(F.col("direction").isin("left", "right"), F.lit(width)).otherwise(F.lit(height))
    other = F.when(F.col("direction").isin("left", "right"), F.lit(height)).otherwise(F.lit(width))
    sign = F.when(F.col("direction").isin("left", "up"), -1).otherwise(1)
    share = sign * F.col("along") / size
    small = F.greatest(F.abs("along"), F.abs("across")) <= most
    return offsets.where(share.between(0.5 * overlap, 1.5 * overlap) & (F.abs("across") <= 0.01 * other) & small)


def transform_consensus(estimates: DataFrame, most_angle: float = 10.0, within: float = 10.0) -> DataFrame:
    """Per pair of tiles the offset on which enough methods agree: (pair, method, dx, dy, votes); null method without agreement.

    Estimates (pair, method, dx, dy, angle) turned by more than ``most_angle`` degrees go. In the order of their names methods join the cluster of
    the smallest mean distance, if that is within ``within`` pixels, or open one; two methods have two votes where they join one. Of the clusters with most votes,
    three at least, the method of the highest priority speaks. A pair has one row per method, seven at most; the clusters are a fold over them
    in Spark's own columns. Null angles and offsets count as turned too far.
    """
    item = "struct<method: string, dx: double, dy: double>"
    e = F.struct(F.col("method").cast("string").alias("method"), F.col("dx").cast("double").alias("dx"), F.col("dy").cast("double").alias("dy"))
    good = (F.abs("angle") <= most_angle) & F.expr("method is not null and dx is not null and dy is not null")
    rows = estimates.groupBy("pair").agg(F.array_sort(F.array_compact(F.collect_list(F.when(good, e)))).alias("rows"))

    def join(clusters: Column, x: Column) -> Column:
        apart = lambda o: F.sqrt((x["dx"] - o["dx"]) * (x["dx"] - o["dx"]) + (x["dy"] - o["dy"]) * (x["dy"] - o["dy"]))
        far = F.transform(clusters, lambda c: F.aggregate(c, F.lit(0.0), lambda s, o: s + apart(o)) / F.size(c))
        near = F.array_min(far)
        twice = F.when(x["method"].isin(*DOUBLE), F.array(x, x)).otherwise(F.array(x))
        at = F.array_position(far, near) - 1
        grown = F.transform(clusters, lambda c, i: F.when(i == at, F.concat(c, twice)).otherwise(c))
        return F.when(F.coalesce(near <= within, F.lit(False)), grown).otherwise(F.concat(clusters, F.array(F.array(x))))

    clusters = F.aggregate("rows", F.array().cast(f"array<array<{item}>>"), join)
    d = rows.withColumn("c", clusters).withColumn("votes", F.coalesce(F.array_max(F.transform("c", F.size)), F.lit(0)))
    most = F.flatten(F.filter("c", lambda c: (F.size(c) == F.col("votes")) & (F.col("votes") >= LEAST_VOTES)))
    rank = lambda x: F.array_position(F.array(*map(F.lit, PRIORITY)), x["method"])
    known = F.transform(F.filter(most, lambda x: x["method"].isin(*PRIORITY)), lambda x: F.struct(rank(x).alias("rank"), x.alias("e")))
    first = F.array_min(F.transform(known, lambda k: F.struct(k["rank"].alias("rank"), k["e"]["method"].alias("method"), k["e"]["dx"].alias("dx"), k["e"]["dy"].alias("dy"))))
    return d.withColumn("first", first).select(F.col("pair").cast("long").alias("pair"), "first.method", "first.dx", "first.dy", F.col("votes").cast("int").alias("votes"))


def pixel_scale(tiles: DataFrame, out_px: float) -> DataFrame:
    """ImagePixelSize "px,py" in tenths as ``px``, and the factor to the wanted size."""
    px = F.split("ImagePixelSize", ",")[0].try_cast("double") / 10
    return tiles.withColumn("px", px).withColumn("conversion", F.lit(out_px) / px)


def rescale_boxes(boxes: DataFrame, to_full: float, to_qc: float, shape: tuple[int, int], full_shape: tuple[int, int], qc_shape: tuple[int, int]) -> DataFrame:
    """Boxes at three resolutions: as they are, at full size (``_full``) and at that of the quality map (``_qc``), clipped to the images."""
    full = {f"{c}_full": F.col(c) * to_full for c in ("minr", "minc", "maxr", "maxc")}
    qc = {f"{c}_qc": F.col(c) * to_full / to_qc for c in ("minr", "minc", "maxr", "maxc")}
    d = boxes.withColumns({**full, **qc})
    limits = {"": shape, "_full": full_shape, "_qc": qc_shape}
    return d.withColumns({f"max{x}{end}": F.least(F.col(f"max{x}{end}"), F.lit(size[k]).cast("double")) for end, size in limits.items() for k, x in enumerate("rc")})


def scene_offsets(boxes: DataFrame) -> DataFrame:
    """Where each scene lies on its slide: the offset of its local coordinates, and its box."""
    whole = {f"global_{c}": F.col(f"{c}_full").cast("long") for c in ("minr", "minc", "maxr", "maxc")}
    return boxes.select("scan_region", F.col("minr_full").cast("long").alias("offset_row"), F.col("minc_full").cast("long").alias("offset_col"), *(c.alias(n) for n, c in whole.items()))


def scene_centroids(boxes: DataFrame, stem: str = "stem") -> DataFrame:
    """Box centres with what the six fields of the file name say, the scene's number and how many scenes the slide has."""
    p = F.split(stem, "_")
    names = ("slide_name", "round_id", "version_id", "project_name", "project_leader", "channel_id")
    d = boxes.withColumns({n: F.get(p, F.lit(i)) for i, n in enumerate(names)})
    d = d.withColumns({"meanr": (F.col("minr") + F.col("maxr")) / 2, "meanc": (F.col("minc") + F.col("maxc")) / 2, "project_operator": F.col("project_leader")})
    d = d.withColumn("scene_number", F.regexp_replace("scan_region", "S", "").cast("int") + 1).withColumn("QC_include", F.lit(1))
    n = d.groupBy(stem).agg(F.countDistinct("scene_number").alias("slide_number_scenes"))
    return d.join(n, stem)


def one_per_group(df: DataFrame, by: Sequence[str], order: str) -> DataFrame:
    """One row of each group: the one with the smallest ``order``, so that reruns agree."""
    return df.groupBy(*by).agg(F.min_by(F.struct(*(F.col(f"`{c}`") for c in df.columns)), order).alias("_x")).select("_x.*")


def normalise_text(x: Column) -> Column:
    """Folder names made comparable: Unicode compatibility form, dashes and spaces of all kinds as one, no spaces at the ends."""

    @F.pandas_udf("string")
    def compatible(s: pd.Series) -> pd.Series:
        return s.str.normalize("NFKC")

    dashes = F.regexp_replace(compatible(x), r"[\u2010-\u2015\u2212]", "-")
    return F.trim(F.regexp_replace(dashes, r"[\s\u00A0\u2000-\u200B\u202F\u205F\u3000]+", " "))

"""Pixel tables (image_id, r, c, v): rescaling, flat fields, masks, patches, components and features."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.graph import connected_components, least_reachable
from tessera.plans.lineage import cut, remove

AT = ("r", "c")
#: Rows of pixel tables that one task groups by pixel, about. Spark's own parts are as large as what is shuffled allows, and packed pixels are many.
TOGETHER = 1 << 19


def _image(df: DataFrame) -> list[str]:
    """The image's key, where a table holds several images."""
    return [c for c in ("image_id",) if c in df.columns]


def dealt(px: DataFrame, rows: int) -> DataFrame:
    """Pixels dealt by (r, c) to parts of about TOGETHER rows, of ``rows`` in all; two parts at least, as a single one has no key."""
    return px.repartition(max(2, -(-rows // TOGETHER)), *AT)


def rescale(px: DataFrame, q: float = 0.01, without_median: bool = False) -> DataFrame:
    """(v - lo) / (hi - lo), clipped to 0..1, by the q and 1 - q percentiles of positive pixels of each image.

    Up to ten positive pixels: unchanged; hi <= lo: 0. ``without_median`` leaves out pixels equal to the image's median.
    """
    values = px.where("v > 0")
    if without_median:
        mid = exact_quantiles(px, "image_id", "v", (0.5,)).select("image_id", F.col("q")[0].alias("mid"))
        values = values.join(mid, "image_id").where("v <> mid")
    s = exact_quantiles(values, "image_id", "v", (q, 1 - q))
    j = px.join(s, "image_id", "left")
    lo, hi = F.col("q")[0], F.col("q")[1]
    scaled = F.when(hi <= lo, 0.0).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), (F.col("v") - lo) / F.nullif(hi - lo, F.lit(0.0)))))
    return j.select("image_id", *AT, F.when(F.coalesce("n", F.lit(0)) <= 10, F.col("v")).otherwise(scaled).alias("v"))


def exact_quantiles(df: DataFrame, by: str, value: str, qs: tuple[float, ...]) -> DataFrame:
    """Rows (by, n, q): exact quantiles with linear interpolation (numpy's), from counts alone.

    A selection by digits, the highest first. The first digit is a double's sign and size on a logarithmic scale (64 steps to an octave), so
    that no outlier stretches the others' steps. Values are counted by digit, with the least and largest of each; the digit that holds a
    wanted rank is entered, and its range is cut into 4,096 equal steps, which are the next digit, until least and largest
    are one value. That is the case after at most six digits, after one or two where few values are distinct. Only counts are gathered, so
    neither a group with most of the rows nor a value that half of them have meets in one place.

    Nulls and NaN do not count; a group without values has no row. An empty table gives no rows.
    """
    d = df.select(F.col(by).alias("g"), F.col(value).cast("double").alias("x")).where("x is not null and not isnan(x)")
    size = F.when(F.abs("x") == float("inf"), 200_000).otherwise(F.floor(64 * F.log2(F.abs("x"))) + 70_400)
    first = F.when(F.col("x") == 0, 0).otherwise(F.signum("x") * size).cast("long")
    counts = d.withColumn("digit", first).groupBy("g", "digit").agg(F.count("*").alias("k"), F.min("x").alias("lo"), F.max("x").alias("hi"))
    own = Window.partitionBy("g")  # at most some thousand digits a group
    before = F.coalesce(F.sum("k").over(own.orderBy("digit").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = counts.withColumns({"n": F.sum("k").over(own), "before": before})
    ranks = F.array(*(F.struct(F.lit(i).alias("i"), F.lit(up).alias("upper"), r(F.lit(float(q)) * (F.col("n") - 1)).cast("long").alias("rank"))
                      for i, q in enumerate(qs) for up, r in ((False, F.floor), (True, F.ceil))))
    held = "rank >= before and rank < before + k"
    keep = ("g", "n", "i", "upper", "rank", "before", "lo", "hi")
    place = cut(counts.withColumn("w", F.explode(ranks)).select("g", "n", "k", "before", "lo", "hi", "w.*").where(held).select(*keep), "ranks")
    done, rows = [place.where("lo = hi")], d
    while not (open_ := place.where("lo < hi")).isEmpty():
        ranges = open_.select("g", "lo", "hi", "before").distinct()  # of a group at most two for each of qs, which do not meet
        outer, rows = rows, cut(rows.select("g", "x").join(ranges, "g").where("x between lo and hi"), "inside")
        if outer is not d:
            remove(df.sparkSession, outer._tessera_path)
        step = F.least(F.floor((F.col("x") - F.col("lo")) / (F.col("hi") - F.col("lo")) * 4096), F.lit(4095)).cast("int")
        counts = rows.withColumn("digit", step).groupBy("g", F.col("lo").alias("a"), "before", "digit").agg(F.count("*").alias("k"), F.min("x").alias("lo"), F.max("x").alias("hi"))
        inner = F.sum("k").over(Window.partitionBy("g", "a").orderBy("digit").rowsBetween(Window.unboundedPreceding, -1))
        counts = counts.withColumn("before", F.col("before") + F.coalesce(inner, F.lit(0)))
        wanted = open_.select("g", "n", "i", "upper", "rank", F.col("lo").alias("a"))
        place = cut(wanted.join(counts, ["g", "a"]).where(held).select(*keep), "ranks")
        done.append(place.where("lo = hi"))
    flat = reduce(DataFrame.unionByName, done).groupBy("g", "n", "i").agg(F.max(F.when(~F.col("upper"), F.col("lo"))).alias("a"), F.max(F.when(F.col("upper"), F.col("lo"))).alias("z"))
    share = F.element_at(F.array(*(F.lit(float(q)) for q in qs)), F.col("i") + 1) * (F.col("n") - 1)
    flat = flat.withColumn("v", F.when(F.col("a") == F.col("z"), F.col("a")).otherwise(F.col("a") + (share - F.floor(share)) * (F.col("z") - F.col("a"))))
    return flat.groupBy(F.col("g").alias(by), "n").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "v"))), lambda s: s["v"]).alias("q"))


def asinh_stretch(px: DataFrame) -> DataFrame:
    return px.withColumn("v", F.asinh(65536 * F.col("v")))


def downsample(px: DataFrame, factor: int) -> DataFrame:
    """Nearest-neighbour reduction: every ``factor``-th row and column."""
    return px.where((F.col("r") % factor == 0) & (F.col("c") % factor == 0)).withColumn("r", (F.col("r") / factor).cast("int")).withColumn("c", (F.col("c") / factor).cast("int"))


def crop(px: DataFrame, r0: int, c0: int, r1: int, c1: int) -> DataFrame:
    """Pixels of a box with exclusive upper bounds, counted from its corner."""
    inside = F.col("r").between(r0, r1 - 1) & F.col("c").between(c0, c1 - 1)
    return px.where(inside).withColumn("r", F.col("r") - r0).withColumn("c", F.col("c") - c0)


def apply_mask(px: DataFrame, foreground: DataFrame) -> DataFrame:
    """v becomes 0 outside of the (r, c) in ``foreground``."""
    f = foreground.select(*AT).distinct().withColumn("_in", F.lit(True))
    return px.join(f, list(AT), "left").withColumn("v", F.when(F.col("_in"), F.col("v")).otherwise(0.0)).drop("_in")


def flat_field(px: DataFrame) -> DataFrame:
    """v - median * vignette + median, clipped to 16 bits and truncated.

    The median is each tile's over positive pixels (the median of medians where there are none), the vignette at (r, c) the median of v / median over tiles.
    """
    m = exact_quantiles(px.where("v > 0"), "image_id", "v", (0.5,)).select("image_id", F.col("q")[0].alias("m"))
    j = px.join(m, "image_id", "left").join(F.broadcast(m.agg(F.percentile("m", F.lit(0.5)).alias("_all"))))  # one row
    j = j.withColumn("m", F.coalesce("m", "_all")).drop("_all")
    vignette = j.groupBy(*AT).agg(F.percentile(F.col("v") / F.col("m"), F.lit(0.5)).alias("vig"))
    out = j.join(vignette, list(AT)).withColumn("x", F.col("v") - F.col("m") * F.col("vig") + F.col("m"))
    return out.select("image_id", *AT, F.least(F.lit(65535), F.greatest(F.lit(0), F.col("x").cast("int"))).alias("v"))


def patches(px: DataFrame, size: int = 256) -> DataFrame:
    """Patches that hold any positive pixel."""
    p = px.groupBy("image_id", F.floor(F.col("r") / size).cast("int").alias("pr"), F.floor(F.col("c") / size).cast("int").alias("pc"))
    return p.agg(F.max("v").alias("most"), F.avg((F.col("v") > 0).cast("double")).alias("coverage")).where("most > 0")


def tissue_grid(px: DataFrame, n: int, rows: int, columns: int) -> DataFrame:
    """Share of non-zero pixels in each of n x n cells."""
    cell = lambda c, size: F.least(F.floor(F.col(c) * n / size), F.lit(n - 1)).cast("int")
    return px.groupBy("image_id", cell("r", rows).alias("gr"), cell("c", columns).alias("gc")).agg(F.avg((F.col("v") != 0).cast("double")).alias("share"))


def coverage_check(px: DataFrame, reference: str, least: float = 0.5, expected: DataFrame | None = None) -> DataFrame:
    """Images whose share of non-zero pixels is below ``least`` of the reference's are failures, as are images of ``expected`` (image_id) that are not there.

    Without the reference all images are failures.
    """
    n = px.groupBy("image_id").agg(F.avg((F.col("v") != 0).cast("double")).alias("coverage"))
    ref = n.agg(F.max(F.when(F.col("image_id") == reference, F.col("coverage"))).alias("_ref"))
    if expected is not None:
        n = n.join(expected.select("image_id").distinct(), "image_id", "full")
    failed = F.coalesce(F.col("coverage") < least * F.col("_ref"), F.lit(True))
    return n.join(F.broadcast(ref)).select("image_id", "coverage", failed.alias("failed"))  # one row


def angles(px: DataFrame, signal: str = "MS", background: str = "AF") -> DataFrame:
    """atan2(signal, background) where both are positive."""
    both = px.where(F.col("image_id").isin(signal, background) & (F.col("v") > 0)).groupBy(*AT).agg(
        F.max(F.when(F.col("image_id") == signal, F.col("v"))).alias("s"), F.max(F.when(F.col("image_id") == background, F.col("v"))).alias("b"))
    return both.where("s is not null and b is not null").select(*AT, "s", "b", F.atan2("s", "b").alias("phi"))


def angle_threshold(angle: DataFrame, most: float = 1.57) -> DataFrame:
    """One row ``threshold``: mean + 2 deviations, or, where that is above ``most``, where two components of a mixture are most alike."""
    spark, angle = angle.sparkSession, cut(angle.select("phi"), "phi")
    simple = angle.agg(F.avg("phi") + 2 * F.stddev_pop("phi")).first()[0]
    if simple is not None and simple > most:
        from tessera.operators.learning import mixture_threshold

        out = mixture_threshold(angle, "phi")
    else:
        out = spark.createDataFrame([(simple,)], "threshold double")
    remove(spark, angle._tessera_path)
    return out


def subtract_background(
    px: DataFrame, signal: str = "MS", background: str = "AF", mask: DataFrame | None = None, similarity: DataFrame | None = None, most_similar: float = 0.9,
    threshold: DataFrame | None = None,
) -> DataFrame:
    """signal - background * tan(phi), not below 0, rounded half to even; angles above the threshold count as the median of those below.

    Pixels off the ``mask`` (r, c), and those where a row of ``similarity`` (r, c, v) reaches ``most_similar``, are 0. ``threshold`` has one row; without it that of
    :func:`angle_threshold`. All tables meet in one grouping by pixel, in parts of one size (:func:`dealt`), and what follows only reads its result.
    """
    kinds = dict(px.dtypes)
    columns = {"s": kinds["v"], "b": kinds["v"], "_in": "boolean", "_same": "double"}

    def rows(df: DataFrame, **known) -> DataFrame:
        return df.select(*AT, *(known.get(c, F.lit(None)).cast(t).alias(c) for c, t in columns.items()))

    of = lambda i: F.when(F.col("image_id") == i, F.col("v"))
    every = rows(px.where(F.col("image_id").isin(signal, background) & (F.col("v") > 0)), s=of(signal), b=of(background))
    if mask is not None:
        every = every.union(rows(mask.dropna(subset=AT), _in=F.lit(True)))
    if similarity is not None:
        every = every.union(rows(similarity.dropna(subset=AT), _same=F.col("v")))
    every = cut(every, "pixels")
    wide = dealt(every, every.count()).groupBy(*AT).agg(*(F.max(c).alias(c) for c in columns)).where("s is not null and b is not null")
    a = cut(wide.select(*(F.col(c).cast(kinds[c]).alias(c) for c in AT), *columns, F.atan2("s", "b").alias("phi")), "angles")
    remove(px.sparkSession, every._tessera_path)
    t = a.join(F.broadcast(cut(threshold if threshold is not None else angle_threshold(a), "threshold")))  # one row
    mid = exact_quantiles(t.where("phi <= threshold").select(F.lit(0).alias("g"), "phi"), "g", "phi", (0.5,)).select(F.col("q")[0].alias("mid"))
    t = t.join(F.broadcast(mid), how="left").withColumn("p", F.when(F.col("phi") > F.col("threshold"), F.col("mid")).otherwise(F.col("phi")))  # one row
    v = F.bround(F.greatest(F.lit(0.0), F.col("s") - F.col("b") * F.tan("p"))).cast("long")
    if mask is not None:
        v = F.when(F.col("_in"), v).otherwise(F.lit(0))
    if similarity is not None:
        v = F.when(F.coalesce(F.col("_same") >= most_similar, F.lit(False)), F.lit(0)).otherwise(v)
    return t.select(*AT, v.cast("long").alias("v"))


def features(px: DataFrame, labels: DataFrame) -> DataFrame:
    """Per label (not 0) and image: area, mean column and row, mean value."""
    j = labels.where("OID <> 0").join(px, list(AT))
    return j.groupBy("OID", "image_id").agg(F.count("*").alias("area"), F.avg("c").alias("X"), F.avg("r").alias("Y"), F.avg("v").alias("mean_v"))


def feature_table(px: DataFrame, labels: DataFrame, markers: dict[str, str | None], scene_id: str | None = None) -> DataFrame:
    """One row per label (not 0): OID, area, X, Y[, scene_id] and the mean of each marker, ``markers`` naming the marker of each image; images of a null marker are left out."""
    named = {i: m for i, m in markers.items() if m}
    long = features(px.where(F.col("image_id").isin(*named)), labels)
    means = [F.max(F.when(F.col("image_id") == i, F.col("mean_v"))).alias(m) for i, m in named.items()]
    out = long.groupBy("OID").agg(F.max("area").alias("area"), F.max("X").alias("X"), F.max("Y").alias("Y"), *means)
    return out.withColumn("scene_id", F.lit(scene_id)) if scene_id is not None else out


def boxes(labels: DataFrame, band: int = 1024) -> DataFrame:
    """Bounding box of each label of each image, upper bounds exclusive, named S0, S1, ... in raster order of the image.

    Boxes are numbered within bands of ``band`` rows, and each band's numbers go on from the counts of those above it, so that no task sorts all objects.
    """
    by = _image(labels)
    b = labels.where("OID <> 0").groupBy(*by, "OID").agg(F.min("r").alias("minr"), F.min("c").alias("minc"), (F.max("r") + 1).alias("maxr"), (F.max("c") + 1).alias("maxc"))
    b = b.withColumn("_band", F.floor(F.col("minr") / band))
    counts = b.groupBy(*by, "_band").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.partitionBy(*by).orderBy("_band") if by else Window.orderBy("_band")) - F.col("_n")  # one row per band
    first = counts.select(*by, "_band", before.alias("_before"))
    n = F.col("_before") + F.row_number().over(Window.partitionBy(*by, "_band").orderBy("minr", "minc", "OID")) - 1
    return b.join(first, [*by, "_band"]).withColumn("scan_region", F.concat(F.lit("S"), n.cast("string"))).drop("_band", "_before")


def drop_border_labels(labels: DataFrame, border: int = 3) -> DataFrame:
    """Labels that touch the outer pixels of their image go."""
    by = _image(labels)
    size = labels.groupBy(*by).agg(F.max("r").alias("last_r"), F.max("c").alias("last_c"))
    edge = (F.col("r") < border) | (F.col("c") < border) | (F.col("r") > F.col("last_r") - border) | (F.col("c") > F.col("last_c") - border)
    sized = labels.join(size, by) if by else labels.join(F.broadcast(size))  # one row
    touching = sized.where(edge & (F.col("OID") != 0)).select(*by, "OID").distinct()
    return labels.join(touching, [*by, "OID"], "left_anti").where("OID <> 0")


def label_components(mask: DataFrame, columns: int, eight: bool = True, tile: int = 256) -> DataFrame:
    """Rows ([image_id,] r, c, component) of (r, c): connected pixels of an image share the smallest raster number among them.

    Tiles are labelled by themselves, each within one task of ``tile`` x ``tile`` places at most; only links across their borders become edges of a graph, whose nodes are the tiles' parts.
    """
    by = _image(mask)
    steps = [(0, 1), (1, 0)] + [(1, 1), (1, -1)] * eight
    m = mask.select(*by, F.col("r").cast("long").alias("r"), F.col("c").cast("long").alias("c")).distinct()
    m = m.withColumn("tr", F.floor(F.col("r") / tile)).withColumn("tc", F.floor(F.col("c") / tile))

    def label(group: pa.Table) -> pa.Table:
        r, c = (group.column(k).to_numpy() for k in AT)
        order = np.lexsort((c, r))
        group, r, c = group.take(pa.array(order)), r[order], c[order]
        grid = np.full((tile + 2, tile + 2), -1, np.int64)
        y, x = r % tile + 1, c % tile + 1
        grid[y, x] = np.arange(len(r))
        ends = [(np.flatnonzero(there >= 0), there[there >= 0]) for there in (grid[y + i, x + j] for i, j in steps)]
        root = least_reachable(len(r), np.concatenate([a for a, _ in ends]), np.concatenate([b for _, b in ends]))
        return group.append_column("part", pa.array((r * columns + c)[root]))

    kinds = dict(m.dtypes)
    parts = cut(m.groupBy(*by, "tr", "tc").applyInArrow(label, ", ".join(f"{c} {kinds[c]}" for c in m.columns) + ", part long"), "parts")
    near = F.least(F.pmod("r", F.lit(tile)), F.pmod("c", F.lit(tile)), tile - 1 - F.pmod("r", F.lit(tile)), tile - 1 - F.pmod("c", F.lit(tile))) == 0
    edge = parts.where(near)
    to = edge.select(*by, F.col("part").alias("a"), F.col("tr").alias("ar"), F.col("tc").alias("ac"), F.explode(F.array(*(F.struct((F.col("r") + i).alias("r"), (F.col("c") + j).alias("c")) for i, j in steps))).alias("n"))
    across = to.select(*by, "a", "ar", "ac", "n.r", "n.c").join(edge.select(*by, *AT, "tr", "tc", F.col("part").alias("b")), [*by, *AT]).where("ar <> tr or ac <> tc")
    node = lambda x: F.struct(*by, F.col(x).alias("n")) if by else F.col(x)
    found = connected_components(across.select(node("a").alias("a"), node("b").alias("b")))
    out = parts.join(found, node("part") == F.col("node"), "left")
    least = F.col("component.n") if by else F.col("component")
    return out.select(*by, *(F.col(c).cast("int").alias(c) for c in AT), F.coalesce(least, F.col("part")).alias("component"))


def drop_small_components(parts: DataFrame, least: Column | int) -> DataFrame:
    """Components of at least so many pixels, of each image."""
    by = [*_image(parts), "component"]
    big = parts.groupBy(*by).agg(F.count("*").alias("n")).where(F.col("n") >= least)
    return parts.join(big.select(*by), by, "left_semi")


def significant_components(parts: DataFrame, rows: int, columns: int, of_image: float = 0.001, of_foreground: float = 0.0) -> DataFrame:
    """Components of at least a share of the image's area, and of more than a share of its foreground."""
    by = _image(parts)
    n = parts.groupBy(*by, "component").agg(F.count("*").alias("n"))
    all_ = n.groupBy(*by).agg(F.sum("n").alias("all"))
    big = (n.join(all_, by) if by else n.join(F.broadcast(all_))).where((F.col("n") >= of_image * rows * columns) & (F.col("n") > of_foreground * F.col("all")))  # one row
    return parts.join(big.select(*by, "component"), [*by, "component"], "left_semi")


def fill_holes(parts: DataFrame, rows: int, columns: int) -> DataFrame:
    """Pixels (r, c) of one mask with its holes: places of its box that no path outside of the mask, along rows and columns, joins to the box's border."""
    box = parts.agg(F.min("r").alias("r0"), F.max("r").alias("r1"), F.min("c").alias("c0"), F.max("c").alias("c1")).first()
    if box is None or box["r0"] is None:
        return parts.select(*AT)
    spark = parts.sparkSession
    every = spark.range(box["r0"], box["r1"] + 1).select(F.col("id").cast("int").alias("r")).withColumn("c", F.explode(F.sequence(F.lit(box["c0"]), F.lit(box["c1"]))))
    outside = label_components(every.join(parts.select(*AT), list(AT), "left_anti"), columns, eight=False)
    border = outside.where(F.col("r").isin(box["r0"], box["r1"]) | F.col("c").isin(box["c0"], box["c1"])).select("component").distinct()
    return parts.select(*AT).union(outside.join(border, "component", "left_anti").select(*AT))


def merge_versions(px: DataFrame) -> DataFrame:
    """The image with most non-zero pixels; its holes get the mean of the others' non-zero values."""
    n = px.groupBy("image_id").agg(F.count_if(F.col("v") != 0).alias("n"))
    best = n.orderBy(F.desc("n"), "image_id").limit(1).select(F.col("image_id").alias("_best"))
    j = px.join(F.broadcast(best))  # one row
    own = F.max(F.when(F.col("image_id") == F.col("_best"), F.col("v")))
    other = F.avg(F.when((F.col("image_id") != F.col("_best")) & (F.col("v") != 0), F.col("v")))
    return j.groupBy(*AT).agg(own.alias("a"), other.alias("b")).select(*AT, F.coalesce(F.nullif("a", F.lit(0.0)), "b", F.lit(0.0)).alias("v"))


def background_medians(px: DataFrame, mask: DataFrame) -> DataFrame:
    """Median of positive pixels outside of the mask per image, the median of medians where there are none."""
    m = px.join(mask.select(*AT).distinct(), list(AT), "left_anti").where("v > 0")
    m = exact_quantiles(m, "image_id", "v", (0.5,)).select("image_id", F.col("q")[0].alias("m"))
    every = px.select("image_id").distinct().join(m, "image_id", "left").join(F.broadcast(m.agg(F.percentile("m", F.lit(0.5)).alias("_all"))))  # one row
    return every.select("image_id", F.coalesce("m", "_all").alias("median"))


def vignette(px: DataFrame, medians: DataFrame) -> DataFrame:
    j = px.join(medians, "image_id")
    return j.groupBy(*AT).agg(F.percentile(F.col("v") / F.col("median"), F.lit(0.5)).alias("vig"))


def halo_tiles(px: DataFrame, core: int, margin: int) -> DataFrame:
    """Every pixel once for each window whose core plus margin holds it: at most four windows while 2 * margin <= core."""
    near = lambda c: F.array_distinct(F.array(*(F.floor((F.col(c) + d) / core).cast("int") for d in (-margin, 0, margin))))
    d = px.withColumn("wr", F.explode(near("r"))).withColumn("wc", F.explode(near("c"))).where("wr >= 0 and wc >= 0")
    return d.withColumn("lr", F.col("r") - F.col("wr") * core + margin).withColumn("lc", F.col("c") - F.col("wc") * core + margin)


def keep_centres(windows: DataFrame, core: int, margin: int) -> DataFrame:
    """The image again from its windows, each giving its core."""
    inside = F.col("lr").between(margin, margin + core - 1) & F.col("lc").between(margin, margin + core - 1)
    return windows.where(inside).select("image_id", *AT, "v")


def high_percentile(px: DataFrame, by: list[str], q: float = 0.99) -> DataFrame:
    """The percentile of all pixels of each group, zeros included."""
    d = px.withColumn("_g", F.struct(*by))
    return exact_quantiles(d, "_g", "v", (q,)).select("_g.*", F.col("q")[0].alias("p"))


def minmax_stack(px: DataFrame, q: float | None = None) -> DataFrame:
    """Each image to 0..1 by its least and largest value; then, with ``q``, all of the set by its common q and 1 - q quantiles, clipped to 0..1."""
    s = px.groupBy("image_id").agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    scaled = F.when(F.col("hi") > F.col("lo"), (F.col("v") - F.col("lo")) / (F.col("hi") - F.col("lo"))).otherwise(0.0)
    out = px.join(s, "image_id").select("image_id", *AT, scaled.alias("v"))
    if q is None:
        return out
    common = exact_quantiles(out.withColumn("_g", F.lit(0)), "_g", "v", (q, 1 - q)).select(F.col("q")[0].alias("_lo"), F.col("q")[1].alias("_hi"))
    v = (F.col("v") - F.col("_lo")) / F.nullif(F.col("_hi") - F.col("_lo"), F.lit(0.0))
    return out.join(F.broadcast(common)).select("image_id", *AT, F.coalesce(F.least(F.lit(1.0), F.greatest(F.lit(0.0), v)), F.lit(0.0)).alias("v"))  # one row


def layer_priority(px: DataFrame, scores: DataFrame) -> DataFrame:
    """Aligned layers in one: at each place the non-zero value of the layer of highest score."""
    j = px.where("v <> 0").join(F.broadcast(scores), "image_id")  # one row per layer: dealt by layers, pixels would meet in as many tasks as there are layers
    return j.groupBy(*AT).agg(F.max_by("v", F.struct("score", "image_id")).alias("v"))


def cells_to_objects(cells: DataFrame, labels: DataFrame) -> DataFrame:
    """The label under each cell's position; outside or without one 0."""
    c = cells.withColumn("c", F.floor("X").cast("int")).withColumn("r", F.floor("Y").cast("int"))
    return c.join(labels.select(*AT, F.col("OID").alias("object")), list(AT), "left").withColumn("object", F.coalesce("object", F.lit(0)))


def window_means(px: DataFrame, radius: int = 3) -> DataFrame:
    """Mean over the square around each pixel, in two separable passes; at the border over what is there."""
    row = Window.partitionBy("image_id", "r").orderBy("c").rangeBetween(-radius, radius)
    col = Window.partitionBy("image_id", "c").orderBy("r").rangeBetween(-radius, radius)
    d = px.withColumn("_s", F.sum("v").over(row)).withColumn("_n", F.count("v").over(row))
    return d.select("image_id", *AT, (F.sum("_s").over(col) / F.sum("_n").over(col)).alias("v"))


def rescale_masked(px: DataFrame, mask: DataFrame, q: float = 0.99) -> DataFrame:
    """As :func:`rescale`, with the percentiles of pixels under the mask; where the high one is 0, those of positive pixels with 0 as low one."""
    under = px.join(mask.select(*AT).distinct(), list(AT), "left_semi")
    s = exact_quantiles(under, "image_id", "v", (1 - q, q)).withColumnRenamed("q", "a")
    positive = exact_quantiles(under.where("v > 0"), "image_id", "v", (1 - q, q)).select("image_id", F.col("n").alias("m"), F.col("q").alias("b"))
    s = s.join(positive, "image_id", "left").fillna(0, ["m"])
    again = (F.col("a")[1] == 0) & (F.col("m") > 10)
    s = s.select("image_id", "n", F.when(again, 0.0).otherwise(F.col("a")[0]).alias("lo"), F.when(again, F.col("b")[1]).otherwise(F.col("a")[1]).alias("hi"))
    scaled = F.least(F.lit(1.0), F.greatest(F.lit(0.0), (F.col("v") - F.col("lo")) / F.nullif(F.col("hi") - F.col("lo"), F.lit(0.0))))
    v = F.when(F.coalesce("n", F.lit(0)) <= 10, F.col("v")).when(F.col("hi") > F.col("lo"), scaled).otherwise(0.0)
    return px.join(s, "image_id", "left").select("image_id", *AT, v.alias("v"))


def frame(px: DataFrame, border: int) -> DataFrame:
    """Pixels further than ``border`` from the image's edge become 0."""
    size = px.groupBy("image_id").agg(F.max("r").alias("_r"), F.max("c").alias("_c"))
    edge = F.least("r", "c", F.col("_r") - F.col("r"), F.col("_c") - F.col("c"))
    return px.join(size, "image_id").select("image_id", *AT, F.when(edge < border, F.col("v")).otherwise(0.0).alias("v"))


def align(a: DataFrame, b: DataFrame) -> DataFrame:
    """Two images on one canvas: (r, c, va, vb), 0 where one of them ends."""
    one = lambda px, name: px.select(*AT, F.col("v").alias(name))
    return one(a, "va").join(one(b, "vb"), list(AT), "full").select(*AT, F.coalesce("va", F.lit(0.0)).alias("va"), F.coalesce("vb", F.lit(0.0)).alias("vb"))


def place_tiles(px: DataFrame, positions: DataFrame) -> DataFrame:
    """Pixels of tiles (tile, r, c, v) on the canvas at (tile, r0, c0); the tile of the larger number wins."""
    moved = px.join(positions, "tile").select((F.col("r") + F.col("r0")).alias("r"), (F.col("c") + F.col("c0")).alias("c"), "tile", "v")
    return moved.groupBy(*AT).agg(F.max_by("v", "tile").alias("v"), F.max("tile").alias("tile"))


def structural_similarity(px: DataFrame, a: str, b: str, radius: int = 3, data_range: float = 1.0) -> DataFrame:
    """Structural similarity of two dense images over squares, borders reflected: (r, c, v).

    Five products are averaged in two separable passes of windows over one row and one column of the image.
    """
    k1, k2 = 0.01, 0.03  # fixed values of the measure
    n = (2 * radius + 1) ** 2
    size = px.where(F.col("image_id").isin(a, b)).agg(F.max("r").alias("_r"), F.max("c").alias("_c"))
    of = lambda name: F.max(F.when(F.col("image_id") == name, F.col("v")))
    d = px.where(F.col("image_id").isin(a, b)).groupBy(*AT).agg(of(a).alias("x"), of(b).alias("y")).where("x is not null and y is not null").join(F.broadcast(size))  # one row
    for at, end in (("r", "_r"), ("c", "_c")):
        places = F.array(F.col(at), F.when(F.col(at) < radius, -1 - F.col(at)), F.when(F.col(at) > F.col(end) - radius, 2 * F.col(end) + 1 - F.col(at)))
        d = d.withColumn(at, F.explode(F.array_compact(places)))
    parts = {"x": F.col("x"), "y": F.col("y"), "xx": F.col("x") * F.col("x"), "yy": F.col("y") * F.col("y"), "xy": F.col("x") * F.col("y")}
    row, col = (Window.partitionBy(p).orderBy(o).rangeBetween(-radius, radius) for p, o in (("r", "c"), ("c", "r")))
    d = d.select(*AT, "_r", "_c", *(F.sum(e).over(row).alias(k) for k, e in parts.items()))
    d = d.select(*AT, "_r", "_c", *((F.sum(k).over(col) / n).alias(k) for k in parts)).where("r between 0 and _r and c between 0 and _c")
    e = {k: F.col(k) for k in parts}
    f, c1, c2 = n / (n - 1), (k1 * data_range) ** 2, (k2 * data_range) ** 2
    vx, vy, vxy = f * (e["xx"] - e["x"] * e["x"]), f * (e["yy"] - e["y"] * e["y"]), f * (e["xy"] - e["x"] * e["y"])
    top = (2 * e["x"] * e["y"] + c1) * (2 * vxy + c2)
    return d.select(*AT, (top / ((e["x"] * e["x"] + e["y"] * e["y"] + c1) * (vx + vy + c2))).alias("v"))


def angle_histogram(angle: DataFrame, width: float = 0.01, bins: int = 157, reach: int = 2, block: int = 4096) -> DataFrame:
    """Histogram, normed to 100, of the moving mean of ``phi`` along (r, c); at the ends over what is there.

    Positions in raster order come from the counts of rows, so that the mean is taken in blocks with a margin and no window spans the image.
    """
    rows = angle.groupBy("r").agg(F.count("*").alias("n"))
    before = rows.select("r", (F.sum("n").over(Window.orderBy("r")) - F.col("n")).alias("before"))  # one row per image row
    d = angle.join(before, "r").withColumn("i", F.col("before") + F.row_number().over(Window.partitionBy("r").orderBy("c")) - 1)
    near = F.array_distinct(F.array(*(F.floor((F.col("i") + k) / block) for k in (-reach, 0, reach))))
    d = d.select("i", "phi", F.explode(near).alias("b"))
    d = d.withColumn("m", F.avg("phi").over(Window.partitionBy("b").orderBy("i").rangeBetween(-reach, reach))).where(F.floor(F.col("i") / block) == F.col("b"))
    h = d.where((F.col("m") >= 0) & (F.col("m") <= width * bins)).groupBy(F.least(F.floor(F.col("m") / width), F.lit(bins - 1)).cast("int").alias("bin")).agg(F.count("*").alias("n"))
    return h.join(F.broadcast(h.agg(F.sum("n").alias("all")))).select("bin", "n", (100 * F.col("n") / F.col("all")).alias("share"))  # one row


def blend(predictions: DataFrame, size: int) -> DataFrame:
    """Of (r, c, lr, lc, class, p) from overlapping tiles the class with the largest mean, weighted by a two-dimensional Hann window."""
    hann = lambda x: 0.5 - 0.5 * F.cos(2 * F.lit(3.141592653589793) * F.col(x) / (size - 1))
    d = predictions.withColumn("w", hann("lr") * hann("lc"))
    mean = d.groupBy(*AT, "class").agg((F.sum(F.col("w") * F.col("p")) / F.greatest(F.sum("w"), F.lit(1e-6))).alias("p"))
    return mean.groupBy(*AT).agg(F.min_by("class", F.struct(-F.col("p"), "class")).alias("class"), F.max("p").alias("p"))


def recode_classes(best: DataFrame, codes: dict[int, int], least: float = 0.5) -> DataFrame:
    """Classes below ``least`` become 0, the others what ``codes`` says, or stay."""
    code = F.coalesce(F.create_map(*(F.lit(x) for kv in codes.items() for x in kv))[F.col("class")], F.col("class"))
    return best.select(*AT, F.when(F.col("p") < least, 0).otherwise(code).alias("class"))


def largest_component(parts: DataFrame) -> DataFrame:
    """Pixels of each image's component with most pixels; the smaller label wins ties. :func:`fill_holes` closes it."""
    by = _image(parts)
    best = parts.groupBy(*by, "component").agg(F.count("*").alias("n")).groupBy(*by).agg(F.min_by("component", F.struct(-F.col("n"), "component")).alias("component"))
    return parts.join(best, [*by, "component"], "left_semi")


def paint(labels: DataFrame, colours: DataFrame) -> DataFrame:
    """Labels grown by one pixel (the larger label wins), with their colour; pixels with another label beside them are black."""
    offsets = F.array(*(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)))
    spread = labels.where("OID <> 0").withColumn("o", F.explode(offsets)).select((F.col("r") + F.col("o.i")).alias("r"), (F.col("c") + F.col("o.j")).alias("c"), "OID")
    grown = spread.groupBy(*AT).agg(F.max("OID").alias("OID"))
    cross = F.array(*(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i, j in ((0, 0), (0, 1), (0, -1), (1, 0), (-1, 0))))
    seen = grown.withColumn("o", F.explode(cross)).select((F.col("r") + F.col("o.i")).alias("r"), (F.col("c") + F.col("o.j")).alias("c"), "OID", (F.expr("o.i = 0 and o.j = 0")).alias("own"))
    edge = seen.groupBy(*AT).agg(F.max(F.when(F.col("own"), F.col("OID"))).alias("OID"), (F.min("OID") != F.max("OID")).alias("edge")).where("OID is not null")
    return edge.join(colours, "OID", "left").select(*AT, "OID", F.when(F.col("edge"), "black").otherwise(F.coalesce("colour", F.lit("grey"))).alias("colour"))


def paint_rgb(labels: DataFrame, colours: DataFrame) -> DataFrame:
    """As :func:`paint`, with colours (OID, red, green, blue): a label's colours are summed and clipped at 255; labels without one and pixels with another label beside them are black."""
    summed = colours.groupBy("OID").agg(*(F.least(F.lit(255), F.sum(c)).cast("int").alias(c) for c in ("red", "green", "blue")))
    flat = paint(labels, summed.select("OID", F.lit("own").alias("colour")))
    shown = lambda c: F.when(F.col("colour") == "own", F.col(c)).otherwise(F.lit(0)).alias(c)
    return flat.join(summed, "OID", "left").select(*AT, "OID", *map(shown, ("red", "green", "blue")))


def crop_or_pad(px: DataFrame, rows: int, columns: int) -> DataFrame:
    """Each image centred on a canvas of a given size, cut or filled with zeros: (image_id, r, c, v, offset_r, offset_c).

    The offsets are added to the old places; rows that a padded canvas lacks are not stored, zero being the value of what is not there.
    """
    size = px.groupBy("image_id").agg((F.max("r") + 1).alias("_r"), (F.max("c") + 1).alias("_c"))
    half = lambda want, c: F.floor((F.lit(want) - F.col(c)) / 2).cast("int")
    d = px.join(size.select("image_id", half(rows, "_r").alias("offset_r"), half(columns, "_c").alias("offset_c")), "image_id")
    d = d.select("image_id", (F.col("r") + F.col("offset_r")).alias("r"), (F.col("c") + F.col("offset_c")).alias("c"), "v", "offset_r", "offset_c")
    return d.where(F.col("r").between(0, rows - 1) & F.col("c").between(0, columns - 1))


def middle_tile(px: DataFrame, rows: int, columns: int) -> DataFrame:
    """The middle tile of a canvas of three by three tiles, counted from its corner."""
    return crop(px, rows, columns, 2 * rows, 2 * columns)


def two_pass_layers(px: DataFrame, scores: DataFrame, border: int = 20) -> DataFrame:
    """Aligned layers in one, best score first, each without a frame of ``border`` pixels; a layer fills what is still zero: (r, c, v)."""
    return layer_priority(frame_trimmed(px, border), scores)


def frame_trimmed(px: DataFrame, border: int) -> DataFrame:
    """Pixels that are not in a frame of ``border`` pixels around what is not zero of each image."""
    box = px.where("v <> 0").groupBy("image_id").agg(*(f(c).alias(f"_{k}{c}") for c in AT for k, f in (("lo", F.min), ("hi", F.max))))
    inside = [F.col(c).between(F.col(f"_lo{c}") + border, F.col(f"_hi{c}") - border) for c in AT]
    return px.join(box, "image_id").where(inside[0] & inside[1]).select("image_id", *AT, "v")


def offset_labels(labels: DataFrame) -> DataFrame:
    """Labels of overlapping windows (window, r, c, OID) made unique: (r, c, OID), zeros left out.

    A window's labels are raised by the largest labels of all windows before it; those that touch a place which an earlier window has labelled go.
    One row per window takes part in the running sum.
    """
    from pyspark.sql import Window as W

    most = labels.groupBy("window").agg(F.max("OID").alias("_m"))
    before = most.select("window", (F.sum("_m").over(W.orderBy("window")) - F.col("_m")).alias("_b"))  # one row per window
    d = labels.where("OID <> 0")
    first = d.groupBy(*AT).agg(F.min("window").alias("_first"))
    clash = d.join(first, list(AT)).where("window > _first").select("window", "OID").distinct()
    kept = d.join(clash, ["window", "OID"], "left_anti").join(before, "window")
    return kept.select(*AT, (F.col("OID") + F.col("_b")).alias("OID"))


def field_method(images: DataFrame, methods: DataFrame) -> DataFrame:
    """Flat-field method of each image by technology and channel; null where the table has none."""
    return images.join(methods, ["technology", "channel"], "left")


def patch_score_table(scores: DataFrame) -> DataFrame:
    """Scores (pr, pc, score) that are not zero, in raster order."""
    return scores.where("score <> 0").select(F.col("pr").alias("tmp_row"), F.col("pc").alias("tmp_column"), "score").orderBy("tmp_row", "tmp_column")


def _nearest_within(places: DataFrame, targets: DataFrame, reach: int) -> DataFrame:
    """(r, c, distance) of places that have a target within ``reach``: targets spread over the disc around them."""
    disc = [(i, j, (i * i + j * j) ** 0.5) for i in range(-reach, reach + 1) for j in range(-reach, reach + 1) if i * i + j * j <= reach * reach]
    o = F.explode(F.array(*(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), F.lit(d).alias("d")) for i, j, d in disc)))
    spread = targets.select("r", "c", o.alias("o")).select((F.col("r") + F.col("o.i")).alias("r"), (F.col("c") + F.col("o.j")).alias("c"), F.col("o.d").alias("d"))
    return places.select(*AT).join(spread.groupBy(*AT).agg(F.min("d").alias("distance")), list(AT))


def _rim(places: DataFrame, others: DataFrame) -> DataFrame:
    """Those of ``places`` with one of ``others`` beside them; the nearest of them to anything outside is one of these."""
    o = F.explode(F.array(*(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1) if i or j)))
    near = others.select("r", "c", o.alias("o")).select((F.col("r") + F.col("o.i")).alias("r"), (F.col("c") + F.col("o.j")).alias("c")).distinct()
    return places.select(*AT).join(near, list(AT), "left_semi")


def match_versions(reference: DataFrame, others: DataFrame, reach: int = 10, least: int = 200, most: float = 65535.0) -> DataFrame:
    """Holes (zeros) of a reference (r, c, v) filled from other versions (image_id, r, c, v), fitted to it and feathered: (r, c, v).

    The fit v = a * other + b, a not negative, is over the ring of up to ``reach`` pixels around the holes and all versions' non-zero pixels there, if these are
    more than ``least``. A hole's pixel gets the mean of the non-zero others, fitted, clipped and weighted by its distance to the hole's rim, up to 1 at ``reach``.
    """
    hole, solid = reference.where("v = 0").select(*AT), reference.where("v <> 0")
    ring = _nearest_within(solid, _rim(hole, solid), reach).select(*AT)
    fit = others.where("v > 0").select(*AT, F.col("v").alias("x")).join(solid, list(AT)).join(ring, list(AT), "left_semi")
    fit = fit.agg(F.regr_slope("v", "x").alias("a"), F.regr_intercept("v", "x").alias("b"), F.count("*").alias("n"))
    enough = F.col("n") > least
    fit = fit.select(F.when(enough, F.greatest(F.col("a"), F.lit(0.0))).otherwise(1.0).alias("a"), F.when(enough, F.col("b")).otherwise(0.0).alias("b"))
    mean = others.where("v > 0").join(hole, list(AT), "left_semi").groupBy(*AT).agg(F.avg("v").alias("m"))
    deep = _nearest_within(hole, _rim(solid, hole), reach)
    filled = mean.join(deep, list(AT), "left").join(F.broadcast(fit))  # one row
    alpha = F.least(F.coalesce(F.col("distance") / reach, F.lit(1.0)), F.lit(1.0))
    filled = filled.select(*AT, (alpha * F.least(F.lit(most), F.greatest(F.lit(0.0), F.col("a") * F.col("m") + F.col("b")))).alias("f"))
    return reference.join(filled, list(AT), "left").select(*AT, F.coalesce("f", "v").alias("v"))


def warp_all(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Dynamic time warping distances, with absolute differences, of many series of one length (k, n) to one series: a step takes an anti-diagonal of all of them."""
    k, n, m = *a.shape, len(b)
    one, two = np.full((k, n + 1), np.inf), np.full((k, n + 1), np.inf)  # the last two diagonals, by place in a plus one
    for d in range(n + m - 1):
        i = np.arange(max(0, d - m + 1), min(n - 1, d) + 1)
        least = np.minimum(np.minimum(one[:, i + 1], one[:, i]), two[:, i]) if d else 0.0
        new = np.full((k, n + 1), np.inf)
        new[:, i + 1] = np.abs(a[:, i] - b[d - i]) + least
        one, two = new, one
    return one[:, n]


def least_warp(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A lower bound of :func:`warp_all`: each value of one series is met by some value of the other, the nearest at best."""

    def nearest(x: np.ndarray, values: np.ndarray) -> np.ndarray:
        at = np.searchsorted(values, x)
        return np.minimum(np.abs(x - values[np.minimum(at, len(values) - 1)]), np.abs(x - values[np.maximum(at - 1, 0)]))

    there = nearest(a.ravel(), np.sort(b)).reshape(a.shape).sum(axis=1)
    back = np.array([nearest(b, np.sort(x)).sum() for x in a])
    return np.maximum(there, back)


def nearest_medoid(histograms: DataFrame, medoids: DataFrame) -> DataFrame:
    """For each image's histogram (image_id, bin, share) the class of the nearest medoid (class, bin, value) by dynamic time warping with absolute differences.

    The first class by name wins ties. Images of as many bins are warped together, and only against medoids that a lower bound does not put beyond the nearest so far. An
    image has a few hundred bins at most; medoids are a handful of rows per class, and go along with each task. Null shares and a null image count as no bin. Without medoids there are no rows.
    """
    known: dict[str, list[float]] = {}
    for r in medoids.where("value is not null").orderBy("class", "bin").collect():
        known.setdefault(r["class"], []).append(float(r["value"]))
    series = [(c, np.array(v)) for c, v in sorted(known.items())]

    def nearest(batches):
        for batch in batches:
            ids, shares = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            found: list[tuple] = [(None, np.inf)] * len(ids)
            for n in {len(x) for x in shares}:
                own = [k for k, x in enumerate(shares) if len(x) == n]
                a, best, which = np.array([shares[k] for k in own], float), np.full(len(own), np.inf), np.zeros(len(own), int)
                for c, (_, v) in enumerate(series):
                    open_ = np.flatnonzero(least_warp(a, v) <= best + 1e-9)
                    if len(open_):
                        d = warp_all(a[open_], v)
                        nearer = open_[d < best[open_]]
                        best[nearer], which[nearer] = d[d < best[open_]], c
                for k, c, d in zip(own, which.tolist(), best.tolist(), strict=True):
                    found[k] = series[c][0], d
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([c for c, _ in found], pa.string()), pa.array([d for _, d in found], pa.float64())], names=["image_id", "class", "distance"])

    bins = F.sort_array(F.collect_list(F.struct("bin", F.col("share").cast("double").alias("share"))))  # a few hundred
    rows = histograms.where("share is not null and image_id is not null").groupBy("image_id").agg(bins.alias("b")).select(F.col("image_id").cast("string").alias("image_id"), F.transform("b", lambda x: x["share"]).alias("v"))
    return (rows if series else rows.limit(0)).mapInArrow(nearest, "image_id string, class string, distance double")

"""Summaries of clusters, annotations and markers."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.plans.lineage import cut

from tessera.operators.cells import KEY, first_by_hash, quoted, unpivot_markers



def confusion_matrix(clusters: DataFrame) -> DataFrame:
    """Dense label x sample grid per method: N distinct cells, Jaccard and Dice (0 where nothing is there)."""
    # each cell's labels meet once; the first of them counts the cell for its sample
    cells = clusters.groupBy("cl_method", *KEY).agg(F.collect_set(F.struct("cluster")).alias("l"))
    each = cells.select("cl_method", "sample_id", F.posexplode("l").alias("i", "x")).select("cl_method", "x.cluster", "sample_id", "i")
    counts = cut(each.groupBy("cl_method", "cluster", "sample_id").agg(F.count("*").alias("N"), F.count_if(F.col("i") == 0).alias("first")), "counts")
    n = counts.drop("first")
    # a cell's key holds its sample, so a label's distinct cells add up over samples
    labels = n.groupBy("cl_method", "cluster").agg(F.sum("N").alias("n_label"))
    samples = counts.groupBy("cl_method", "sample_id").agg(F.sum("first").alias("n_sample"))
    grid = labels.join(samples, "cl_method").join(n, ["cl_method", "cluster", "sample_id"], "left").fillna(0, ["N"])
    union, both = F.col("n_label") + F.col("n_sample") - F.col("N"), F.col("n_label") + F.col("n_sample")
    return grid.select(
        "cl_method", "cluster", "sample_id", "N", F.when(union > 0, F.col("N") / union).otherwise(0.0).alias("J"),
        F.when(both > 0, 2 * F.col("N") / both).otherwise(0.0).alias("dice"))


def cluster_percentages(clusters: DataFrame) -> DataFrame:
    n = clusters.groupBy("cl_method", "cluster").agg(F.count("*").alias("n"))
    return n.withColumn("percentage", 100 * F.col("n") / F.sum("n").over(Window.partitionBy("cl_method")))


def cluster_sample_counts(mapped: DataFrame, source: str = "full") -> DataFrame:
    """Ncells, mean confidence and share of high-confidence cells per sample, method and cluster."""
    high = F.avg((F.col("status") == "high_confidence").cast("double"))
    return mapped.groupBy("sample_id", "cl_method", "cluster").agg(
        F.count("*").alias("Ncells"), F.avg("confidence").alias("mean_confidence"), high.alias("fraction_high")).withColumn("source", F.lit(source))


def mapped_summary(mapped: DataFrame) -> DataFrame:
    """Cells, mean confidence and, where there is one, mean margin per method, cluster and status."""
    means = [F.avg(c).alias(f"mean_{c}") for c in ("confidence", "margin") if c in mapped.columns]
    return mapped.groupBy("cl_method", "cluster", "status").agg(F.count("*").alias("n"), *means)


def marker_summary(cells: DataFrame, clusters: DataFrame, markers: Sequence[str]) -> DataFrame:
    """Per method, cluster and marker: mean, share above the marker's midpoint (min + max) / 2, and n."""
    mid = cells.agg(*((F.min(quoted(m)) + F.max(quoted(m))).alias(m) for m in markers))
    mid = mid.select(*((quoted(m) / 2).alias(f"_{m}") for m in markers))
    joined = cells.select(*KEY, *(quoted(m) for m in markers)).join(clusters, list(KEY)).join(F.broadcast(mid))  # one row
    aggs = [x for m in markers for x in (F.avg(quoted(m)).alias(f"mean_{m}"), F.avg((quoted(m) > quoted(f"_{m}")).cast("double")).alias(f"above_{m}"), F.count(quoted(m)).alias(f"n_{m}"))]
    wide = joined.groupBy("cl_method", "cluster").agg(*aggs)
    rows = [F.struct(F.lit(m).alias("marker"), quoted(f"mean_{m}").alias("mean"), quoted(f"above_{m}").alias("fraction_above"), quoted(f"n_{m}").alias("n")) for m in markers]
    return wide.select("cl_method", "cluster", F.explode(F.array(*rows)).alias("x")).select("cl_method", "cluster", "x.*")


def fill_dictionary(dictionary: DataFrame) -> DataFrame:
    """A blank annotation is the cluster itself."""
    return dictionary.withColumn("annotation", F.coalesce(F.nullif(F.trim("annotation"), F.lit("")), F.col("cluster")))


def annotate(clusters: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Left join of annotations by method and cluster, falling back to the cluster. Repeated entries multiply rows."""
    d = fill_dictionary(dictionary).select("cl_method", "cluster", "annotation")
    return clusters.join(d, ["cl_method", "cluster"], "left").withColumn("annotation", F.coalesce("annotation", "cluster"))


def annotation_marker_summary(summary: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Cluster rows merged by annotation: means weighted by n, and the clusters that went in."""
    weighted = lambda c: F.sum(F.col(c) * F.col("n")) / F.nullif(F.sum("n"), F.lit(0))
    return annotate(summary, dictionary).groupBy("cl_method", "annotation", "marker").agg(
        weighted("mean").alias("mean"), weighted("fraction_above").alias("fraction_above"), F.sum("n").alias("n"),
        F.array_join(F.sort_array(F.collect_set("cluster")), ",").alias("clusters_merged"))


def enrichment(counts: DataFrame, label: str = "cluster") -> DataFrame:
    """Over-representation of labels in samples, per method, over the full grid of (cl_method, label, sample_id, n).

    One-sided hypergeometric P(X >= a), adjusted by Benjamini-Hochberg over the method's grid. Log factorials come from a running
    sum in blocks, so no window is without partitions; the tail is summed inside the row.
    """
    labels = counts.groupBy("cl_method", label).agg(F.sum("n").alias("n_label"))
    samples = counts.groupBy("cl_method", "sample_id").agg(F.sum("n").alias("n_sample"))
    totals = counts.groupBy("cl_method").agg(F.sum("n").alias("total"))
    grid = labels.join(samples, "cl_method").join(totals, "cl_method").join(counts, ["cl_method", label, "sample_id"], "left").fillna(0, ["n"])
    grid = grid.withColumn("p_value", F.when(F.col("n") <= 0, 1.0).otherwise(hypergeometric_tail("n", "n_label", "n_sample", "total")))
    grid = bh_adjust(grid, "p_value", ["cl_method"], [label, "sample_id"])
    expected = F.col("n_sample") * F.col("n_label") / F.col("total")
    log2 = F.log2((F.col("n") + 0.5) / (F.col("expected") + 0.5))
    return grid.withColumn("expected", expected).select(
        "cl_method", label, "sample_id", "n", "expected", "p_value", "q_value", log2.alias("log2_enrichment"),
        (100 * F.col("n") / F.col("n_label")).alias("pct_of_label"), (100 * F.col("n") / F.col("n_sample")).alias("pct_of_sample"),
        (-F.log10(F.greatest("q_value", F.lit(1e-300))) * F.greatest(log2, F.lit(0.0))).alias("score"))


def _log_factorial(x: Column) -> Column:
    """Stirling's series from 10 on (error below 1e-11), exact products before."""
    small = F.log(F.element_at(F.array(*(F.lit(float(v)) for v in (1, 1, 2, 6, 24, 120, 720, 5040, 40320, 362880))), (F.least(x, F.lit(9)) + 1).cast("int")))
    y = x + F.lit(1.0)
    series = (y - 0.5) * F.log(y) - y + 0.9189385332046727 + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5)
    return F.when(x < 10, small).otherwise(series)


def hypergeometric_tail(a: str, label: str, sample: str, total: str) -> Column:
    """P(X >= a): above the mean the upper tail, else 1 less the lower one, each relative to its largest term, whose logarithm is added.

    Terms fall at least as a normal curve's with the same variance or as exp(-3 k / 2), so that after 11 standard
    deviations and 100 terms none counts in doubles; the sum stops there.
    """
    K, n, N, x = (F.col(c).cast("double") for c in (label, sample, total, a))
    choose = lambda p, q: _log_factorial(p) - _log_factorial(q) - _log_factorial(p - q)
    log_pmf = lambda k: choose(K, k) + choose(N - K, n - k) - choose(N, n)
    variance = n * K / N * (1 - K / N) * (N - n) / F.greatest(N - 1, F.lit(1.0))
    reach = (11 * F.sqrt(F.greatest(variance, F.lit(0.0))) + 100).cast("long")
    low = F.greatest(F.lit(0).cast("long"), F.col(sample) + F.col(label) - F.col(total))
    up = lambda k: (K - k) * (n - k) / ((k + 1) * (N - K - n + k + 1))
    down = lambda k: k * (N - K - n + k) / ((K - k + 1) * (n - k + 1))

    def log_sum(start: Column, end: Column, step: int, ratio) -> Column:
        def add(acc: Column, k: Column) -> Column:
            return F.struct((acc["s"] + acc["t"]).alias("s"), (acc["t"] * ratio(k)).alias("t"))
        terms = F.aggregate(F.sequence(start, end, F.lit(step).cast("long")), F.struct(F.lit(0.0).alias("s"), F.lit(1.0).alias("t")), add, lambda acc: acc["s"])
        return log_pmf(start.cast("double")) + F.log(terms)

    at = F.col(a).cast("long")
    upper = F.exp(log_sum(at, F.least(F.col(label), F.col(sample), at + reach), 1, up))
    lower = F.exp(log_sum(at - 1, F.greatest(low, at - 1 - reach), -1, down))
    tail = F.when(at <= low, 1.0).when(x > n * K / N, upper).otherwise(1 - lower)
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), tail))


def bh_adjust(df: DataFrame, p: str, by: Sequence[str], ties: Sequence[str]) -> DataFrame:
    """Adds q_value: min over larger p of p * n / rank, at most 1; NaN and null p count as 1.

    Rows are sorted by range, so that one group may fill any number of tasks: a range's ranks go on from the counts of those before it, and its
    least value takes in those of the ranges behind it. Only counts and minima of ranges, one row for each group and range, meet in one place.
    """
    by, columns = list(by), df.columns
    value = F.coalesce(F.nanvl(F.col(p), F.lit(1.0)), F.lit(1.0))
    order = [*by, "_p", *ties]
    d = df.withColumn("_p", value).repartitionByRange(*order).sortWithinPartitions(*order)
    d = cut(d.withColumn("_range", F.spark_partition_id()), "ranges")
    ranges = d.groupBy(*by, "_range").agg(F.count("*").alias("_k"))
    whole, earlier = Window.partitionBy(*by), Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.withColumns({"_n": F.sum("_k").over(whole), "_before": F.coalesce(F.sum("_k").over(earlier), F.lit(0))}).drop("_k")
    here = Window.partitionBy(*by, "_range").orderBy("_p", *ties)
    met = lambda t, u: t.alias("x").join(u.alias("y"), [F.col(f"x.{c}").eqNullSafe(F.col(f"y.{c}")) for c in [*by, "_range"]])
    ranked = met(d, ranges).select(*(F.col(f"x.`{c}`") for c in [*columns, "_p", "_range"]), "_n", "_before")
    ranked = ranked.withColumn("_r", F.col("_before") + F.row_number().over(here)).withColumn("_v", F.col("_p") * F.col("_n") / F.col("_r"))
    ranked = ranked.withColumn("_v", F.min("_v").over(here.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
    least = ranked.groupBy(*by, "_range").agg(F.min("_v").alias("_least"))
    behind = Window.partitionBy(*by).orderBy("_range").rowsBetween(1, Window.unboundedFollowing)
    least = least.select(*by, "_range", F.min("_least").over(behind).alias("_behind"))
    return met(ranked, least).select(*(F.col(f"x.`{c}`") for c in columns), F.least(F.lit(1.0), "_v", "_behind").alias("q_value"))


def jaccard_methods(annotated: DataFrame, x: str, y: str) -> DataFrame:
    """Jaccard of every label of method x with every label of method y, over cells that both have."""
    side = lambda m, c: annotated.where(F.col("cl_method") == m).select(*KEY, F.col("annotation").alias(c)).distinct()
    both = side(x, "label_x").join(side(y, "label_y"), list(KEY))
    n = both.groupBy("label_x", "label_y").agg(F.count("*").alias("n"))
    left, right = n.groupBy("label_x").agg(F.sum("n").alias("n_x")), n.groupBy("label_y").agg(F.sum("n").alias("n_y"))
    grid = left.join(F.broadcast(right)).join(n, ["label_x", "label_y"], "left").fillna(0, ["n"])  # labels by labels
    return grid.withColumn("jaccard", F.col("n") / (F.col("n_x") + F.col("n_y") - F.col("n")))


def jaccard_table(annotated: DataFrame) -> DataFrame:
    """For each pair of methods (the first by name as x) the Jaccard of their labels over cells that both have, on the union of their label names, with margins.

    Rows and columns ``Total`` hold the counts of the other side's labels; their Jaccard is 0. Each cell's labels, a few for each method, meet once, and pairs are made of them there.
    """
    side = lambda x: F.explode("l").alias(x)
    methods = ["method_x", "method_y"]
    # a null key or method pairs with nothing
    cells = annotated.dropna("any", subset=[*KEY, "cl_method"]).groupBy(*KEY).agg(F.collect_set(F.struct("cl_method", "annotation")).alias("l"))
    both = cells.select("l", side("x")).select("x", side("y")).where("x.cl_method < y.cl_method")
    both = both.select(F.col("x.cl_method").alias("method_x"), F.col("y.cl_method").alias("method_y"), F.col("x.annotation").alias("label_x"), F.col("y.annotation").alias("label_y"))
    n = both.groupBy(*methods, "label_x", "label_y").agg(F.count("*").alias("n"))
    left, right = n.groupBy(*methods, "label_x").agg(F.sum("n").alias("n_x")), n.groupBy(*methods, "label_y").agg(F.sum("n").alias("n_y"))
    names = left.select(*methods, F.col("label_x").alias("l")).union(right.select(*methods, "label_y")).distinct()
    grid = names.withColumnRenamed("l", "label_x").join(names.withColumnRenamed("l", "label_y"), methods)
    grid = grid.join(n, [*methods, "label_x", "label_y"], "left").join(left, [*methods, "label_x"], "left").join(right, [*methods, "label_y"], "left").fillna(0, ["n", "n_x", "n_y"])
    union = F.col("n_x") + F.col("n_y") - F.col("n")
    grid = grid.select(*methods, "label_x", "label_y", "n", "n_x", "n_y", F.when(union > 0, F.col("n") / union).otherwise(0.0).alias("jaccard"))
    zero, all_ = F.lit(0.0).alias("jaccard"), n.groupBy(*methods).agg(F.sum("n").alias("t"))
    column = grid.select(*methods, "label_x", "n_x").distinct().join(all_, methods).select(*methods, "label_x", F.lit("Total").alias("label_y"), F.col("n_x").alias("n"), "n_x", F.col("t").alias("n_y"), zero)
    row = grid.select(*methods, "label_y", "n_y").distinct().join(all_, methods).select(*methods, F.lit("Total").alias("label_x"), "label_y", F.col("n_y").alias("n"), F.col("t").alias("n_x"), "n_y", zero)
    corner = all_.select(*methods, F.lit("Total").alias("label_x"), F.lit("Total").alias("label_y"), F.col("t").alias("n"), F.col("t").alias("n_x"), F.col("t").alias("n_y"), zero)
    return grid.unionByName(column).unionByName(row).unionByName(corner)


def jaccard_best(jaccard: DataFrame) -> DataFrame:
    w = Window.partitionBy("label_x").orderBy(F.desc("jaccard"), "label_y")
    return jaccard.where("jaccard > 0").withColumn("_n", F.row_number().over(w)).where("_n = 1").select("label_x", "label_y", "jaccard")


def consensus(annotated: DataFrame) -> DataFrame:
    """Cells whose label (text before the first _) more than half of all methods share."""
    votes = annotated.withColumn("label", F.split("annotation", "_")[0])
    methods = annotated.agg(F.countDistinct("cl_method").alias("methods"))
    n = votes.groupBy(*KEY, "label").agg(F.size(F.collect_set("cl_method")).cast("long").alias("votes"))  # a few names: one shuffle instead of two
    return n.join(F.broadcast(methods)).where("2 * votes > methods").select(*KEY, F.col("label").alias("CellType"), "votes")  # one row


def fingerprints(cells: DataFrame, markers: Sequence[str], label: str = "CellType") -> DataFrame:
    return cells.groupBy(label).agg(F.count("*").alias("n"), *(F.avg(quoted(m)).alias(m) for m in markers))


def medians(df: DataFrame, by: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Exact medians per group; see :func:`tessera.operators.pixels.exact_quantiles`."""
    from tessera.operators.pixels import exact_quantiles

    d, out = cut(df.select(F.struct(*by).alias("_g"), *map(quoted, values)), "values"), None  # read several times by each value
    for v in values:
        m = exact_quantiles(d.select("_g", quoted(v).alias("_v")), "_g", "_v", (0.5,)).select("_g", F.col("q")[0].alias(v))
        out = m if out is None else out.join(m, "_g", "full")
    return out.select("_g.*", *(quoted(v) for v in values))


def marker_ranges(df: DataFrame, markers: Sequence[str], low: float = 0.01, high: float = 0.99) -> DataFrame:
    """Linear quantiles; min and max where they are equal; then a width of 1e-6; [0, 1] for no values."""
    long = unpivot_markers(df, (), markers)
    from tessera.operators.pixels import exact_quantiles

    ends = long.groupBy("marker").agg(F.min("value").alias("a"), F.max("value").alias("b"))
    q = ends.join(exact_quantiles(long, "marker", "value", (low, high)), "marker", "left")
    flat = F.col("q")[0] == F.col("q")[1]
    lo, hi = F.when(flat, F.col("a")).otherwise(F.col("q")[0]), F.when(flat, F.col("b")).otherwise(F.col("q")[1])
    return q.select("marker", F.coalesce(lo, F.lit(0.0)).alias("lo"), F.coalesce(F.when(lo == hi, hi + 1e-6).otherwise(hi), F.lit(1.0)).alias("hi"))


def top_markers(cells: DataFrame, clusters: DataFrame, markers: Sequence[str], top: int = 10) -> DataFrame:
    """Mean inside and outside of each cluster; the ``top`` markers by mean inside."""
    value = lambda m: quoted(m).cast("double")
    sums = cells.join(clusters, list(KEY)).groupBy("cl_method", "cluster").agg(*(f(value(m)).alias(f"{x}{i}") for i, m in enumerate(markers) for x, f in (("s", F.sum), ("n", F.count))))
    rows = F.array(*(F.struct(F.lit(m).alias("marker"), F.col(f"s{i}").alias("s"), F.col(f"n{i}").alias("n")) for i, m in enumerate(markers)))  # sums, not cells, by marker
    part = sums.select("cl_method", "cluster", F.inline(rows))
    whole = Window.partitionBy("cl_method", "marker")
    part = part.withColumn("_s", F.sum("s").over(whole)).withColumn("_n", F.sum("n").over(whole))
    out = part.select("cl_method", "cluster", "marker", (F.col("s") / F.col("n")).alias("mean_in"), ((F.col("_s") - F.col("s")) / F.nullif(F.col("_n") - F.col("n"), F.lit(0))).alias("mean_out"))
    w = Window.partitionBy("cl_method", "cluster").orderBy(F.desc_nulls_last("mean_in"), "marker")
    return out.withColumn("delta", F.col("mean_in") - F.col("mean_out")).withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top)


def density2d(df: DataFrame, x: str, y: str, x_range: tuple[float, float], y_range: tuple[float, float], bins: int = 96, by: Sequence[str] = ()) -> DataFrame:
    """log1p of a 2-D histogram; values outside are dropped, the last edge is inside. Sparse: empty bins have no row."""
    def at(c: str, lo: float, hi: float) -> Column:
        return F.least(F.floor((quoted(c) - lo) / (hi - lo) * bins), F.lit(bins - 1)).cast("int")
    inside = quoted(x).between(*x_range) & quoted(y).between(*y_range)
    n = df.where(inside).groupBy(*by, at(x, *x_range).alias("ix"), at(y, *y_range).alias("iy")).agg(F.count("*").alias("n"))
    return n.withColumn("z", F.log1p("n"))


def density_pairs(cells: DataFrame, clusters: DataFrame, ranges: dict[str, tuple[float, float]], top: int = 10, bins: int = 96) -> DataFrame:
    """For each cluster and pair of its top markers the densities of the cluster, of all other cells and of all, and their difference.

    Rows (cl_method, cluster, x_marker, y_marker, ix, iy, z, z_other, z_all, diff = z - z_other) of the bins that any cell of the method is in. ``ranges`` gives each marker's
    range. A cell is counted once for each pair of markers, whatever the number of clusters.
    """
    markers = sorted(ranges)
    best = top_markers(cells, clusters, markers, top).select("cl_method", "cluster", "marker")
    pairs = best.withColumnRenamed("marker", "x_marker").join(best.withColumnRenamed("marker", "y_marker"), ["cl_method", "cluster"]).where("x_marker < y_marker")
    d = cells.join(clusters, list(KEY))

    def bin_of(m: str) -> Column:
        lo, hi = ranges[m]
        at = F.least(F.floor((quoted(m) - lo) / (hi - lo) * bins), F.lit(bins - 1)).cast("int")
        return F.when(quoted(m).between(lo, hi), at)

    places = F.array(*(F.struct(F.lit(x).alias("x_marker"), F.lit(y).alias("y_marker"), bin_of(x).alias("ix"), bin_of(y).alias("iy")) for i, x in enumerate(markers) for y in markers[i + 1 :]))
    n = d.select("cl_method", "cluster", F.explode(places).alias("p")).where("p.ix is not null and p.iy is not null").groupBy("cl_method", "cluster", "p").agg(F.count("*").alias("n"))
    n = n.select("cl_method", "cluster", "p.*", "n")
    at = ["cl_method", "x_marker", "y_marker", "ix", "iy"]
    every = n.groupBy(*at).agg(F.sum("n").alias("all"))
    out = pairs.join(every, ["cl_method", "x_marker", "y_marker"]).join(n, ["cluster", *at], "left").fillna(0, ["n"])
    z, other = F.log1p("n"), F.log1p(F.col("all") - F.col("n"))
    return out.select("cl_method", "cluster", "x_marker", "y_marker", "ix", "iy", z.alias("z"), other.alias("z_other"), F.log1p("all").alias("z_all"), (z - other).alias("diff"))


def rank_markers(means: DataFrame, percentages: DataFrame, top: int = 15) -> DataFrame:
    """The ``top`` markers of each cluster by mean (cl_method, cluster, marker, mean, rank), and its percentage as one row more, ``Percentage``, after the last rank."""
    by = ["cl_method", "cluster"]
    ranked = means.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(F.desc_nulls_last("mean"), "marker"))).where(F.col("rank") <= top)
    last = ranked.groupBy(*by).agg((F.max("rank") + 1).alias("rank"))
    share = percentages.join(last, by).select(*by, F.lit("Percentage").alias("marker"), F.col("percentage").alias("mean"), "rank")
    return ranked.select(*by, "marker", "mean", "rank").unionByName(share)


def conflicts(annotations: DataFrame, label: str = "CellType") -> DataFrame:
    """Cells with several annotations keep the globally rarest (all of them on ties), with all in ``conflict_id``. Labels are names of cell types: few, and not dealt by them, as cells would meet in as few tasks."""
    n = annotations.groupBy(label).agg(F.count("*").alias("_global"))
    w = Window.partitionBy(*KEY)
    a = annotations.join(F.broadcast(n), label).withColumn("_k", F.count("*").over(w)).where("_k > 1")
    a = a.withColumn("conflict_id", F.array_join(F.array_sort(F.collect_list(label).over(w)), "___")).withColumn("_least", F.min("_global").over(w))
    return a.where("_global = _least").select(*KEY, label, "conflict_id")


def size_rank_labels(df: DataFrame, label: str, least: int = 10) -> DataFrame:
    """Labels renumbered by falling size from 0; those of at most ``least`` rows become -1."""
    n = df.groupBy(label).agg(F.count("*").alias("n"))
    return n.withColumn("new_label", F.when(F.col("n") <= least, -1).otherwise(F.row_number().over(Window.orderBy(F.desc("n"), label)) - 1))


def annotation_sample_counts(counts: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Counts of (sample_id, cl_method, cluster, Ncells, mean_confidence, fraction_high, source) by annotation; shares weighted by cells."""
    d = counts.join(dictionary.select("cl_method", "cluster", "annotation"), ["cl_method", "cluster"], "left").withColumn("annotation", F.coalesce("annotation", "cluster"))
    weighted = lambda c: (F.sum(F.col(c) * F.col("Ncells")) / F.sum("Ncells")).alias(c)
    return d.groupBy("sample_id", "cl_method", "annotation").agg(
        F.sum("Ncells").alias("Ncells"), F.array_join(F.array_sort(F.collect_set("cluster")), ",").alias("clusters_merged"),
        weighted("mean_confidence"), weighted("fraction_high"), F.min("source").alias("source"))


def annotation_state(dictionary: DataFrame) -> DataFrame:
    """One row ``state``: the dictionary's records and their mapping as JSON. A dictionary holds the clusters of a few methods."""
    r = F.array_sort(F.collect_list(F.struct("cl_method", "cluster", "annotation")))
    entries = F.transform("r", lambda x: F.struct(F.concat(x["cl_method"], F.lit("|"), x["cluster"]), x["annotation"]))
    return dictionary.agg(r.alias("r")).select(F.to_json(F.struct(F.col("r").alias("clusters"), F.map_from_entries(entries).alias("mapping"))).alias("state"))


def plot_quotas(df: DataFrame, most: int, by: str = "cluster") -> DataFrame:
    """Rows to draw per label: proportional, rounded half to even, at least one, at most all."""
    n = df.groupBy(by).agg(F.count("*").alias("n"))
    total = n.agg(F.sum("n").alias("total"))
    k = F.least(F.col("n"), F.greatest(F.lit(1), F.bround(most * (F.col("n") / F.col("total"))).cast("long")))
    return n.join(F.broadcast(total)).select(by, "n", F.when(F.col("total") <= most, F.col("n")).otherwise(k).alias("k"))  # one row


def plot_sample(df: DataFrame, most: int, by: str = "cluster", ids: Sequence[str] = ("sample_id", "OID"), seed: int = 1234) -> DataFrame:
    """The rows of :func:`plot_quotas` in hash order, trimmed to ``most``."""
    d = first_by_hash(df, plot_quotas(df, most, by).select(by, "k"), by, ids, seed)
    return d.orderBy(F.xxhash64(*ids, F.lit(seed)), *ids).limit(most)


def columns_by_mean(df: DataFrame, markers: Sequence[str]) -> DataFrame:
    """Markers and their means, largest first. Values are summed as decimals, so that the order of rows does not enter."""
    total = lambda m: F.sum(quoted(m).cast("decimal(28,9)")).cast("double") / F.count(quoted(m))
    rows = df.agg(*(total(m).alias(f"m{i}") for i, m in enumerate(markers)))
    pairs = F.array(*(F.struct(F.lit(m).alias("marker"), F.col(f"m{i}").alias("mean")) for i, m in enumerate(markers)))
    return rows.select(F.explode(pairs).alias("x")).select("x.*").orderBy(F.desc("mean"), "marker")


def smooth_density(density: DataFrame, bins: int, sigma: float = 1.0, reach: int = 3) -> DataFrame:
    """Gaussian smoothing of (ix, iy, n); beyond the border the nearest bin counts.

    Each bin gives its count to the bins around it; a bin at the border gives also what the copies of it beyond would give.
    """
    weights = [math.exp(-k * k / (2 * sigma * sigma)) for k in range(-reach, reach + 1)]
    total = sum(weights)

    def spread(d: DataFrame, at: str) -> DataFrame:
        copies = F.filter(F.sequence(F.lit(-reach), F.lit(bins - 1 + reach)), lambda x: F.least(F.greatest(x, F.lit(0)), F.lit(bins - 1)) == F.col(at))
        d = d.withColumn("_x", F.explode(copies)).withColumn("_k", F.explode(F.sequence(F.lit(-reach), F.lit(reach))))
        w = F.element_at(F.array(*(F.lit(x / total) for x in weights)), F.col("_k") + reach + 1)
        d = d.withColumn("n", F.col("n") * w).withColumn(at, F.col("_x") + F.col("_k")).where(F.col(at).between(0, bins - 1))
        return d.groupBy("ix", "iy").agg(F.sum("n").alias("n"))

    return spread(spread(density.select("ix", "iy", F.col("n").cast("double").alias("n")), "ix"), "iy")

"""Cells labelled from a sample: nearest-neighbour mapping of clusters and cell types, and the joins that prepare it.

Cells are keyed by (sample_id, OID); ``vector`` is a column of coordinates or markers.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators import cells as C
from tessera.operators import neighbours as N
from tessera.operators.cells import KEY, quoted
from tessera.operators.summaries import density2d, fill_dictionary, fingerprints
from tessera.plans.lineage import cut


def cell_id() -> Column:
    """One string for the composite key."""
    return F.concat_ws("|", *KEY)


def stack_tables(tables: Sequence[DataFrame | None], columns: Sequence[str], blanks: Sequence[str] = KEY) -> DataFrame:
    """Optional tables of one kind, one under the other: ids and labels trimmed, other columns dropped.

    A table that is None is absent; no table at all, a missing column, and null or blank values of ``blanks`` are errors.
    """
    given = [t for t in tables if t is not None]
    if not given:
        raise ValueError("none of the tables is given")
    for t in given:
        if missing := [c for c in columns if c not in t.columns]:
            raise ValueError(f"missing columns: {missing}")
    out = None
    for t in given:
        t = t.select(*(F.trim(quoted(c)).alias(c) if dict(t.dtypes)[c] == "string" else quoted(c) for c in columns))
        out = t if out is None else out.unionByName(t)
    return C.validate_ids(out, blanks)


#: Words that stand for the absence of an optional input.
ABSENT = ("", "not included", "none", "null", "na")


def is_included(value: str | None) -> bool:
    """Whether an optional input is given: some words, in any case and with space around them, stand for its absence."""
    return value is not None and value.strip().lower() not in ABSENT


def included(value: Column) -> Column:
    """:func:`is_included` of a column."""
    return value.isNotNull() & ~F.lower(F.trim(value)).isin(*ABSENT)


def embedding_clusters(embedding: DataFrame, clusters: DataFrame) -> DataFrame:
    """Inner join of (ids, dr_method, X, Y) with (ids, cl_method, cluster): the points that plots draw."""
    return embedding.select(*KEY, "dr_method", "X", "Y").join(clusters.select(*KEY, "cl_method", "cluster"), list(KEY))


def cluster_reference(embedding: DataFrame, clusters: DataFrame) -> DataFrame:
    """The points of one clustering; an error unless ``clusters`` holds exactly one method."""
    methods = [r[0] for r in clusters.select("cl_method").distinct().limit(2).collect()]
    if len(methods) != 1:
        raise ValueError(f"exactly one clustering method is needed, found {methods or 'none'}")
    return embedding.join(clusters.select(*KEY, "cl_method", "cluster"), list(KEY))


def consensus_reference(cells: DataFrame, consensus: DataFrame, noise: str = "NOISE") -> DataFrame:
    """Inner join of cells with their agreed type; blank types and noise go, no cell left is an error."""
    named = consensus.where(~C.blank("CellType") & (F.col("CellType") != noise)).select(*KEY, F.trim("CellType").alias("CellType"))
    out = cut(cells.join(named, list(KEY)), "agreed")  # once: the guard would shuffle all cells a second time
    if out.isEmpty():
        raise ValueError("no cell has an agreed type")
    return out


def _vote(cells: DataFrame, reference: DataFrame, label: str, k: int, vector: str, largest_wins: bool) -> DataFrame:
    """Vote of the k nearest reference cells: ids, label, second, confidence, margin, n_neighbors."""
    points = lambda t: t.select(cell_id().alias("OID"), F.col(vector).alias("embedding"))
    near = N.knn(points(cells), points(reference), k)
    votes = N.vote(near, reference.select(cell_id().alias("neighbour"), F.col(label).alias("label")), largest_wins)
    return cells.select(*KEY, cell_id().alias("query")).join(votes, "query").drop("query")


def map_clusters(cells: DataFrame, reference: DataFrame, k: int = 25, vector: str = "vector", high: float = 0.80, medium: float = 0.60) -> DataFrame:
    """Every cell gets the cluster of most of its k nearest cells of a clustered sample, in coordinates that both have.

    ``reference`` has (ids, vector, cl_method, cluster) of one method. Ties go to the smallest cluster.
    """
    methods = reference.select("cl_method").distinct()
    v = _vote(cells, reference, "cluster", k, vector, False)
    return v.join(F.broadcast(methods.limit(1))).select(  # one row
        *KEY, "cl_method", F.col("label").alias("cluster_mapped"), F.col("second").alias("cluster_second"), F.col("confidence").alias("cluster_confidence"),
        F.col("margin").alias("cluster_margin"), C.status_bucket(F.col("confidence"), high, medium).alias("cluster_prediction_status"), "n_neighbors")


def knn_classify(train: DataFrame, test: DataFrame, k: int = 25, vector: str = "vector", label: str = "CellType") -> DataFrame:
    """Types of test cells by the vote of their k nearest training cells; ties go to the largest label."""
    return _vote(test, train, label, k, vector, True).select(*KEY, F.col("label").alias(label), F.col("confidence").alias("prediction_confidence"))


def refine_reference(reference: DataFrame, k: int = 25, vector: str = "vector", least_confidence: float = 0.60, least_margin: float = 0.10) -> DataFrame:
    """The reference with (refined, status): see :func:`tessera.operators.neighbours.refine`."""
    points = reference.select(cell_id().alias("OID"), F.col(vector).alias("embedding"), "CellType")
    found = N.refine(points, k, least_confidence, least_margin).select("query", "refined", "status")
    return reference.withColumn("query", cell_id()).join(found, "query").drop("query")


def refinement_summary(refined: DataFrame) -> DataFrame:
    return refined.groupBy("CellType", "refined", "status").agg(F.count("*").alias("n"))


def map_fingerprints(
    cells: DataFrame, reference: DataFrame, markers: Sequence[str] = (), k: int = 25, vector: str = "vector", most: int = 500, seed: int = 1234,
    high: float = 0.80, medium: float = 0.60, node_id: str = "n01", version_id: str = "v01",
) -> dict[str, DataFrame]:
    """Types of all cells from a reference of agreed types: balance it, refine it by its own neighbours, then predict.

    Gives ``reference`` (refined), ``summary`` of the refinement, ``fingerprints`` of the refined types over ``markers``,
    ``predictions`` (ids, CellType, second, confidence, margin, status, node and version) and ``counts`` by type.
    """
    refined = refine_reference(C.balanced_sample(reference, most, seed=seed), k, vector)
    types = refined.drop("CellType").withColumnRenamed("refined", "CellType")
    v = _vote(cells, types, "CellType", k, vector, True)
    predictions = v.select(
        *KEY, F.col("label").alias("CellType"), F.col("second").alias("CellType_second"), F.col("confidence").alias("prediction_confidence"),
        F.col("margin").alias("prediction_margin"), C.status_bucket(F.col("confidence"), high, medium).alias("prediction_status"),
        F.lit(node_id).alias("node_id"), F.lit(version_id).alias("version_id"))
    return {
        "reference": refined, "summary": refinement_summary(refined), "fingerprints": fingerprints(types, markers),
        "predictions": predictions, "counts": type_counts(predictions)}


def type_counts(annotations: DataFrame) -> DataFrame:
    """Cells per type, nulls included, with include = 1 for a user to edit."""
    return annotations.groupBy("CellType").agg(F.count("*").alias("n")).withColumn("include", F.lit(1))


def enrichment_pivot(enrichment: DataFrame, labels: Sequence[str], label: str = "cluster") -> DataFrame:
    """Sample by label matrix of log2 enrichment; missing cells are 0."""
    wide = enrichment.groupBy("sample_id").pivot(label, list(labels)).agg(F.first("log2_enrichment"))
    return wide.fillna(0.0)


def population_clusters(dictionary: DataFrame, method: str, annotation: str) -> DataFrame:
    """The clusters of a method that an annotation stands for."""
    return fill_dictionary(dictionary).where((F.col("cl_method") == method) & (F.col("annotation") == annotation)).select("cl_method", "cluster").distinct()


def density_population(
    cells: DataFrame, population: DataFrame, x: str, y: str, x_range: tuple[float, float], y_range: tuple[float, float], bins: int = 96, against_all: bool = False,
) -> DataFrame:
    """Densities of a population of clusters (cl_method, cluster) and of its background, and their difference: (ix, iy, z, z_background, diff).

    ``cells`` has cl_method and cluster; the background is all other cells of the methods, or all. Bins with neither have no row.
    """
    methods = population.select("cl_method").distinct()
    own = population.select("cl_method", "cluster").distinct().withColumn("_own", F.lit(True))
    d = cells.join(methods, "cl_method", "left_semi").join(own, ["cl_method", "cluster"], "left").withColumn("_own", F.coalesce("_own", F.lit(False)))
    n = density2d(d, x, y, x_range, y_range, bins, ("_own",))
    count = lambda c: F.log1p(F.sum(F.when(c, F.col("n")).otherwise(F.lit(0))))
    background = F.lit(True) if against_all else ~F.col("_own")
    out = n.groupBy("ix", "iy").agg(count(F.col("_own")).alias("z"), count(background).alias("z_background"))
    return out.withColumn("diff", F.col("z") - F.col("z_background"))


def three_inputs(cells: DataFrame, masks: DataFrame, images: DataFrame, tissue: str = "tissue") -> DataFrame:
    """Inner join of three listings by tissue; a tissue that one of them has twice or lacks is an error."""
    counted = None
    for i, t in enumerate((cells, masks, images)):
        n = t.groupBy(tissue).agg(F.count("*").alias(f"n{i}"))
        counted = n if counted is None else counted.join(n, tissue, "full")
    wrong = counted.fillna(0).where(F.greatest("n0", "n1", "n2") > 1)
    if twice := [r[0] for r in wrong.select(tissue).orderBy(tissue).limit(20).collect()]:
        raise ValueError(f"listed more than once: {twice}")
    if lost := [r[0] for r in counted.fillna(0).where(F.least("n0", "n1", "n2") == 0).select(tissue).orderBy(tissue).limit(20).collect()]:
        raise ValueError(f"not in all three listings: {lost}")
    return cells.join(masks, tissue).join(images, tissue)

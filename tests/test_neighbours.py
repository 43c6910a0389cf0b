"""Nearest neighbours through cells against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import neighbours as N


def table(spark, x, first=0):
    return spark.createDataFrame([(str(first + i), v.tolist()) for i, v in enumerate(x)], "OID string, embedding array<double>")


def brute(q, r, k, skip=False):
    out = set()
    for i, v in enumerate(q):
        d = np.sqrt(((r - v) ** 2).sum(axis=1))
        near = sorted((round(float(d[j]), 9), str(j)) for j in range(len(r)) if not (skip and i == j))[:k]
        out |= {(str(i), j, n) for n, (_, j) in enumerate(near, 1)}
    return out


def data(kind, n, dim, seed=1):
    rng = np.random.default_rng(seed)
    if kind == "clusters":
        return rng.normal(0, 20, (12, dim))[rng.integers(0, 12, n)] + rng.normal(0, 0.3, (n, dim))
    if kind == "sphere":  # all about as far from each other: bounds exclude nothing
        x = rng.normal(0, 1, (n, dim))
        return x / np.linalg.norm(x, axis=1, keepdims=True)
    if kind == "grid":  # many ties
        return rng.integers(0, 3, (n, dim)).astype(float)
    return np.repeat(rng.normal(0, 1, (3, dim)), n // 3, axis=0)  # three vectors, each many times


@pytest.mark.parametrize("kind", ["clusters", "sphere", "grid", "copies"])
def test_exact_whatever_the_bounds_exclude(spark, kind):
    x, y = data(kind, 240, 6, 2), data(kind, 60, 6, 3)
    got = {(r["query"], r.neighbour, r["rank"]) for r in N.knn(table(spark, y), table(spark, x), 7, block=16, most_pivots=40).collect()}
    assert got == brute(y, x, 7)
    own = {(r["query"], r.neighbour, r["rank"]) for r in N.knn(table(spark, x[:90]), table(spark, x[:90]), 5, skip_self=True, block=8, most_pivots=10).collect()}
    assert own == brute(x[:90], x[:90], 5, True)


def test_clustered_queries_meet_few_cells_and_spread_ones_all(spark):
    cells, met = N.cells_met(table(spark, data("clusters", 200, 8, 5)), table(spark, data("clusters", 800, 8, 5)), 5, block=64)
    assert cells >= 40 and met < cells / 3
    cells, met = N.cells_met(table(spark, data("sphere", 100, 40, 6)), table(spark, data("sphere", 400, 40, 7)), 5, block=64)
    assert met > 0.9 * cells


def test_few_or_no_references(spark):
    x = data("clusters", 3, 4)
    assert N.knn(table(spark, x), table(spark, x[:0]), 3).count() == 0 and N.knn(table(spark, x[:0]), table(spark, x), 3).count() == 0
    assert N.knn(table(spark, x), table(spark, x), 10).count() == 9


def test_a_query_goes_to_a_group_of_cells_once(spark):
    x = table(spark, data("sphere", 600, 12, 9))
    cells = N.Cells(N._rows(x, "OID", "embedding"), 64, 40, 600)
    n = [int(cells.n[cells.group == g].sum()) for g in set(cells.group.tolist())]
    assert len(cells.pivots) == 38 and 1 < len(n) < 20 and sum(n) == 600 and max(n) <= cells.held
    routed = N._routed(N._rows(x, "OID", "embedding").withColumn("limit", F.lit(9.0)), cells, True)  # a limit that excludes nothing
    assert routed.count() == 600 * (len(n) - 1) == routed.select("id", "group").distinct().count()

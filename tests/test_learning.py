"""Spark's estimators against plain arithmetic on small tables."""

import json

import numpy as np
from pyspark.sql import functions as F

from tessera.operators import learning as L
from tessera.operators import pairing as R
from tessera.operators import summaries as S


def test_pca2_equals_eigenvectors(spark):
    x = np.random.default_rng(3).normal(size=(60, 3)) * [5, 2, 0.5] + [9, -4, 1]
    df = spark.createDataFrame([(str(i), *map(float, r)) for i, r in enumerate(x)], "OID string, a double, b double, c double")
    got = {r["OID"]: (r["X"], r["Y"]) for r in L.pca2(df, ("a", "b", "c"), ("OID",)).collect()}
    z = x - x.mean(axis=0)
    axes = np.linalg.eigh(z.T @ z)[1][:, ::-1][:, :2]
    axes = axes * np.sign(axes[np.abs(axes).argmax(axis=0), range(2)])
    assert np.allclose([got[str(i)] for i in range(60)], z @ axes)


def test_kmeans_finds_separate_groups(spark):
    df = spark.range(90).select(F.col("id").cast("string").alias("OID"), (F.col("id") % 3 * 100 + F.col("id") / 100).alias("a"), F.lit(1.0).alias("b"))
    got = L.kmeans(df, ("a", "b"), ("OID",), 3, restarts=3).collect()
    assert len({(int(r["OID"]) % 3, r["cluster"]) for r in got}) == 3 and len(got) == 90


def _jobs(spark, group, f):
    spark.sparkContext.setJobGroup(group, group)
    try:
        f()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_kmeans_takes_its_restarts_through_the_same_rounds(spark):
    x = np.random.default_rng(8).uniform(0, 100, 2000)
    df = spark.createDataFrame([(str(i), float(v)) for i, v in enumerate(x)], "OID string, a double").cache()
    one, eight = (_jobs(spark, f"kmeans {n}", lambda n=n: L.kmeans(df, ("a",), ("OID",), 4, restarts=n).count()) for n in (1, 8))
    assert eight < 4 * one


def test_kmeans_rounds_are_those_of_all_points(spark, monkeypatch):
    monkeypatch.setattr(L, "BOX", 16)
    rng = np.random.default_rng(9)
    x = np.concatenate([rng.normal(m, s, (700, 2)) for m, s in ((0, 9), (20, 9), (45, 3))]) + 1000
    n = rng.integers(1, 5, len(x)).astype(float)
    counts = spark.createDataFrame([(float(a), float(b), float(w)) for (a, b), w in zip(x, n, strict=True)], "x0 double, x1 double, _n double")
    boxes = L._boxes(counts, ("x0", "x1"), len(x)).persist()
    starts = [x[rng.choice(len(x), 5, replace=False)] for _ in range(4)]
    settled, whole = [], L._settled
    monkeypatch.setattr(L, "_settled", lambda *a: settled.append(whole(*a)) or settled[-1])

    def plain(c):
        for _ in range(300):
            apart = np.square(x[:, None] - c).sum(axis=2)
            at = apart.argmin(axis=1)
            new = np.array([np.average(x[at == j], axis=0, weights=n[at == j]) for j in range(5)])
            c, moved = new, np.sqrt(np.square(new - c).sum(axis=1).max())
            if moved <= 1e-4:
                break
        return (n * apart.min(axis=1)).sum(), c

    ends = [plain(c) for c in starts]
    got = L._lloyd(boxes, starts, n.sum(), 300, 1e-4)
    assert np.allclose(got, min(ends, key=lambda e: e[0])[1], atol=1e-9) and settled
    for c, (_, want) in zip(starts, ends, strict=True):
        assert np.allclose(L._lloyd(boxes, [c], n.sum(), 300, 1e-4), want, atol=1e-9)
    sums = L._sums(boxes, {0: got})[0]
    assert np.isclose(sums[:, 1].sum(), min(e[0] for e in ends)) and sums[:, 0].sum() == n.sum()
    boxes.unpersist()


def test_kmeans_of_few_and_of_odd_rows(spark):
    df = spark.createDataFrame([("1", 1.0, 2), ("2", 1.0, 2), ("3", 5.0, 2), ("4", None, 2), ("5", float("nan"), 2)], "OID string, `a.b` double, c int")
    got = {r.OID: r.cluster for r in L.kmeans(df, ("a.b", "c"), ("OID",), 4, restarts=2).collect()}
    assert got["1"] == got["2"] != got["3"] and len(got) == 3
    same = spark.range(50).select(F.col("id").cast("string").alias("OID"), (F.col("id") % 3 * 0.1).alias("a"))
    assert len({r.cluster for r in L.kmeans(same, ("a",), ("OID",), 3, restarts=2).collect()}) == 3
    assert {r.cluster for r in L.kmeans(same, ("a",), ("OID",), 1, restarts=2).collect()} == {"0"}


def test_mixture_threshold_lies_between(spark):
    x = np.random.default_rng(4).normal(size=600)
    df = spark.createDataFrame([(float(v + (8 if i % 2 else 0)),) for i, v in enumerate(x)], "phi double")
    assert 3 < L.mixture_threshold(df, "phi").first()[0] < 5


def test_annotation_state_and_extended_pairs(spark):
    d = spark.createDataFrame([("k", "1", "B"), ("k", "0", "T")], "cl_method string, cluster string, annotation string")
    state = json.loads(S.annotation_state(d).first()[0])
    assert state["mapping"] == {"k|0": "T", "k|1": "B"} and [r["cluster"] for r in state["clusters"]] == ["0", "1"]
    pairs = spark.createDataFrame([(1, 2, 9.0), (1, 3, 4.0)], "a int, b int, area double")
    near = spark.createDataFrame([(2, 1), (2, 3), (2, 5)], "tile int, other int")
    assert [tuple(r) for r in R.neighbours_of_best(pairs, near).collect()] == [(1, 5, 2)]

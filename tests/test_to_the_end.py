"""Fits, communities, q-values and votes that read all rows and run to their end."""

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import learning as L
from tessera.operators import neighbours as N
from tessera.operators import overlaps as O
from tessera.operators import summaries as S
from tessera.operators.graph import connected_components


def direct_fit(x, rounds=4000):
    m = np.array([x.min(), x.max()])
    for _ in range(200):
        side = x <= m.mean()
        m = np.array([x[side].mean(), x[~side].mean()])
    w, v = np.array([side.mean(), 1 - side.mean()]), np.array([x[side].var(), x[~side].var()])
    for _ in range(rounds):
        p = w / np.sqrt(2 * np.pi * v) * np.exp(-((x[:, None] - m) ** 2) / (2 * v))
        r = p / p.sum(axis=1, keepdims=True)
        w, m = r.mean(axis=0), (r * x[:, None]).sum(axis=0) / r.sum(axis=0)
        v = (r * (x[:, None] - m) ** 2).sum(axis=0) / r.sum(axis=0)
    return w, m, np.sqrt(v)


def test_mixture_against_a_direct_fit(spark):
    rng = np.random.default_rng(4)
    x = np.round(np.concatenate([rng.normal(2, 1, 900), rng.normal(7, 0.5, 300)]), 2)
    df = spark.createDataFrame([(float(v),) for v in x] + [(None,), (float("nan"),)], "v double")
    counts = df.where("v is not null and not isnan(v)").groupBy(F.col("v").alias("x")).agg(F.count("*").alias("n"))
    got = L.fit_two_normals(counts, least_gain=1e-12)
    for a, b in zip(got, direct_fit(x), strict=True):
        assert np.allclose(a, b, atol=2e-3)
    first, again = (L.mixture_threshold(df.repartition(k), "v").first()[0] for k in (1, 3))
    assert first == again and 4 < first < 7
    with pytest.raises(ValueError):
        L.fit_two_normals(counts, least_gain=0.0, most_rounds=2)


def test_mixture_of_few_values(spark):
    one = spark.createDataFrame([(3.0,)] * 5, "v double")
    assert L.mixture_threshold(one.limit(0), "v").first()[0] is None
    assert L.mixture_threshold(one, "v").first()[0] in (None, 3.0)


def test_communities_are_connected_and_at_least_as_good_as_planted(spark):
    rng = random.Random(6)
    group = {i: i % 5 for i in range(60)}
    e = [(str(a), str(b), 1.0) for a, b in itertools.combinations(range(60), 2) if rng.random() < (0.5 if group[a] == group[b] else 0.03)]
    e += [("x", "y", 2.0), ("lone", "lone", 1.0)]
    edges = spark.createDataFrame(e, "a string, b string, weight double")
    got = {r.node: r.community for r in L.communities(edges).collect()}
    assert set(got) == {str(i) for i in range(60)} | {"x", "y", "lone"} and got["x"] == got["y"] != got["lone"]
    inside = edges.where("a <> b").join(spark.createDataFrame(list(got.items()), "a string, ca string"), "a").join(spark.createDataFrame(list(got.items()), "b string, cb string"), "b").where("ca = cb")
    parts = {r.node: r.component for r in connected_components(inside.select("a", "b")).collect()}
    assert len({(c, parts.get(n, n)) for n, c in got.items()}) == len(set(got.values()))
    q = lambda labels: N.modularity(edges.where("a <> b"), spark.createDataFrame(labels, "node string, community string")).first().q
    planted = [(str(i), str(group[i])) for i in range(60)] + [("x", "x"), ("y", "x")]
    assert q([(n, c) for n, c in got.items() if n != "lone"]) >= q(planted) - 1e-9


def test_communities_of_nothing(spark):
    assert L.communities(spark.createDataFrame([], "a string, b string, weight double")).count() == 0


@pytest.mark.parametrize("coalesce", ["true", "false"])
def test_q_values_over_ranges(spark, coalesce):
    rng = random.Random(8)
    rows = [(m, k, rng.choice([rng.random(), 0.5, 1.0, None, float("nan")])) for m in ("a", "b", None) for k in range(700 if m == "a" else 5)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesce)
    try:
        got = {(r.m, r.k): r.q_value for r in S.bh_adjust(spark.createDataFrame(rows, "m string, k int, p double"), "p", ["m"], ["k"]).collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    for m in ("a", "b", None):
        own = sorted((1.0 if p is None or math.isnan(p) else p, k) for n, k, p in rows if n == m)
        least = 1.0
        for rank in range(len(own), 0, -1):
            least = min(least, own[rank - 1][0] * len(own) / rank)
            assert abs(got[m, own[rank - 1][1]] - least) < 1e-12
    assert len(got) == len(rows)


def plain_consensus(rows):
    out = {}
    for pair in {r[0] for r in rows}:
        clusters = []
        for _, m, dx, dy, angle in sorted((r for r in rows if r[0] == pair and r[4] is not None and abs(r[4]) <= 10), key=lambda r: r[1]):
            far = [sum(math.dist((dx, dy), o[1:]) for o in c) / len(c) for c in clusters]
            if far and min(far) <= 10:
                clusters[far.index(min(far))] += [(m, dx, dy)] * (2 if m in O.DOUBLE else 1)
            else:
                clusters.append([(m, dx, dy)])
        votes = max(map(len, clusters), default=0)
        best = [e for c in clusters if len(c) == votes for e in c if votes >= 3 and e[0] in O.PRIORITY]
        first = min(best, key=lambda e: O.PRIORITY.index(e[0]), default=(None, None, None))
        out[pair] = (*first, votes)
    return out


def test_consensus_in_columns_equals_the_plain_form(spark):
    rng = random.Random(3)
    rows = [(pair, m, float(rng.randrange(-12, 12)), float(rng.randrange(-6, 6)), rng.choice([0.0, 3.0, -9.0, 10.0, 11.0, None])) for pair in range(120) for m in (*O.PRIORITY, "other") if rng.random() < 0.8]
    df = O.transform_consensus(spark.createDataFrame(rows, "pair long, method string, dx double, dy double, angle double"))
    assert {r.pair: (r.method, r.dx, r.dy, r.votes) for r in df.collect()} == plain_consensus(rows)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_rounds_of_moving_shuffle_no_links_again_and_tell_their_modularity(spark, monkeypatch):
    e = [(f"n{a}", f"n{b}", 1.0 + (a + b) % 2) for a, b in itertools.combinations(range(12), 2) if a // 4 == b // 4 or (a, b) in ((3, 4), (7, 8))]
    edges = spark.createDataFrame(e, "a string, b string, weight double")
    cut, moved, plans, labels, told = L.cut, L._moved, [], [], []

    def seen(df, name):
        if name == "communities":
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        return cut(df, name)

    def watched(links, label, *more):
        labels.append(label.select("node", "community").collect())
        told.append(moved(links, label, *more))
        return told[-1]

    monkeypatch.setattr(L, "cut", seen)
    monkeypatch.setattr(L, "_moved", watched)
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # tables too large for Spark to broadcast by itself
    try:
        got = L.communities(edges, least_gain=0.1)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    assert len({r.community for r in got.collect()}) == 3
    again = [x for x in plans[1].splitlines() if "Exchange hashpartitioning(b#" in x and "REPARTITION" not in x]
    assert "InMemoryTableScan" in plans[1] and len(again) == 1  # of the labels
    total = 2 * sum(w for *_, w in e)
    for before, (_, inside, squares) in zip(labels[:3], told[:3], strict=True):
        assert abs(inside / total - squares / total**2 - N.modularity(edges, spark.createDataFrame(before)).first().q) < 1e-9


def test_weak_threshold_is_the_mixtures_above_the_switch_and_the_simple_one_below(spark, tmp_path):
    import duckdb

    from tessera import queries
    from tessera.fixtures import view
    from tessera.operators import learning, pixels

    sf = "/root/testdata/sf0.001"
    got = queries.QUERIES["afs_threshold_one"](spark, sf).first()[0]
    a = pixels.angles(queries._weak(lambda n: view(spark, sf, n)))
    assert got < 1.57 < a.agg(F.avg("phi") + 2 * F.stddev_pop("phi")).first()[0] and abs(got - learning.mixture_threshold(a, "phi").first()[0]) < 1e-6
    few = spark.range(400).select(F.col("id").alias("o_orderkey"), (F.col("id") % 300 + 100).alias("o_custkey"), (F.col("id") % 50 * 320.0 + 400).alias("o_totalprice"))
    few.write.parquet(f"{tmp_path}/orders.parquet")
    simple = queries.QUERIES["afs_threshold_one"](spark, str(tmp_path)).first()[0]
    c = duckdb.connect()
    c.execute(f"CREATE VIEW orders AS SELECT * FROM '{tmp_path}/orders.parquet/*.parquet'")
    assert 0 < simple < 1.57 and abs(simple - c.execute(queries.ORACLE_SQL["afs_threshold_one"]).fetchall()[0][0]) <= 1e-6
    b = pixels.angles(queries._weak(lambda n: view(spark, str(tmp_path), n)))
    assert abs(simple - b.agg(F.avg("phi") + 2 * F.stddev_pop("phi")).first()[0]) <= 1e-6

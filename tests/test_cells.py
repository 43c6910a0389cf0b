import pytest
from pyspark.sql import functions as F

from tessera.operators import cells as C
from tessera.operators import graph
from tessera.operators import neighbours as N
from tessera.operators import pixels as P
from tessera.operators import summaries as S
from tessera.operators import tiles as T


def cells(spark, rows, more="m double"):
    return spark.createDataFrame(rows, f"sample_id string, OID string, {more}")


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_blank_ids_are_errors(spark):
    with pytest.raises(ValueError, match="OID"):
        C.validate_ids(cells(spark, [("a", " ", 1.0)]))
    with pytest.raises(ValueError, match="missing"):
        C.validate_ids(cells(spark, [("a", "1", 1.0)]).drop("OID"))


def test_ambiguous_markers_are_errors():
    with pytest.raises(ValueError, match="ambiguous"):
        C.resolve_markers(["CD-3", "cd.3"], ["CD3", "CD.3"])
    assert C.resolve_markers(["CD-3", "X"], ["cd.3", "zz"]) == {"cd.3": "CD-3"}
    with pytest.raises(ValueError, match="no marker"):
        C.resolve_markers(["X"], ["zz"])


def test_zscore_of_single_constant_and_extreme_values(spark):
    d = cells(spark, [("one", "1", 3.0), ("flat", "1", 2.0), ("flat", "2", 2.0)] + [("big", str(i), 0.0) for i in range(60)] + [("big", "x", 1e6)])
    z = {(r.sample_id, r.OID): r.m for r in C.zscore(d, ["m"]).collect()}
    assert z["one", "1"] == 0 and z["flat", "1"] == 0 and z["big", "x"] == 5


@pytest.mark.parametrize("parts", [1, 4, 50])
def test_sample_is_the_same_for_any_partitioning(spark, parts):
    d = cells(spark, [(f"s{i % 3}", str(i), 1.0) for i in range(300)]).repartition(parts)
    got = C.stratified_sample(d, 30)
    assert got.count() == 30 and rows(got, "OID") == rows(C.stratified_sample(d.repartition(7), 30), "OID")
    assert C.stratified_sample(d, 1000).count() == 300


def test_bh_with_equal_and_missing_p(spark):
    d = spark.createDataFrame([("m", "a", 0.01), ("m", "b", 0.01), ("m", "c", None), ("m", "d", float("nan"))], "g string, k string, p double")
    q = {r.k: round(r.q_value, 6) for r in S.bh_adjust(d, "p", ["g"], ["k"]).collect()}
    assert q == {"a": 0.02, "b": 0.02, "c": 1.0, "d": 1.0}


def test_consensus_needs_more_than_half(spark):
    d = spark.createDataFrame([("s", "1", "x", "T_a"), ("s", "1", "y", "B_b"), ("s", "2", "x", "T_a"), ("s", "2", "y", "T_c")], "sample_id string, OID string, cl_method string, annotation string")
    assert rows(S.consensus(d), "OID", "CellType") == [("2", "T")]


def test_last_bin_edge_is_inside(spark):
    d = cells(spark, [("s", "1", 1.0, 1.0), ("s", "2", 1.1, 0.5)], "x double, y double")
    assert rows(S.density2d(d, "x", "y", (0.0, 1.0), (0.0, 1.0), 4), "ix", "iy", "n") == [(3, 3, 1)]


def test_vote_ties_go_both_ways(spark):
    near = spark.createDataFrame([("q", "1"), ("q", "2")], "query string, neighbour string")
    labels = spark.createDataFrame([("1", "A"), ("2", "B")], "neighbour string, label string")
    assert N.vote(near, labels).first()["label"] == "A" and N.vote(near, labels, largest_wins=True).first()["label"] == "B"
    one = near.where("neighbour = '2'")
    assert N.vote(one, labels).first()["second"] == "A" and N.vote(one, labels, largest_wins=True).first()["second"] == ""


def test_knn_blocks_agree_with_one_block(spark):
    d = spark.createDataFrame([(str(i), [float(i % 7), float(i * 13 % 11)]) for i in range(90)], "OID string, embedding array<double>")
    a, b = (rows(N.knn(d, d, 5, skip_self=True, block=n), "query", "neighbour", "rank") for n in (10, 1000))
    assert a == b and len(a) == 450


def test_nearest_round_ties(spark):
    d = spark.createDataFrame([("s", 1, True), ("s", 2, False), ("s", 3, True), ("t", 1, False)], "slide_id string, round_n int, ref boolean")
    got = lambda larger: {(r.slide_id, r.round_n): r.nearest for r in T.nearest_round(d, larger, F.col("ref")).collect()}
    assert got(True) == {("s", 2): 3, ("t", 1): None} and got(False)[("s", 2)] == 1


def test_names(spark):
    d = spark.createDataFrame([("R01", "V3", "S0"), ("x", "", "S11"), ("7", "v12", "S99")], "a string, b string, c string")
    got = [tuple(r) for r in d.select(T.round_number(F.col("a")), T.version_name(F.col("b")), T.scene_of_region(F.col("c"))).collect()]
    assert got == [(1, "V03", "scene01"), (None, "", "scene12"), (7, "V12", "scene100")]


def test_components_of_pixels_and_edges(spark):
    mask = spark.createDataFrame([(0, 0), (1, 1), (1, 2), (5, 5), (0, 9), (9, 0)], "r int, c int")
    assert rows(P.label_components(mask, 10), "r", "c", "component") == [(0, 0, 0), (0, 9, 9), (1, 1, 0), (1, 2, 0), (5, 5, 55), (9, 0, 90)]
    assert rows(P.label_components(mask, 10, eight=False), "component")[1] == (9,)
    chain = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(None, 3), (7, 7)], "a long, b long")
    assert {r.component for r in graph.connected_components(chain).collect()} == {0}
    assert graph.connected_components(chain.limit(0)).count() == 0


def test_conflict_ties_are_all_kept(spark):
    d = spark.createDataFrame([("s", "1", "A"), ("s", "1", "B"), ("s", "2", "C"), ("s", "3", "C")], "sample_id string, OID string, CellType string")
    assert rows(S.conflicts(d), "OID", "CellType", "conflict_id") == [("1", "A", "A___B"), ("1", "B", "A___B")]


def test_hypergeometric_tail_of_large_and_depleted_groups(spark):
    from fractions import Fraction
    from math import comb

    from tessera.operators.summaries import hypergeometric_tail

    small = [(a, k, n, t) for k, n, t in ((7, 9, 20), (15, 12, 20), (40, 300, 1000), (1, 1, 2), (5, 5, 5)) for a in range(1, min(k, n) + 1)]
    large = [(65_000, 300_000, 300_000, 1_200_000), (75_000, 300_000, 300_000, 1_200_000), (85_000, 300_000, 300_000, 1_200_000)]
    df = spark.createDataFrame([(i, *row) for i, row in enumerate(small + large)], "i int, a long, k long, n long, t long")
    got = [r.p for r in df.select("i", hypergeometric_tail("a", "k", "n", "t").alias("p")).orderBy("i").collect()]
    for (a, k, n, t), p in zip(small, got):
        want = float(Fraction(sum(comb(k, x) * comb(t - k, n - x) for x in range(a, min(k, n) + 1) if n - x <= t - k), comb(t, n)))
        assert abs(p - want) <= 1e-7 * want
    assert got[-3] == 1.0 and abs(got[-2] - 0.5) < 0.01 and got[-1] < 1e-300

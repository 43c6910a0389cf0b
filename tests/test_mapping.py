"""Mapping from samples, and the guards of the joins before it."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import cells as C
from tessera.operators import mapping as A
from tessera.operators import summaries as S


def points(spark, n, seed=1, dims=3):
    rng = np.random.default_rng(seed)
    return spark.createDataFrame([(f"s{i % 2}", str(i), rng.normal(i % 3, 0.6, dims).tolist(), f"c{i % 3}") for i in range(n)], "sample_id string, OID string, vector array<double>, cluster string")


def brute_vote(cells, reference, k, largest):
    out = {}
    for s, o, v, _ in cells:
        near = sorted((math.dist(v, w), f"{rs}|{ro}", c) for rs, ro, w, c in reference)[:k]
        n = Counter(c for *_, c in near)
        out[s, o] = max(n, key=lambda c: (n[c], c)) if largest else min(n, key=lambda c: (-n[c], c))
    return out


@pytest.mark.parametrize("k", [1, 5, 40])
def test_mapping_against_brute_force(spark, k):
    d = points(spark, 60)
    rows = [tuple(r) for r in d.collect()]
    ref = d.where("OID < '4'").withColumn("cl_method", F.lit("som"))
    ref_rows = [r for r in rows if r[1] < "4"]
    got = {(r.sample_id, r.OID): r.cluster_mapped for r in A.map_clusters(d, ref, k).collect()}
    assert got == brute_vote(rows, ref_rows, k, False)
    got = {(r.sample_id, r.OID): r.cluster for r in A.knn_classify(ref, d, k, label="cluster").collect()}
    assert got == brute_vote(rows, ref_rows, k, True)


def test_fingerprints_of_a_refined_reference(spark):
    d = points(spark, 90).withColumnRenamed("cluster", "CellType").withColumn("m", F.col("vector")[0])
    wrong = d.withColumn("CellType", F.when(F.col("OID") == "0", "c2").otherwise(F.col("CellType")))
    got = A.map_fingerprints(d, wrong, ("m",), 9, most=0)
    fixed = got["reference"].where("OID = '0'").first()
    assert (fixed.CellType, fixed.refined, fixed.status) == ("c2", "c0", "relabelled")
    assert sum(r.n for r in got["summary"].collect()) == 90 and sum(r.n for r in got["counts"].collect()) == 90
    assert got["predictions"].columns[-2:] == ["node_id", "version_id"] and len(got["fingerprints"].collect()) == 3


def test_guards(spark):
    d = points(spark, 6).withColumn("cl_method", F.lit("som"))
    two = d.unionByName(d.withColumn("cl_method", F.lit("kmeans")))
    with pytest.raises(ValueError, match="exactly one"):
        A.cluster_reference(d.drop("cluster", "cl_method"), two)
    with pytest.raises(ValueError, match="exactly one"):
        A.cluster_reference(d.drop("cluster", "cl_method"), d.where("false"))
    assert A.cluster_reference(d.drop("cluster", "cl_method"), d).count() == 6
    agreed = d.select("sample_id", "OID", F.when(F.col("OID") == "0", " ").when(F.col("OID") == "1", "NOISE").otherwise("T").alias("CellType"))
    assert A.consensus_reference(d, agreed).count() == 4
    with pytest.raises(ValueError, match="no cell"):
        A.consensus_reference(d, agreed.where("OID < '2'"))
    with pytest.raises(ValueError, match="none of the tables"):
        A.stack_tables([None, None], ("OID",))
    with pytest.raises(ValueError, match="missing columns"):
        A.stack_tables([d], ("sample_id", "nothing"))
    with pytest.raises(ValueError, match="blank"):
        A.stack_tables([d.withColumn("OID", F.lit(" "))], ("sample_id", "OID"))
    assert not A.is_included("None") and not A.is_included(None) and not A.is_included(" Not included ") and not A.is_included("") and A.is_included("x.csv") and A.is_included("nan") and A.is_included("0")
    with pytest.raises(ValueError, match="no type"):
        C.selected_celltypes(d.select(F.lit("").alias("CellType"), F.lit(1).alias("include")))


def test_three_inputs(spark):
    t = lambda names, c: spark.createDataFrame([(x, 1) for x in names], f"tissue string, {c} int")
    assert A.three_inputs(t("ab", "x"), t("ab", "y"), t("ab", "z")).count() == 2
    with pytest.raises(ValueError, match="more than once"):
        A.three_inputs(t("aab", "x"), t("ab", "y"), t("ab", "z"))
    with pytest.raises(ValueError, match="not in all"):
        A.three_inputs(t("ab", "x"), t("a", "y"), t("ab", "z"))


def test_samples_by_hash_are_the_same_whatever_the_partitions(spark):
    d = spark.createDataFrame([(f"s{min(i % 7, 1)}", str(i)) for i in range(3000)], "sample_id string, OID string")
    runs = [{(r.sample_id, r.OID) for r in C.stratified_sample(x, 1000).collect()} for x in (d, d.repartition(9))]
    quotas = {r.sample_id: r.k for r in C.sample_quotas(d, 1000).collect()}
    assert runs[0] == runs[1] and Counter(s for s, _ in runs[0]) == quotas
    h = {(r.sample_id, r.OID): r.h for r in d.withColumn("h", F.xxhash64("sample_id", "OID", F.lit(1234))).collect()}
    for s, k in quotas.items():  # the first by unsigned hash
        first = sorted((x % 2**64, key) for key, x in h.items() if key[0] == s)[:k]
        assert {key for _, key in first} == {x for x in runs[0] if x[0] == s}
    assert Counter(r.sample_id for r in C.balanced_sample(d, 300, "sample_id").collect()) == {"s0": 300, "s1": 300}
    assert C.balanced_sample(d, 0, "sample_id").count() == 3000


def test_column_means_of_names_with_dots(spark):
    d = spark.createDataFrame([(1.0, 5.0), (2.0, 7.0)], "a double, `s.area` double")
    assert [tuple(r) for r in S.columns_by_mean(d, ("a", "s.area")).collect()] == [("s.area", 6.0), ("a", 1.5)]


def exact_tail(a, label, sample, total):
    return sum(math.comb(label, k) * math.comb(total - label, sample - k) for k in range(a, min(label, sample) + 1)) / math.comb(total, sample)


def test_enrichment_tails_against_whole_numbers(spark):
    rows = [(100, 5_000, 10_000, 20_000), (2_400, 5_000, 10_000, 20_000), (2_600, 5_000, 10_000, 20_000), (0, 3, 4, 9), (3, 3, 4, 9), (1, 1, 1, 1), (40, 60, 70, 100)]
    d = spark.createDataFrame(rows, "n long, n_label long, n_sample long, total long")
    for r in d.select("*", S.hypergeometric_tail("n", "n_label", "n_sample", "total").alias("p")).collect():
        want = 1.0 if r.n <= 0 else exact_tail(r.n, r.n_label, r.n_sample, r.total)
        assert abs(r.p - want) < 1e-8 + 1e-6 * want

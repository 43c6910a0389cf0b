"""Folders as tables, and operators on whole tables."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThan, StringContains, StringStartsWith

from tessera.operators import tables as T
from tessera.plans.lineage import new_path
from tessera.sources import folders


def tree(spark):
    root = new_path(spark, "tree")
    names = ["a1/x.tif", "a1/deep/er/y.tif", "a1/z", "a2/x.txt", "b/x.tif", "top.csv", "é c/n m.tar.gz"]
    n = folders.write_files(spark.createDataFrame([(x, bytes(len(x))) for x in names], "path string, content binary"), root)
    assert n == len(names)
    return root, names


def test_all_files_of_a_folder(spark):
    root, names = tree(spark)
    got = {(r.folder + "/" if r.folder else "") + r.name: r for r in folders.read_folder_tree(spark, root).collect()}
    assert set(got) == set(names) and all(r.bytes == len(x) for x, r in got.items())
    assert (got["a1/z"].suffix, got["a1/z"].stem, got["é c/n m.tar.gz"].suffix, got["top.csv"].top, got["a1/deep/er/y.tif"].top) == ("", "z", ".gz", "", "a1")


def test_predicates_on_top_folders_spare_partitions_and_others_are_decided_while_walking(spark):
    root, _ = tree(spark)
    r = folders.FolderReader(root)
    left = list(r.pushFilters([EqualTo(("suffix",), ".tif"), StringStartsWith(("top",), "a"), GreaterThan(("bytes",), 3), StringContains(("nothing",), "x")]))
    assert [type(f) for f in left] == [GreaterThan, StringContains]
    assert [p.top for p in r.partitions()] == ["a1", "a2"]
    rows = [x for p in r.partitions() for b in r.read(p) for x in b.to_pylist()]
    assert sorted(x["name"] for x in rows) == ["x.tif", "y.tif"]
    df = folders.read_folder_tree(spark, root).where("top like 'a%' and suffix = '.tif'")
    assert df.rdd.getNumPartitions() == 2 and df.count() == 2
    assert folders.read_folder_tree(spark, root).where("top = 'none'").count() == 0
    assert folders.read_folder_tree(spark, root + "-not-there").count() == 0


def test_strict_union_names_the_difference(spark):
    a = spark.createDataFrame([(1, "x")], "n int, s string")
    assert T.union_strict([a, a]).count() == 2 and T.union_strict([a]).count() == 1
    for other, what in ((a.withColumn("m", F.lit(1)), "with \\['m'\\]"), (a.select("s", "n"), "another order"), (a.withColumn("n", F.lit(1.0)), "n as double"), (a.drop("s"), "without \\['s'\\]")):
        with pytest.raises(ValueError, match=what):
            T.union_strict([a, other])
    assert T.union_relaxed([a, a.drop("s"), a.withColumn("n", F.lit(1.5))]).dtypes == [("n", "double"), ("s", "string")]


def test_sets_groups_and_grids_with_nulls(spark):
    a = spark.createDataFrame([("x", 1), ("x", 1), (None, 2), ("y", 3)], "k string, n int")
    b = spark.createDataFrame([("x", 9), (None, 9)], "k string, n int")
    keys = lambda df: sorted(r.k or "" for r in df.collect())
    assert keys(T.intersect_keys(a, b, ["k"])) == ["", "x"] and keys(T.except_keys(a, b, ["k"])) == ["y"] and keys(T.distinct_rows(a, ["k"])) == ["", "x", "y"]
    assert sorted((r.k or "", r.m) for r in T.with_group_size(a, ["k"], "m").collect()) == [("", 1), ("x", 2), ("x", 2), ("y", 1)]
    grid = spark.createDataFrame([("r", "a", 2), ("s", "b", 3)], "p string, q string, n int")
    assert sorted(tuple(r) for r in T.full_grid(grid, "p", "q", "n").collect()) == [("r", "a", 2), ("r", "b", 0), ("s", "a", 0), ("s", "b", 3)]
    with pytest.raises(ValueError, match="2 x 2"):
        T.full_grid(grid, "p", "q", "n", most=3)
    assert T.full_grid(grid.limit(0), "p", "q", "n").count() == 0

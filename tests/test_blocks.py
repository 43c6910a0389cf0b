"""Pixel operators on blocks against those on rows."""

import random

import pytest
from pyspark.sql import functions as F

from tessera.operators import blocks as B
from tessera.operators import pixels as P


def image(spark, rows=21, columns=30, seed=1, missing=0.0, names=("a", "b")):
    rng = random.Random(seed)
    px = [(n, r, c, rng.choice([0.0, 1.0, rng.random() * 50])) for n in names for r in range(rows) for c in range(columns) if rng.random() >= missing]
    return spark.createDataFrame(px, "image_id string, r int, c int, v double")


def rows_of(df, *columns):
    return sorted(tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in df.select(*columns).collect())


ALL = ("image_id", "r", "c", "v")


@pytest.mark.parametrize("missing", [0.0, 0.4])
def test_there_and_back_crop_masks_and_windows(spark, missing):
    px = image(spark, missing=missing)
    b = B.to_blocks(px, 8)
    assert rows_of(B.from_blocks(b), *ALL) == rows_of(px, *ALL)
    for box in ((3, 5, 19, 27), (8, 8, 16, 24), (0, 0, 500, 500), (5, 5, 5, 9), (100, 0, 200, 10)):
        assert rows_of(B.from_blocks(B.crop(b, *box)), *ALL) == rows_of(P.crop(px, *box), *ALL)
    fore = px.where("image_id = 'a' and v > 1").select("r", "c", "v")
    assert rows_of(B.from_blocks(B.apply_mask(b, B.to_blocks(fore, 8))), *ALL) == rows_of(P.apply_mask(px, fore), *ALL)
    own = fore.withColumn("image_id", F.lit("a"))
    masked = B.from_blocks(B.apply_mask(b, B.to_blocks(own, 8)))
    assert masked.where("image_id = 'b' and v <> 0").isEmpty() and not masked.where("image_id = 'a' and v <> 0").isEmpty()
    windows = B.halo_tiles(b, 3)
    assert rows_of(B.window_rows(windows, 3), *ALL, "wr", "wc", "lr", "lc") == rows_of(P.halo_tiles(px, 8, 3), *ALL, "wr", "wc", "lr", "lc")
    assert rows_of(B.from_blocks(B.keep_centres(windows, 3)), *ALL) == rows_of(px, *ALL)


@pytest.mark.parametrize("shape,missing", [((21, 30), 0.0), ((17, 25), 0.0), ((16, 8), 0.3), ((9, 40), 0.2)])
def test_similarity(spark, shape, missing):
    px = image(spark, *shape, seed=3, missing=missing).withColumn("v", F.col("v") / 50)
    got = B.from_blocks(B.structural_similarity(B.to_blocks(px, 8), "a", "b"))
    if missing:  # rows shuffle windows over what is there, blocks the whole square: both leave out what is missing only where the image is dense
        want = {(r.r, r.c) for r in px.groupBy("r", "c").count().where("count = 2").collect()}
        assert {(r.r, r.c) for r in got.collect()} == want
    else:
        a, b = rows_of(got, "r", "c", "v"), rows_of(P.structural_similarity(px, "a", "b"), "r", "c", "v")
        assert [x[:2] for x in a] == [x[:2] for x in b] and max(abs(x[2] - y[2]) for x, y in zip(a, b, strict=True)) < 1e-6


@pytest.mark.parametrize("eight,seed", [(True, 1), (False, 2), (True, 3)])
def test_components_over_block_borders(spark, eight, seed):
    rng = random.Random(seed)
    mask = [(n, r, c, 1.0) for n in "ab" for r in range(30) for c in range(25) if rng.random() < 0.5]
    mask += [("snake", r, c, 1.0) for r in range(30) for c in range(25) if r % 2 == 0 or c == (24 if r % 4 == 1 else 0)]
    px = spark.createDataFrame(mask, "image_id string, r int, c int, v double")
    got = B.from_blocks(B.label_components(B.to_blocks(px, 8), 25, eight), "bigint").withColumnRenamed("v", "component")
    assert rows_of(got, "image_id", "r", "c", "component") == rows_of(P.label_components(px, 25, eight, tile=8), "image_id", "r", "c", "component")


def test_label_sums_and_scenes(spark):
    px = image(spark, missing=0.2)
    labels = px.where("image_id = 'a'").select("r", "c", (F.floor(F.col("r") / 6) * 9 + F.floor(F.col("c") / 5)).alias("OID"))
    sums = B.label_sums(B.to_blocks(px, 8), B.to_blocks(labels.select("r", "c", F.col("OID").alias("v")), 8))
    assert rows_of(sums, "OID", "image_id", "area", "X", "Y", "mean_v") == rows_of(P.features(px, labels), "OID", "image_id", "area", "X", "Y", "mean_v")
    scenes = px.withColumn("slide_id", F.lit("x")).withColumn("scan_region", F.lit("S09")).unionByName(px.withColumn("slide_id", F.lit("y")).withColumn("scan_region", F.lit("S0")).withColumn("v", F.col("v") * 2))
    named = spark.createDataFrame([("x", "S09", "a", "CD3"), ("x", "S09", "b", "CD3"), ("y", "S0", "b", "CD8"), ("y", "S0", "zz", "CD3")], "slide_id string, scan_region string, image_id string, marker_id string")
    own = labels.select("r", "c", F.col("OID").alias("v")).crossJoin(spark.createDataFrame([("x", "S09"), ("y", "S0")], "slide_id string, scan_region string"))
    got = B.scene_features(B.to_blocks(scenes, 8), B.to_blocks(own, 8), named, ["CD3", "CD8"])
    want = {(r.image_id, r.OID): r for r in P.features(px, labels).collect()}
    rows = got.collect()
    assert {r.scene_id for r in rows} == {"scene10", "scene01"} and len(rows) == len(want)
    for r in rows:
        w = want["a" if r.slide_id == "x" else "b", r.OID]
        assert (r.CD8 is None) == (r.slide_id == "x") and abs((r.CD3 if r.slide_id == "x" else r.CD8 / 2) - w.mean_v) < 1e-9 and r.area == w.area


def test_empty_tables_and_repeated_places(spark):
    none = image(spark).limit(0)
    b = B.to_blocks(none, 8)
    assert b.isEmpty() and B.crop(b, 0, 0, 5, 5).isEmpty() and B.halo_tiles(b, 2).isEmpty() and B.label_components(b, 10).isEmpty() and B.structural_similarity(b, "a", "b").isEmpty()
    px = spark.createDataFrame([("a", 1, 1, 2.0), ("a", 1, 1, 5.0), ("a", 2, 1, None), ("a", 3, 0, float("nan"))], "image_id string, r int, c int, v double")
    assert rows_of(B.from_blocks(B.to_blocks(px, 8)), *ALL) == [("a", 1, 1, 5.0)]

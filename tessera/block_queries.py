"""Queries of pixel operators over tables of blocks: the same results as the forms over rows, and so the same SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators import blocks as B
from tessera.queries import ORACLE_SQL, query

SIDE = 64


def _same_as(name: str):
    """Registers a query whose SQL is that of the form over rows."""

    def add(f):
        query()(f)
        if name in ORACLE_SQL:
            ORACLE_SQL[f.__name__] = ORACLE_SQL[name]
        return f

    return add


def _pixels(v, side: int = SIDE) -> DataFrame:
    return B.to_blocks(v("pixels"), side)


def _labels(v) -> DataFrame:
    return B.to_blocks(v("label_pixels").where("OID <> 0").select("r", "c", F.col("OID").alias("v")), SIDE)


@_same_as("patch_stitch_center")
def pixel_blocks(v):
    return B.from_blocks(_pixels(v))


@_same_as("crop")
def crop_blocks(v):
    return B.from_blocks(B.crop(_pixels(v), 10, 20, 60, 100))


@_same_as("apply_masks")
def apply_masks_blocks(v):
    return B.from_blocks(B.apply_mask(_pixels(v), _labels(v)))


@_same_as("halo_tiles")
def halo_tiles_blocks(v):
    return B.window_rows(B.halo_tiles(_pixels(v, 32), 4), 4)


@_same_as("patch_stitch_center")
def patch_stitch_center_blocks(v):
    return B.from_blocks(B.keep_centres(B.halo_tiles(_pixels(v, 32), 4), 4))


@_same_as("ssim_map")
def ssim_map_blocks(v):
    px = v("pixels").withColumn("v", F.when(F.col("image_id") == "MS", F.col("v") / 60000).otherwise(F.col("v") / 1000))
    return B.from_blocks(B.structural_similarity(B.to_blocks(px, SIDE), "MS", "AF"))


@_same_as("features")
def features_blocks(v):
    return B.label_sums(_pixels(v), _labels(v)).select("OID", "image_id", "area", "X", "Y", "mean_v")


@query("""WITH m AS (SELECT slide_id, scan_region, marker_id, min(image_id) AS image_id FROM scene_images GROUP BY 1, 2, 3),
  j AS (SELECT l.slide_id, l.scan_region, l.v AS OID, p.image_id, m.marker_id, p.r, p.c, p.v FROM scene_labels l JOIN scene_pixels p ON p.slide_id = l.slide_id AND p.scan_region = l.scan_region AND p.r = l.r AND p.c = l.c
    JOIN m ON m.slide_id = l.slide_id AND m.scan_region = l.scan_region AND m.image_id = p.image_id WHERE l.v <> 0)
  SELECT slide_id, scan_region, 'scene' || lpad(CAST(CAST(substr(scan_region, 2) AS INT) + 1 AS VARCHAR), 2, '0') AS scene_id, CAST(OID AS BIGINT) AS OID, count(DISTINCT r * 100000 + c) AS area, round(avg(c), 6) AS X, round(avg(r), 6) AS Y,
    round(avg(v) FILTER (marker_id = 'CD3'), 6) + 0.0 AS CD3, round(avg(v) FILTER (marker_id = 'CD8'), 6) + 0.0 AS CD8 FROM j GROUP BY 1, 2, 4""")
def features_of_scenes(v):
    return B.scene_features(B.to_blocks(v("scene_pixels"), SIDE), B.to_blocks(v("scene_labels"), SIDE), v("scene_images"), ["CD3", "CD8"])


@query()
def cc_label_blocks(v):
    mask = B.to_blocks(v("pixels").where("image_id = 'MS' and v > 33000"), SIDE)
    return B.from_blocks(B.label_components(mask, 150), "bigint").select("r", "c", F.col("v").alias("component"))

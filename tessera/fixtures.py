"""Views that give the driver's tables the shapes of cell, tile and pixel tables. The text runs in both engines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

BASE = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "embeddings")

VIEWS = {
    "cells": """SELECT l_returnflag || '_' || l_linestatus AS sample_id,
        concat_ws('-', CAST(l_orderkey AS VARCHAR(20)), CAST(l_linenumber AS VARCHAR(20)), CAST(l_partkey AS VARCHAR(20)), CAST(l_suppkey AS VARCHAR(20))) AS OID,
        l_returnflag AS slide_id, l_linestatus AS scene_id, CAST(l_partkey AS DOUBLE) AS X, CAST(l_suppkey AS DOUBLE) AS Y,
        l_quantity AS QTY, l_extendedprice AS PRICE, l_discount AS DISC, l_tax AS TAX FROM lineitem""",
    "clusters": """SELECT sample_id, OID, 'kmeans' AS cl_method, CAST(CAST(X AS INT) % 7 AS VARCHAR(20)) AS cluster FROM cells
        UNION ALL SELECT sample_id, OID, 'phenograph', CAST(CAST(floor(PRICE / 15000) AS INT) AS VARCHAR(20)) FROM cells
        UNION ALL SELECT sample_id, OID, 'som', CAST(CAST(floor(QTY / 10) AS INT) AS VARCHAR(20)) FROM cells""",
    "annotation_dictionary": """SELECT cl_method, cluster, CASE WHEN cluster = '0' THEN '' WHEN CAST(cluster AS INT) <= 2 THEN 'TCELL_a'
        WHEN CAST(cluster AS INT) <= 4 THEN 'BCELL' ELSE 'OTHER' END AS annotation FROM (SELECT DISTINCT cl_method, cluster FROM clusters) d""",
    "vector_cells": """SELECT 's' || CAST(vec_id % 4 AS VARCHAR(20)) AS sample_id, CAST(vec_id AS VARCHAR(20)) AS OID, embedding,
        'T' || CAST(label AS VARCHAR(20)) AS CellType, vec_id % 5 = 0 AS is_reference FROM embeddings""",
    "acquisitions": """SELECT 'u' || CAST(user_id AS VARCHAR(20)) AS slide_id,
        CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS INT) AS round_n,
        CASE WHEN event_type = 'view' THEN 'AF' ELSE upper(event_type) END AS marker_id, value AS intensity, CAST(1 AS INT) AS QC_include FROM events""",
    "tiles": """SELECT CAST(p_partkey AS INT) AS tile, p_brand AS slide, p_type AS channel, (p_partkey % 40) * 1836.0 AS stage_x,
        floor(p_partkey / 40) * 1836.0 AS stage_y, CAST(2040 AS INT) AS width_px, CAST(2040 AS INT) AS height_px FROM part""",
    "pixels": """SELECT 'MS' AS image_id, CAST(floor(o_orderkey / 150) AS INT) AS r, CAST(o_orderkey % 150 AS INT) AS c, CAST(floor(o_totalprice / 8) AS DOUBLE) AS v FROM orders
        UNION ALL SELECT 'AF', CAST(floor(o_orderkey / 150) AS INT), CAST(o_orderkey % 150 AS INT), CAST(o_custkey % 997 AS DOUBLE) FROM orders""",
    "label_pixels": """SELECT r, c, CASE WHEN k % 7 = 0 THEN 0 ELSE k END AS OID FROM (
        SELECT r, c, CAST(floor(r / 10) AS INT) * 15 + CAST(floor(c / 10) AS INT) AS k FROM pixels WHERE image_id = 'MS') b""",
    "predictions": """SELECT sample_id, OID, CASE WHEN QTY < 10 THEN 'T' WHEN QTY < 30 THEN 'B' ELSE 'NK' END AS CellType,
        CAST(1 - DISC * 8.37 AS DOUBLE) AS prediction_confidence FROM cells""",
    "images": """SELECT 'u' || CAST(user_id AS VARCHAR(20)) AS slide_id, 'S' || CAST(event_id % 2 AS VARCHAR(20)) AS scene_id, 'C' || CAST(event_id % 3 AS VARCHAR(20)) AS channel_id,
        CAST(1 + floor(event_id / 7) % 9 AS INT) AS round_n, 'V0' || CAST(1 + CAST(floor(event_id / 63) AS INT) % 2 AS VARCHAR(20)) AS version,
        CASE WHEN event_type = 'view' THEN 'AF' ELSE upper(event_type) END AS marker_id, CAST(CASE WHEN event_id % 11 = 0 THEN 1 + user_id % 9 END AS INT) AS ref_round_af,
        CAST(CASE WHEN event_id % 13 = 0 THEN 0 ELSE 1 END AS INT) AS QC_include, 'f' || lpad(CAST(event_id AS VARCHAR(20)), 12, '0') AS file_name FROM events""",
    "estimates": """SELECT l_orderkey AS pair, CASE l_linenumber WHEN 1 THEN 'features' WHEN 2 THEN 'phase' WHEN 3 THEN 'template' ELSE 'grid' END AS method,
        max(CASE WHEN l_discount > 0.02 THEN l_discount END) AS score, min(l_quantity) AS dx, min(100 * l_tax) AS dy, max(l_extendedprice) AS area FROM lineitem GROUP BY 1, 2""",
    "tile_boxes": """SELECT p_brand AS slide, p_type AS region, min((p_partkey % 40) * 1836.0) AS x0, min(floor(p_partkey / 40) * 1836.0) AS y0,
        min((p_partkey % 40) * 1836.0) + 20000 AS x1, min(floor(p_partkey / 40) * 1836.0) + 20000 AS y1 FROM part GROUP BY 1, 2""",
    "tile_files": """SELECT 'SL' || CAST(p_size % 3 AS VARCHAR(20)) || '_R0' || CAST(1 + p_partkey % 3 AS VARCHAR(20)) || '_V0' || CAST(1 + p_size % 2 AS VARCHAR(20)) || '_PRJ_USR' AS folder,
        'BM_x_S' || CAST(1 + p_size % 2 AS VARCHAR(20)) || 'M' || CAST(p_partkey AS VARCHAR(20)) || '_' || CASE WHEN p_partkey % 7 = 0 THEN 'DAPI' ELSE 'CY5' END || '.tif' AS tile_filename,
        CAST(1 + p_size % 2 AS VARCHAR(20)) AS S, CAST(p_partkey AS VARCHAR(20)) AS M, '0,0,' || CAST(2040 + p_size % 2 AS VARCHAR(20)) || ',2040' AS Frame, '6.5,6.5' AS ImagePixelSize,
        CAST(p_partkey % 40 AS VARCHAR(20)) || ',5' AS StageXPosition, CAST(p_size AS VARCHAR(20)) || '.25' AS StageYPosition FROM part""",
    "round_tiles": """SELECT p_brand AS slide, CASE WHEN p_size % 2 = 0 THEN 'S0' ELSE 'S1' END AS scene, CAST(p_partkey AS INT) AS tile, CAST(p_partkey % 3 AS INT) AS round_n,
        (p_partkey % 40) * 900.0 AS x0, (p_partkey % 40) * 900.0 + 1000 + p_size AS x1, floor(p_partkey / 200) * 900.0 AS y0, floor(p_partkey / 200) * 900.0 + 1000 + p_size AS y1 FROM part""",
    "class_scores": """SELECT r, c, CAST(r % 16 AS INT) AS lr, CAST(c % 16 AS INT) AS lc, CAST(CASE WHEN image_id = 'AF' THEN 1 ELSE 2 END AS INT) AS class, v / (v + 500) AS p FROM pixels
        UNION ALL SELECT r, c, CAST((r + 8) % 16 AS INT), CAST((c + 8) % 16 AS INT), CAST(CASE WHEN image_id = 'AF' THEN 1 ELSE 2 END AS INT), v / (v + 700) FROM pixels""",
    "scene_pixels": """SELECT 'SL' || CAST(o_orderkey % 2 AS VARCHAR(20)) AS slide_id, 'S' || CAST(o_orderkey % 3 AS VARCHAR(20)) AS scan_region, 'I' || CAST(k AS VARCHAR(20)) AS image_id,
        CAST(floor(o_orderkey / 240) AS INT) AS r, CAST(floor(o_orderkey / 6) % 40 AS INT) AS c, CAST(CASE k WHEN 1 THEN floor(o_totalprice / 8) WHEN 2 THEN o_custkey % 997 ELSE o_custkey % 31 END AS DOUBLE) AS v
        FROM orders, (SELECT 1 AS k UNION ALL SELECT 2 UNION ALL SELECT 3) i WHERE k < 3 OR o_orderkey % 3 = 0""",
    "scene_labels": """SELECT slide_id, scan_region, r, c, CAST(CASE WHEN (r + c) % 9 = 0 THEN 0 ELSE 1 + floor(r / 8) * 5 + floor(c / 8) END AS DOUBLE) AS v FROM scene_pixels WHERE image_id = 'I1'""",
    "scene_images": """SELECT DISTINCT slide_id, scan_region, image_id, CASE image_id WHEN 'I1' THEN 'CD3' ELSE 'CD8' END AS marker_id FROM scene_pixels WHERE image_id <> 'I2' OR scan_region <> 'S2'""",
}
NEEDS = {"scene_labels": ("scene_pixels",), "scene_images": ("scene_pixels",), "clusters": ("cells",), "annotation_dictionary": ("clusters",), "label_pixels": ("pixels",), "predictions": ("cells",), "class_scores": ("pixels",)}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    for base in BASE:
        if base in VIEWS[name]:
            spark.read.parquet(f"{sf_dir}/{base}.parquet").createOrReplaceTempView(base)
    for need in NEEDS.get(name, ()):
        view(spark, sf_dir, need).createOrReplaceTempView(need)
    return spark.sql(VIEWS[name])


def with_views(sql: str) -> str:
    """The query with the views that it names put before it."""
    import re

    named = [n for n in VIEWS if re.search(rf"\b{n}\b", sql)]
    while more := [m for n in named for m in NEEDS.get(n, ()) if m not in named]:
        named += list(dict.fromkeys(more))
    ctes = ", ".join(f"{n} AS ({VIEWS[n]})" for n in VIEWS if n in named)
    body = sql.strip()
    return f"WITH {ctes}, {body[5:]}" if body.startswith("WITH ") else f"WITH {ctes} {body}"

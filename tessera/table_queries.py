"""Queries of readers and writers, folders, and operators on whole tables, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.more_queries import _manifest
from tessera.operators import cells as C
from tessera.operators import manifest as M
from tessera.operators import mapping as A
from tessera.operators import tables as T
from tessera.plans.lineage import new_path
from tessera.queries import ORACLE_SQL, query
from tessera.sources import files, folders


def _sample(v):
    return v("cells").select("sample_id", "OID", "X", "TAX")


@query("SELECT s.sep, sample_id, OID, X, TAX FROM cells, (SELECT ',' AS sep UNION ALL SELECT ';' UNION ALL SELECT chr(9)) s")
def src_sniff_sep(v):
    df, out = _sample(v), None
    spark = df.sparkSession
    for sep in (",", ";", "\t"):
        path = f"{new_path(spark, 'table')}/t.csv"
        df.write.option("header", True).option("sep", sep).csv(path)
        found = files.sniff_separator(files.peek(spark, path))
        t = files.read_table(spark, path).select(F.lit(found).alias("sep"), "sample_id", "OID", "X", "TAX")
        out = t if out is None else out.unionByName(t)
    return out


@query("SELECT k.kind, sample_id, OID, X, TAX FROM cells, (SELECT 'parquet' AS kind UNION ALL SELECT 'csv' UNION ALL SELECT 'tsv') k")
def sink_table(v):
    df = _sample(v)
    spark, root, out = df.sparkSession, new_path(df.sparkSession, "sink"), None
    for kind, sep in (("parquet", None), ("csv", ";"), ("tsv", "\t")):
        files.write_table(df, f"{root}/t.{kind}")
        t = spark.read.parquet(f"{root}/t.{kind}") if sep is None else spark.read.schema(df.schema).option("header", True).option("sep", sep).csv(f"{root}/t.{kind}")
        t = t.select(F.lit(kind).alias("kind"), *df.columns)
        out = t if out is None else out.unionByName(t)
    return out


@query("""WITH a AS (SELECT slide_id AS folder, round_n % 5 AS w, round_n, marker_id FROM acquisitions)
  SELECT folder, 'W' || w AS well_name, marker_id AS marker_name, 'C' || (round_n % 3) AS channel_id, CAST(row_number() OVER (PARTITION BY folder, w ORDER BY round_n) - 1 AS INT) AS channel_number,
    'R' || lpad(CAST(dense_rank() OVER (PARTITION BY folder ORDER BY w) AS VARCHAR), 2, '0') AS round_number, 0.5 AS pixel_size FROM a""")
def src_xpd_json(v):
    a = v("acquisitions").select("slide_id", (F.col("round_n") % 5).alias("w"), "round_n", F.when(F.col("marker_id") == "AF", "--").otherwise(F.col("marker_id")).alias("markerName"), F.concat(F.lit("C"), F.col("round_n") % 3).alias("channel"))
    item = F.transform(F.sort_array(F.collect_list(F.struct("round_n", "markerName", "channel"))), lambda x: F.struct(x["markerName"].alias("markerName"), x["channel"].alias("channel")))
    wells = a.groupBy("slide_id", "w").agg(item.alias("items"))
    well = F.transform(F.sort_array(F.collect_list(F.struct("w", "items"))), lambda x: F.struct(F.concat(F.lit("W"), x["w"]).alias("wellName"), x["items"].alias("items")))
    jobs = wells.groupBy("slide_id").agg(F.to_json(F.struct(F.lit(0.5).alias("resolution"), well.alias("wells"))).alias("content"))
    root = new_path(a.sparkSession, "xpd")
    folders.write_files(jobs.select(F.concat("slide_id", F.lit("/design.xpd.json")).alias("path"), "content"), root)
    return files.read_acquisition_json(a.sparkSession, root, pattern="*.json")


def _written(v):
    """A folder of the tiles' files, one of three bytes for each."""
    f = v("tile_files").select("folder", "tile_filename").distinct()
    root = new_path(f.sparkSession, "tree")
    folders.write_files(f.select(F.concat_ws("/", "folder", "tile_filename").alias("path"), F.lit("abc").alias("content")), root)
    return folders.read_folder_tree(f.sparkSession, root)


@query("SELECT DISTINCT folder AS top, tile_filename AS name, '.tif' AS suffix, CAST(3 AS BIGINT) AS bytes FROM tile_files WHERE folder LIKE 'SL1%' AND tile_filename LIKE '%DAPI%'")
def src_file_listing(v):
    return _written(v).where("top like 'SL1%' and name like '%DAPI%'").select("top", "name", "suffix", "bytes")


@query()
def manifest_of_folder(v):
    listed = _written(v).select("folder", F.col("name").alias("tile_filename"))
    return _manifest(v, listed)


ORACLE_SQL["manifest_of_folder"] = ORACLE_SQL["manifest_build"]


@query()
def qc_manifest_of_folder(v):
    m = _manifest(v)
    there = m.where("tile % 50 <> 0").select("path").distinct()
    root = new_path(m.sparkSession, "tree")
    folders.write_files(there.select("path", F.lit("").alias("content")), root)
    return M.qc_manifest(m, False, folders.read_folder_tree(m.sparkSession, root).select(F.concat_ws("/", "folder", "name").alias("path")))


ORACLE_SQL["qc_manifest_of_folder"] = ORACLE_SQL["qc_manifest"]


@query('SELECT OID, QTY AS "qty", PRICE AS "Price", TAX AS "TAX" FROM cells')
def resolve_markers(v):
    cells = v("cells")
    found = C.resolve_markers(cells.columns, ["qty", "Price", "TAX", "CD-3"])
    return cells.select("OID", *(C.quoted(c).alias(m) for m, c in found.items()))


@query("SELECT sample_id, OID, X, Y, QTY, PRICE, DISC, TAX, slide_id, scene_id FROM cells")
def column_order(v):
    return C.column_order(v("cells"), ["sample_id", "OID"])


_WORDS = "CASE round_n % 8 WHEN 0 THEN ' None ' WHEN 1 THEN 'not included' WHEN 2 THEN 'NA' WHEN 3 THEN '  ' WHEN 4 THEN 'Null' WHEN 5 THEN NULL WHEN 6 THEN 'nan' ELSE marker_id || '.csv' END"


@query(f"WITH w AS (SELECT slide_id, round_n, {_WORDS} AS path FROM acquisitions) SELECT slide_id, round_n, path IS NOT NULL AND lower(trim(path)) NOT IN ('', 'not included', 'none', 'null', 'na') AS included FROM w")
def is_included(v):
    return v("acquisitions").select("slide_id", "round_n", A.included(F.expr(_WORDS)).alias("included"))


@query("SELECT sample_id, OID, count(*) OVER (PARTITION BY sample_id) AS n FROM cells")
def join_group_k(v):
    return T.with_group_size(v("cells").select("sample_id", "OID"), ["sample_id"])


@query("""WITH k AS (SELECT cl_method || '_' || cluster AS label, sample_id, count(*) AS n FROM clusters WHERE NOT (cluster = '2' AND sample_id LIKE 'N%') GROUP BY 1, 2)
  SELECT a.label, b.sample_id, coalesce(k.n, 0) AS n FROM (SELECT DISTINCT label FROM k) a CROSS JOIN (SELECT DISTINCT sample_id FROM k) b LEFT JOIN k ON k.label = a.label AND k.sample_id = b.sample_id""")
def join_grid_cross(v):
    k = v("clusters").where("not (cluster = '2' and sample_id like 'N%')").groupBy(F.concat_ws("_", "cl_method", "cluster").alias("label"), "sample_id").agg(F.count("*").alias("n"))
    return T.full_grid(k, "label", "sample_id", "n")


@query("SELECT sample_id, OID, X, TAX FROM cells")
def union_strict(v):
    df = _sample(v)
    return T.union_strict([df.where("X < 50"), df.where("X >= 50 and X < 120"), df.where("X >= 120")])

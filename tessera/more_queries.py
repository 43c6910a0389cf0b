"""Queries of mapping, manifests, overlaps and the later pixel operators, with their SQL; registered in :mod:`tessera.queries`."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators import cells as C
from tessera.operators import learning as L
from tessera.operators import manifest as M
from tessera.operators import mapping as A
from tessera.operators import neighbours as N
from tessera.operators import overlaps as O
from tessera.operators import pixels as P
from tessera.operators import quality as Q
from tessera.operators import summaries as S
from tessera.operators import tiles as T
from tessera.plans.lineage import new_path
from tessera.queries import _ANNOTATED, _ENRICH, _NEAR, _SELF, _VOTE, MARKERS, query
from tessera.sources import files, folders

_ID = "sample_id || '|' || OID"


def _session(df: DataFrame):
    return df.sparkSession


# mapping ----------------------------------------------------------------------------------------------------------

def _vectors(v) -> DataFrame:
    return v("vector_cells").withColumnRenamed("embedding", "vector")


def _by_id(sql: str) -> str:
    """Neighbours by composite key instead of OID."""
    return sql.replace("a.OID AS query", "a.sample_id || '|' || a.OID AS query").replace("b.OID AS neighbour", "b.sample_id || '|' || b.OID AS neighbour")


_MAPPED = f"""{_by_id(_NEAR)}, {_VOTE.format(order='')}, kk AS (SELECT o.*, coalesce(second, (SELECT min(x.CellType) FROM vector_cells x WHERE x.is_reference AND x.CellType <> o.label)) AS s2, a / n_neighbors AS conf, (a - b) / n_neighbors AS mar FROM o)"""


@query(f"""WITH {_MAPPED} SELECT sample_id, OID, 'kmeans' AS cl_method, label AS cluster_mapped, s2 AS cluster_second, round(conf, 6) AS cluster_confidence, round(mar, 6) AS cluster_margin,
  CASE WHEN conf >= 0.8 THEN 'high_confidence' WHEN conf >= 0.6 THEN 'medium_confidence' ELSE 'low_confidence' END AS cluster_prediction_status, n_neighbors FROM kk JOIN vector_cells ON {_ID} = query""")
def map_clusters(v):
    cells = _vectors(v)
    reference = cells.where("is_reference").withColumn("cl_method", F.lit("kmeans")).withColumn("cluster", F.col("CellType"))
    return A.map_clusters(cells, reference, 10)


_TEST = _by_id(_NEAR).replace("JOIN vector_cells b ON b.is_reference)", "JOIN vector_cells b ON b.is_reference WHERE NOT a.is_reference)")


@query(f"WITH {_TEST}, {_VOTE.format(order='DESC')} SELECT sample_id, OID, label AS CellType, round(a / n_neighbors, 6) AS prediction_confidence FROM o JOIN vector_cells ON {_ID} = query")
def knn_classify(v):
    cells = _vectors(v)
    return A.knn_classify(cells.where("is_reference"), cells.where("not is_reference"), 10)


_REFINED = f"""r AS (SELECT * FROM vector_cells WHERE is_reference),
  {_by_id(_SELF).replace('vector_cells', 'r')}, {_VOTE.format(order='DESC')},
  f AS (SELECT o.*, sample_id, OID, CellType, embedding, a / n_neighbors AS conf, (a - b) / n_neighbors AS mar FROM o JOIN r ON {_ID} = query),
  g AS (SELECT *, CASE WHEN label = CellType THEN 'stable' WHEN conf >= 0.6 AND mar >= 0.1 THEN 'relabelled' ELSE 'kept_low_confidence' END AS status FROM f),
  refined AS (SELECT sample_id, OID, embedding, CellType, CASE WHEN status = 'relabelled' THEN label ELSE CellType END AS refined, status FROM g)"""


def _mapping(v) -> dict[str, DataFrame]:
    cells = _vectors(v).withColumn("norm", F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x))
    return A.map_fingerprints(cells, cells.where("is_reference"), ("norm",), 10, most=0)


@query(f"WITH {_REFINED} SELECT CellType, refined, status, count(*) AS n FROM refined GROUP BY 1, 2, 3")
def refinement_summary(v):
    return _mapping(v)["summary"]


@query(f"""WITH {_REFINED}, d2 AS (SELECT c.sample_id || '|' || c.OID AS query, r.sample_id || '|' || r.OID AS neighbour, r.refined AS label, list_distance(CAST(c.embedding AS DOUBLE[]), CAST(r.embedding AS DOUBLE[])) AS distance FROM vector_cells c JOIN refined r ON true),
  near2 AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY distance, neighbour) AS rank FROM d2 QUALIFY rank <= 10),
  n2 AS (SELECT query, label, count(*) AS votes FROM near2 GROUP BY 1, 2), k2 AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY votes DESC, label DESC) AS i FROM n2),
  o2 AS (SELECT query, max(label) FILTER (i = 1) AS label, coalesce(max(label) FILTER (i = 2), '') AS second, max(votes) FILTER (i = 1) AS a, coalesce(max(votes) FILTER (i = 2), 0) AS b, sum(votes) AS m FROM k2 GROUP BY 1)
  SELECT sample_id, OID, label AS CellType, second AS CellType_second, round(a / m, 6) AS prediction_confidence, round((a - b) / m, 6) AS prediction_margin,
  CASE WHEN a / m >= 0.8 THEN 'high_confidence' WHEN a / m >= 0.6 THEN 'medium_confidence' ELSE 'low_confidence' END AS prediction_status, 'n01' AS node_id, 'v01' AS version_id FROM o2 JOIN vector_cells ON {_ID} = query""")
def map_fingerprints(v):
    return _mapping(v)["predictions"]


@query("SELECT sample_id, OID, 'pca' AS dr_method, X, Y, cl_method, cluster FROM cells JOIN clusters USING (sample_id, OID)")
def join_dr_clusters(v):
    return A.embedding_clusters(v("cells").withColumn("dr_method", F.lit("pca")), v("clusters"))


@query("SELECT sample_id, OID, X, Y, cl_method, cluster FROM cells JOIN clusters USING (sample_id, OID) WHERE cl_method = 'som'")
def join_umap_cluster_ref(v):
    return A.cluster_reference(v("cells").select("sample_id", "OID", "X", "Y"), v("clusters").where("cl_method = 'som'"))


@query(f"""WITH {_ANNOTATED}, k AS (SELECT sample_id, OID, string_split(annotation, '_')[1] AS CellType, count(DISTINCT cl_method) AS votes FROM a GROUP BY ALL)
  SELECT sample_id, OID, QTY, CellType FROM cells JOIN k USING (sample_id, OID) WHERE 2 * votes > (SELECT count(DISTINCT cl_method) FROM a)""")
def join_consensus_ref(v):
    agreed = S.consensus(S.annotate(v("clusters"), v("annotation_dictionary")))
    return A.consensus_reference(v("cells").select("sample_id", "OID", "QTY"), agreed)


@query("SELECT sample_id, OID, cl_method, cluster FROM clusters WHERE cl_method <> 'phenograph'")
def stack_tables(v):
    c = v("clusters").withColumn("cluster", F.concat(F.lit(" "), "cluster")).withColumn("extra", F.lit(1))
    return A.stack_tables([c.where("cl_method = 'kmeans'"), None, c.where("cl_method = 'som'")], ("sample_id", "OID", "cl_method", "cluster"))


@query(f"""WITH {_ENRICH} SELECT sample_id, {', '.join(f"round(coalesce(max(log2_enrichment) FILTER (cluster = '{i}'), 0), 6) + 0.0 AS c{i}" for i in range(7))} FROM q WHERE cl_method = 'kmeans' GROUP BY 1""")
def enrichment_pivot(v):
    counts = v("clusters").where("cl_method = 'kmeans'").withColumn("cluster", F.concat(F.lit("c"), "cluster")).groupBy("cl_method", "cluster", "sample_id").agg(F.count("*").alias("n"))
    return A.enrichment_pivot(S.enrichment(counts), [f"c{i}" for i in range(7)])


@query("""WITH g AS (SELECT *, least(coalesce(n, 0), 3000) * 0.0003 AS p FROM (SELECT cl_method, cluster, sample_id, count(*) AS n FROM clusters GROUP BY 1, 2, 3)),
  k AS (SELECT *, row_number() OVER (PARTITION BY cl_method ORDER BY p, cluster, sample_id) AS r, count(*) OVER (PARTITION BY cl_method) AS m FROM g)
  SELECT cl_method, cluster, sample_id, round(least(1.0, min(p * m / r) OVER (PARTITION BY cl_method ORDER BY r DESC ROWS UNBOUNDED PRECEDING)), 6) AS q_value FROM k""")
def bh_adjust(v):
    n = v("clusters").groupBy("cl_method", "cluster", "sample_id").agg(F.count("*").alias("n")).withColumn("p", F.least("n", F.lit(3000)) * 0.0003)
    return S.bh_adjust(n, "p", ["cl_method"], ["cluster", "sample_id"]).select("cl_method", "cluster", "sample_id", "q_value")


@query("""WITH p AS (SELECT cl_method, cluster FROM annotation_dictionary WHERE cl_method = 'kmeans' AND annotation = 'TCELL_a'),
  d AS (SELECT CAST(least(floor(X / 2000 * 24), 23) AS INT) AS ix, CAST(least(floor(PRICE / 100000 * 24), 23) AS INT) AS iy, cluster IN (SELECT cluster FROM p) AS own
        FROM cells JOIN clusters USING (sample_id, OID) WHERE cl_method = 'kmeans' AND X BETWEEN 0 AND 2000 AND PRICE BETWEEN 0 AND 100000)
  SELECT ix, iy, round(ln(1 + count(*) FILTER (own)), 6) AS z, round(ln(1 + count(*) FILTER (NOT own)), 6) AS z_background, round(ln(1 + count(*) FILTER (own)) - ln(1 + count(*) FILTER (NOT own)), 6) + 0.0 AS diff FROM d GROUP BY 1, 2""")
def density_population(v):
    d = v("cells").join(v("clusters"), ["sample_id", "OID"])
    return A.density_population(d, A.population_clusters(v("annotation_dictionary"), "kmeans", "TCELL_a"), "X", "PRICE", (0.0, 2000.0), (0.0, 100000.0), 24)


@query("SELECT sample_id AS tissue, count(*) AS n_cells, sum(CASE WHEN QTY > 25 THEN 1 ELSE 0 END)::BIGINT AS n_masks, CAST(max(X) AS DOUBLE) AS width FROM cells GROUP BY 1")
def join_three_inputs(v):
    t = v("cells").withColumnRenamed("sample_id", "tissue").groupBy("tissue")
    return A.three_inputs(t.agg(F.count("*").alias("n_cells")), t.agg(F.sum((F.col("QTY") > 25).cast("long")).alias("n_masks")), t.agg(F.max("X").alias("width")))


@query("SELECT count(*) AS n_rows, count(*) FILTER (DISC = 0 OR TAX = 0) AS n_dropped, CAST(sum(CASE WHEN DISC = 0 THEN 1 ELSE 0 END + CASE WHEN TAX = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_null_cells FROM cells")
def null_report(v):
    return C.null_report(v("cells").select("OID", F.nullif("DISC", F.lit(0.0)).alias("DISC"), F.nullif("TAX", F.lit(0.0)).alias("TAX")))


@query("SELECT DISTINCT CellType FROM predictions WHERE CellType <> 'B'")
def selected_celltypes(v):
    return C.selected_celltypes(v("predictions").withColumn("include", (F.col("CellType") != "B").cast("int")))


_ALL_PAIRS = f"""{_ANNOTATED}, u AS (SELECT DISTINCT cl_method, sample_id, OID, annotation FROM a),
  n AS (SELECT x.cl_method AS method_x, y.cl_method AS method_y, x.annotation AS label_x, y.annotation AS label_y, count(*) AS n FROM u x JOIN u y ON x.sample_id = y.sample_id AND x.OID = y.OID AND x.cl_method < y.cl_method GROUP BY ALL),
  l AS (SELECT method_x, method_y, label_x, sum(n) AS n_x FROM n GROUP BY ALL), r AS (SELECT method_x, method_y, label_y, sum(n) AS n_y FROM n GROUP BY ALL), t AS (SELECT method_x, method_y, sum(n) AS t FROM n GROUP BY ALL),
  nm AS (SELECT method_x, method_y, label_x AS l FROM l UNION SELECT method_x, method_y, label_y FROM r),
  g AS (SELECT p.method_x, p.method_y, p.l AS label_x, q.l AS label_y, coalesce(n, 0) AS n, coalesce(n_x, 0) AS n_x, coalesce(n_y, 0) AS n_y FROM nm p JOIN nm q ON p.method_x = q.method_x AND p.method_y = q.method_y
    LEFT JOIN n ON n.method_x = p.method_x AND n.method_y = p.method_y AND n.label_x = p.l AND n.label_y = q.l LEFT JOIN l ON l.method_x = p.method_x AND l.method_y = p.method_y AND l.label_x = p.l
    LEFT JOIN r ON r.method_x = p.method_x AND r.method_y = p.method_y AND r.label_y = q.l),
  j AS (SELECT *, CASE WHEN n_x + n_y - n > 0 THEN n / (n_x + n_y - n) ELSE 0 END AS jaccard FROM g UNION ALL SELECT DISTINCT g.method_x, g.method_y, label_x, 'Total', n_x, n_x, t, 0 FROM g JOIN t USING (method_x, method_y)
    UNION ALL SELECT DISTINCT g.method_x, g.method_y, 'Total', label_y, n_y, t, n_y, 0 FROM g JOIN t USING (method_x, method_y) UNION ALL SELECT method_x, method_y, 'Total', 'Total', t, t, t, 0 FROM t)"""


@query(f"WITH {_ALL_PAIRS} SELECT method_x, method_y, label_x, label_y, CAST(n AS BIGINT) AS n, CAST(n_x AS BIGINT) AS n_x, CAST(n_y AS BIGINT) AS n_y, round(jaccard, 6) AS jaccard FROM j")
def jaccard_table(v):
    return S.jaccard_table(S.annotate(v("clusters"), v("annotation_dictionary")))


_RANGES = {"QTY": (0.0, 50.0), "DISC": (0.0, 0.1), "TAX": (0.0, 0.08)}
_BIN = lambda m: f"CASE WHEN {m} BETWEEN {_RANGES[m][0]} AND {_RANGES[m][1]} THEN CAST(least(floor(({m} - {_RANGES[m][0]}) / ({_RANGES[m][1]} - {_RANGES[m][0]}) * 12), 11) AS INT) END"


@query(f"""WITH d AS (SELECT * FROM cells JOIN clusters USING (sample_id, OID)), m AS (SELECT cl_method, cluster, unnest(['QTY', 'DISC', 'TAX']) AS marker, unnest([avg(QTY), avg(DISC), avg(TAX)]) AS mean FROM d GROUP BY 1, 2),
  b AS (SELECT * FROM m QUALIFY row_number() OVER (PARTITION BY cl_method, cluster ORDER BY mean DESC, marker) <= 2), p AS (SELECT x.cl_method, x.cluster, x.marker AS x_marker, y.marker AS y_marker FROM b x JOIN b y ON x.cl_method = y.cl_method AND x.cluster = y.cluster AND x.marker < y.marker),
  k AS (SELECT cl_method, cluster, 'DISC' AS x_marker, 'QTY' AS y_marker, {_BIN('DISC')} AS ix, {_BIN('QTY')} AS iy FROM d UNION ALL SELECT cl_method, cluster, 'DISC', 'TAX', {_BIN('DISC')}, {_BIN('TAX')} FROM d UNION ALL SELECT cl_method, cluster, 'QTY', 'TAX', {_BIN('QTY')}, {_BIN('TAX')} FROM d),
  n AS (SELECT cl_method, cluster, x_marker, y_marker, ix, iy, count(*) AS n FROM k WHERE ix IS NOT NULL AND iy IS NOT NULL GROUP BY ALL), e AS (SELECT cl_method, x_marker, y_marker, ix, iy, sum(n) AS t FROM n GROUP BY ALL),
  o AS (SELECT p.*, e.ix, e.iy, coalesce(n, 0) AS n, t FROM p JOIN e USING (cl_method, x_marker, y_marker) LEFT JOIN n ON n.cl_method = p.cl_method AND n.cluster = p.cluster AND n.x_marker = p.x_marker AND n.y_marker = p.y_marker AND n.ix = e.ix AND n.iy = e.iy)
  SELECT cl_method, cluster, x_marker, y_marker, ix, iy, round(ln(1 + n), 6) AS z, round(ln(1 + t - n), 6) AS z_other, round(ln(1 + t), 6) AS z_all, round(ln(1 + n) - ln(1 + t - n), 6) + 0.0 AS diff FROM o""")
def density_pairs(v):
    cells = v("cells").withColumns({m: F.col(m).cast("double") for m in _RANGES})
    return S.density_pairs(cells, v("clusters"), _RANGES, 2, 12)


@query()
def plot_sample_rows(v):
    return S.plot_sample(v("clusters"), 2500)


# manifests --------------------------------------------------------------------------------------------------------

_FILES = r"""f AS (SELECT *, split_part(folder, '_', 1) AS slide, CAST(regexp_extract(folder, '_R(\d+)', 1) AS INT) AS round, 'V' || regexp_extract(folder, '_V(\d+)', 1) AS version,
  regexp_extract(tile_filename, 'S(\d+)M(\d+)', 1) AS scene, CAST(regexp_extract(tile_filename, 'S(\d+)M(\d+)', 2) AS INT) AS tile, CASE WHEN tile_filename LIKE '%DAPI%' THEN 'DAPI' ELSE 'CY5' END AS channel FROM tile_files),
  man AS (SELECT 'BM' AS sample, slide, round, version, scene, tile, channel, tile_filename AS filename, folder || '/' || tile_filename AS path,
    CASE WHEN slide <> 'SL2' THEN CAST(replace(StageXPosition, ',', '.') AS DOUBLE) END AS stage_x_um, CASE WHEN slide <> 'SL2' THEN CAST(StageYPosition AS DOUBLE) END AS stage_y_um,
    CASE WHEN slide = 'SL0' THEN 6.5::DOUBLE END AS pixel_size_um, CASE WHEN slide <> 'SL2' THEN CAST(split_part(Frame, ',', 3) AS INT) END AS width_px,
    CASE WHEN slide = 'SL0' THEN 2040 END::INT AS height_px, round = 1 AND version = 'V02' AND slide = 'SL0' AS is_reference FROM f)"""


def _manifest(v, listed: DataFrame | None = None) -> DataFrame:
    f = v("tile_files")
    mosaic = f.where("folder like 'SL0%'")
    table = f.where("folder like 'SL1%'").select("folder", F.col("tile_filename").alias("file"), F.col("StageXPosition").alias("pos_x"), F.col("StageYPosition").alias("pos_y"), F.split("Frame", ",")[2].alias("w"))
    resolved = _session(f).createDataFrame([("SL0", s, 1, "V02") for s in "12"], "slide string, scene string, round int, version string")
    return M.build_manifest(mosaic, table, {"tile_filename": "file", "stage_x": "pos_x", "stage_y": "pos_y", "width": "w"}, f.select("folder", "tile_filename") if listed is None else listed, resolved)


@query(f"WITH {_FILES} SELECT * FROM man")
def manifest_build(v):
    return _manifest(v)


@query("SELECT DISTINCT split_part(folder, '_', 1) AS slide, split_part(folder, '_', 2) AS round, split_part(folder, '_', 3) AS version, 'PRJ' AS project, 'USR' AS user, CASE WHEN tile_filename LIKE '%DAPI%' THEN 'AF' ELSE 'CY5' END AS channel FROM tile_files")
def channel_table(v):
    channel = F.when(F.col("tile_filename").contains("DAPI"), "fitc_af").otherwise(" cy5 ")
    return M.channel_table(v("tile_files").select(F.col("folder").alias("basename"), channel.alias("channel")))


@query(f"""WITH {_FILES}, x AS (SELECT *, slide || '#' || version AS s FROM man), xy AS (SELECT s, scene, tile, min(tile % 40) * 1.5 AS x, min(tile) * 2.0 AS y FROM x WHERE tile % 5 <> 0 GROUP BY 1, 2, 3),
  ref AS (SELECT s, scene, tile, channel, min(filename) AS ref_filename FROM x WHERE round = 1 GROUP BY 1, 2, 3, 4)
  SELECT x.filename, x.s AS slide, x.scene, x.round, x.tile, CAST(xy.x AS DOUBLE) AS x, CAST(xy.y AS DOUBLE) AS y, ref_filename FROM x JOIN xy USING (s, scene, tile) LEFT JOIN ref ON ref.s = x.s AND ref.scene = x.scene AND ref.tile = x.tile AND ref.channel = x.channel""")
def tile_placement(v):
    i = _manifest(v).withColumn("slide", F.concat_ws("#", "slide", "version")).withColumn("project", F.lit("p")).withColumn("is_reference", F.col("round") == 1)
    xy = i.where("tile % 5 <> 0").groupBy("project", "scene", "tile", "slide").agg(F.min((F.col("tile") % 40) * 1.5).alias("x"), F.min(F.col("tile") * 2.0).alias("y"))
    return M.tile_placement(i, xy).select("filename", "slide", "scene", "round", "tile", "x", "y", "ref_filename")


@query(f"WITH {_FILES} SELECT filename, slide, round, channel, CASE WHEN round < 3 THEN channel || '-' || round END AS marker_id FROM man")
def join_exp_design(v):
    m = _manifest(v)
    design = m.where("round < 3").select("slide", "round", "channel", F.concat_ws("-", "channel", "round").alias("marker_id")).distinct()
    return M.join_design(m.select("filename", "slide", "round", "channel"), design)


@query("SELECT folder, tile_filename, min(folder || '/' || tile_filename) FILTER (M = (SELECT min(M) FROM tile_files g WHERE g.folder = f.folder)) OVER (PARTITION BY folder) AS ref_path FROM tile_files f")
def ref_broadcast(v):
    f = v("tile_files").withColumn("path", F.concat_ws("/", "folder", "tile_filename"))
    least = f.groupBy("folder").agg(F.min("M").alias("_m"))
    return M.broadcast_reference(f.join(least, "folder").withColumn("is_reference", F.col("M") == F.col("_m")), "folder").select("folder", "tile_filename", "ref_path")


_STRUCTURE = f"""{_FILES}, sub AS (SELECT * FROM man WHERE NOT (slide = 'SL2' AND round = 3) AND NOT (slide = 'SL1' AND scene = '2' AND round = 2) AND NOT (slide = 'SL0' AND version = 'V01' AND channel = 'DAPI') AND NOT (slide = 'SL2' AND scene = '1' AND round = 2)),
  h AS (SELECT DISTINCT slide, scene, round FROM sub),
  gaps AS (SELECT s.slide, s.scene, r.round FROM (SELECT DISTINCT slide, scene FROM h) s JOIN (SELECT DISTINCT slide, round FROM h) r USING (slide) WHERE NOT EXISTS (SELECT 1 FROM h WHERE h.slide = s.slide AND h.scene = s.scene AND h.round = r.round)),
  n AS (SELECT slide, count(DISTINCT round) AS n FROM sub GROUP BY 1)"""


@query(f"""WITH {_STRUCTURE} SELECT 'round_gap' AS "check", 'warning' AS level, slide || '/' || scene || '/' || round AS detail FROM gaps
  UNION ALL SELECT 'round_count', 'warning', slide || '/' || n FROM n WHERE n < (SELECT max(n) FROM n)
  UNION ALL SELECT 'no_register_channel', 'warning', slide || '/' || scene || '/' || round || '/' || version FROM sub GROUP BY slide, scene, round, version HAVING count(*) FILTER (channel = 'DAPI') = 0
  UNION ALL SELECT 'single_round', 'warning', slide || '/' || scene FROM sub GROUP BY slide, scene HAVING count(DISTINCT (round, version)) <= 1""")
def qc_structure(v):
    m = _manifest(v).where("not (slide = 'SL2' and round = 3) and not (slide = 'SL1' and scene = '2' and round = 2)")
    return M.qc_structure(m.where("not (slide = 'SL0' and version = 'V01' and channel = 'DAPI') and not (slide = 'SL2' and scene = '1' and round = 2)"))


@query(f"""WITH {_FILES}, need AS (SELECT count(*) FILTER (width_px IS NULL) AS w, count(*) FILTER (height_px IS NULL) AS h, count(*) FILTER (stage_x_um IS NULL OR stage_y_um IS NULL OR pixel_size_um IS NULL) AS s,
    count(*) FILTER (tile % 50 = 0) AS lost FROM man),
  t AS (SELECT DISTINCT slide, round, scene, tile FROM man), f1 AS (SELECT slide, min(round) AS first FROM t GROUP BY 1),
  d AS (SELECT DISTINCT a.slide, a.round FROM (SELECT DISTINCT slide, round FROM t) a JOIN f1 USING (slide) WHERE EXISTS (SELECT 1 FROM t WHERE t.slide = a.slide AND t.round = a.round AND NOT EXISTS (SELECT 1 FROM t u WHERE u.slide = t.slide AND u.round = f1.first AND u.scene = t.scene AND u.tile = t.tile))
        OR EXISTS (SELECT 1 FROM t WHERE t.slide = a.slide AND t.round = f1.first AND NOT EXISTS (SELECT 1 FROM t u WHERE u.slide = t.slide AND u.round = a.round AND u.scene = t.scene AND u.tile = t.tile)))
  SELECT 'required' AS "check", 'error' AS level, 'width_px: ' || w AS detail FROM need WHERE w > 0 UNION ALL SELECT 'required', 'error', 'height_px: ' || h FROM need WHERE h > 0
  UNION ALL SELECT 'files', 'error', CAST(lost AS VARCHAR) FROM need WHERE lost > 0 UNION ALL SELECT 'stage', 'warning', CAST(s AS VARCHAR) FROM need WHERE s > 0
  UNION ALL SELECT 'tile_set', 'warning', slide || '/' || round FROM d
  UNION ALL SELECT 'channels', 'warning', r.slide || '/' || r.round || '/' || c.channel FROM (SELECT DISTINCT slide, round FROM man) r JOIN (SELECT DISTINCT slide, channel FROM man) c USING (slide)
    WHERE NOT EXISTS (SELECT 1 FROM man m WHERE m.slide = r.slide AND m.round = r.round AND m.channel = c.channel)""")
def qc_manifest(v):
    m = _manifest(v)
    return M.qc_manifest(m, False, m.where("tile % 50 <> 0").select("path"))


_ACQUIRED = """a AS (SELECT slide_id AS folder, 'R' || lpad(CAST(round_n % 20 + 1 AS VARCHAR), 2, '0') AS round_number, marker_id, CASE WHEN round_n % 17 = 0 THEN 'FITC' ELSE 'CY5' END AS channel_id, round_n % 20 AS cycle FROM acquisitions WHERE round_n <= 40),
  files AS (SELECT folder, round_number FROM a WHERE cycle <> 5), first AS (SELECT min(folder) AS f FROM a)"""


def _differs(value: str) -> str:
    return f"""SELECT DISTINCT folder FROM a x WHERE EXISTS (SELECT 1 FROM a y, first WHERE y.folder = f AND NOT EXISTS (SELECT 1 FROM a z WHERE z.folder = x.folder AND z.{value} = y.{value}))
    OR EXISTS (SELECT 1 FROM a y WHERE y.folder = x.folder AND NOT EXISTS (SELECT 1 FROM a z, first WHERE z.folder = f AND z.{value} = y.{value}))"""


@query(f"""WITH {_ACQUIRED}, lost AS (SELECT DISTINCT folder FROM a WHERE cycle = 5)
  SELECT 'xpd_file' AS "check", 'error' AS level, folder AS detail FROM (SELECT DISTINCT folder FROM a) WHERE folder LIKE '%3' UNION ALL SELECT DISTINCT 'channel_names', 'error', folder FROM a WHERE channel_id = 'FITC'
  UNION ALL SELECT 'raw_folder', 'error', folder FROM (SELECT DISTINCT folder FROM a) WHERE folder LIKE '%4' UNION ALL SELECT 'matching_rounds', 'error', folder FROM lost
  UNION ALL SELECT 'same_rounds', 'error', folder FROM ({_differs('round_number')}) UNION ALL SELECT 'same_markers', 'error', folder FROM ({_differs('marker_id')})""")
def qc_phenocycler(v):
    a = v("acquisitions").where("round_n <= 40").select(
        F.col("slide_id").alias("folder"), (F.col("round_n") % 20).alias("cycle"), "marker_id", F.when(F.col("round_n") % 17 == 0, "FITC").otherwise("CY5").alias("channel_id"))
    a = a.withColumn("round_number", F.concat(F.lit("R"), F.lpad((F.col("cycle") + 1).cast("string"), 2, "0")))
    folders = a.select("folder").distinct().select("folder", (~F.col("folder").endswith("3")).alias("has_xpd"), (~F.col("folder").endswith("4")).alias("has_raw"))
    images = a.where("cycle <> 5").select("folder", F.concat(F.lit("x_Cycle"), F.col("cycle").cast("string"), F.lit(".qptiff")).alias("file"))
    scratch = a.select("folder", F.lit("x_Cycle5.intermediate.qptiff").alias("file"))
    return M.qc_phenocycler(folders, a, images.union(scratch))


@query("""WITH n AS (SELECT slide_id AS folder, count(*) AS n FROM acquisitions GROUP BY 1), k AS (SELECT folder, least(n, 3) AS k FROM n), u AS (SELECT k FROM k GROUP BY 1 ORDER BY count(*) DESC, k LIMIT 1)
  SELECT 'job_file' AS "check", 'error' AS level, folder AS detail FROM n WHERE n % 5 = 0 UNION ALL SELECT 'image_file', 'error', folder FROM n WHERE n % 4 <> 1
  UNION ALL SELECT 'cycle_count', 'error', folder FROM k, u WHERE k.k <> u.k UNION ALL SELECT DISTINCT 'cycle_folder', 'error', slide_id FROM acquisitions WHERE round_n = 2 AND slide_id LIKE '%7'""")
def qc_comet(v):
    a = v("acquisitions")
    n = a.groupBy(F.col("slide_id").alias("folder")).agg(F.count("*").alias("n"))
    names = F.concat(F.array_repeat(F.lit("job.xml"), F.when(F.col("n") % 5 == 0, 0).otherwise(1)), F.array_repeat(F.lit("image.ome.tiff"), (F.col("n") % 4).cast("int")))
    cycle = F.concat(F.when((F.col("round_n") == 2) & F.col("slide_id").endswith("7"), "cycle").otherwise("Cycle"), F.lit("_"), F.col("round_n").cast("string"))
    cycles = a.where("round_n <= 3").select(F.col("slide_id").alias("folder"), F.col("round_n").alias("cycle_number"), cycle.alias("cycle_folder"))
    return M.qc_comet(n.select("folder", F.explode(names).alias("file")).union(n.select("folder", F.lit("other.txt"))), cycles)


@query("WITH s AS (SELECT DISTINCT slide_id FROM acquisitions), m AS (SELECT DISTINCT round_n FROM acquisitions) SELECT slide_id, round_n FROM s CROSS JOIN m EXCEPT SELECT slide_id, round_n FROM acquisitions")
def qc_same_rounds(v):
    return Q.set_differences(v("acquisitions"), "slide_id", "round_n")


@query("SELECT pair, method, score, coalesce(score < 0.05, true) AS flagged FROM estimates")
def qc_registration_flag(v):
    return Q.low_scores(v("estimates").select("pair", "method", "score"), "score", 0.05)


# overlaps ---------------------------------------------------------------------------------------------------------

_PAIRS = """p AS (SELECT a.slide, a.scene, a.tile AS a, b.tile AS b, greatest(a.x0, b.x0) AS x0, least(a.x1, b.x1) AS x1, greatest(a.y0, b.y0) AS y0, least(a.y1, b.y1) AS y1
  FROM round_tiles a JOIN round_tiles b ON a.slide = b.slide AND a.scene = b.scene WHERE a.round_n = 0 AND b.round_n = 1),
  pairs AS (SELECT slide, scene, a, b, CAST(x0 AS DOUBLE) AS x0, CAST(x1 AS DOUBLE) AS x1, CAST(y0 AS DOUBLE) AS y0, CAST(y1 AS DOUBLE) AS y1 FROM p WHERE x0 <= x1 AND y0 <= y1)"""


def _round_tiles(v) -> DataFrame:
    t = v("round_tiles")
    return t.withColumns({c: F.col(c).cast("double") for c in ("x0", "x1", "y0", "y1")})


def _pairs(v) -> DataFrame:
    t = _round_tiles(v)
    return O.pair_boxes(t.where("round_n = 0"), t.where("round_n = 1"))


@query(f"WITH {_PAIRS} SELECT * FROM pairs")
def pair_boxes(v):
    return _pairs(v)


@query(f"WITH {_PAIRS} SELECT * FROM pairs WHERE (x1 - x0) * (y1 - y0) >= 0.01 * 1000000")
def pair_area_filter(v):
    return O.pair_area_filter(_pairs(v), 1_000_000.0, 0.01)


_NEIGHBOURS = "nb AS (SELECT a.tile, b.tile AS other FROM round_tiles a JOIN round_tiles b ON a.slide = b.slide AND a.tile <> b.tile AND abs(a.x0 - b.x0) <= 2000 AND a.y0 = b.y0)"


@query(f"""WITH {_PAIRS}, {_NEIGHBOURS}, best AS (SELECT * FROM pairs QUALIFY row_number() OVER (PARTITION BY a ORDER BY (x1 - x0) * (y1 - y0) DESC, b) = 1)
  SELECT DISTINCT best.a, nb.other AS b, best.b AS via, best.x0 - (v.x0 - o.x0) AS x0, best.x1 - (v.x0 - o.x0) AS x1, best.y0 - (v.y0 - o.y0) AS y0, best.y1 - (v.y0 - o.y0) AS y1
  FROM best JOIN nb ON nb.tile = best.b JOIN round_tiles v ON v.tile = best.b JOIN round_tiles o ON o.tile = nb.other
  WHERE NOT EXISTS (SELECT 1 FROM pairs p WHERE p.a = best.a AND p.b = nb.other AND (p.x1 - p.x0) * (p.y1 - p.y0) >= 0.01 * 1000000)""")
def pair_extend(v):
    t = _round_tiles(v)
    one, two = t.select("slide", "y0", "tile", "x0"), t.select("slide", "y0", F.col("tile").alias("other"), F.col("x0").alias("x"))
    near = one.join(two.hint("merge"), ["slide", "y0"]).where("tile <> other and abs(x0 - x) <= 2000").select("tile", "other")
    return O.extend_pairs(_pairs(v), near, t.select("tile", F.col("x0").alias("x"), F.col("y0").alias("y")), 1_000_000.0, 0.01)


def _groups(v) -> DataFrame:
    return O.overlap_groups(_round_tiles(v), ("slide", "scene"))


@query()
def overlap_groups(v):
    return _groups(v)


_TWO = """t AS (SELECT a.slide, a.scene, a.tile AS a, b.tile AS b FROM round_tiles a JOIN round_tiles b ON a.slide = b.slide AND a.scene = b.scene AND a.tile < b.tile
    WHERE greatest(a.x0, b.x0) <= least(a.x1, b.x1) AND greatest(a.y0, b.y0) <= least(a.y1, b.y1)),
  m AS (SELECT slide, scene, a, b, unnest([a, b]) AS tile FROM t), s AS (SELECT *, CASE WHEN tile % 11 <> 0 THEN (tile % 7) / 10.0 END AS score FROM m)"""


@query(f"WITH {_TWO} SELECT slide, scene, a, b, tile, CAST(row_number() OVER (PARTITION BY slide, scene, a, b ORDER BY coalesce(score, 0) DESC, CAST(tile AS VARCHAR)) AS INT) AS rank FROM s")
def overlap_winner(v):
    t = _round_tiles(v)
    g = O.pair_boxes(t, t).where("a < b").withColumn("members", F.array("a", "b"))
    scores = g.select("members", F.explode("members").alias("tile")).distinct().withColumn("score", F.when(F.col("tile") % 11 != 0, (F.col("tile") % 7) / 10))
    return O.overlap_winners(g, scores).select("slide", "scene", "a", "b", "tile", "rank")


@query("""WITH o AS (SELECT pair, method, CASE WHEN method IN ('features', 'phase') THEN 'left' ELSE 'down' END AS direction, CASE WHEN method IN ('features', 'phase') THEN -dx ELSE dx END AS along, dy AS across FROM estimates)
  SELECT pair, method FROM o WHERE abs(along) BETWEEN 0.5 * 0.1 * 200 AND 1.5 * 0.1 * 200 AND abs(across) <= 0.01 * 300 AND greatest(abs(along), abs(across)) <= 300""")
def pair_offset_filter(v):
    side = F.col("method").isin("features", "phase")
    o = v("estimates").select("pair", "method", F.when(side, "left").otherwise("down").alias("direction"), F.when(side, -F.col("dx")).otherwise(F.col("dx")).cast("double").alias("along"), F.col("dy").cast("double").alias("across"))
    wide, high = O.pair_offset_filter(o.where("direction = 'left'"), 0.1, 200.0, 300.0), O.pair_offset_filter(o.where("direction = 'down'"), 0.1, 300.0, 200.0)
    return wide.union(high).select("pair", "method")


@query()
def transform_consensus(v):
    names = {"features": "imreg_dft", "phase": "cv2", "template": "aa", "grid": "chi2_no_angle"}
    e = v("estimates").replace(names, subset=["method"])
    return O.transform_consensus(e.select("pair", "method", F.col("dx").cast("double").alias("dx"), F.col("dy").cast("double").alias("dy"), (F.coalesce("score", F.lit(0.0)) * 150).cast("double").alias("angle")))


@query("SELECT folder, tile_filename, 0.65::DOUBLE AS px, round(2.6 / 0.65, 6) AS conversion FROM tile_files")
def px_scale(v):
    return O.pixel_scale(v("tile_files"), 2.6).select("folder", "tile_filename", "px", "conversion")


_BOXES = "b AS (SELECT OID, min(r) AS minr, min(c) AS minc, max(r) + 1 AS maxr, max(c) + 1 AS maxc FROM label_pixels WHERE OID <> 0 GROUP BY 1)"


@query(f"""WITH {_BOXES} SELECT OID, minr * 4.0 AS minr_full, minc * 4.0 AS minc_full, least(maxr * 4.0, 390) AS maxr_full, least(maxc * 4.0, 580) AS maxc_full, minr * 2.0 AS minr_qc, minc * 2.0 AS minc_qc, least(maxr * 2.0, 200) AS maxr_qc, least(maxc * 2.0, 290) AS maxc_qc FROM b""")
def bbox_rescale(v):
    b = O.rescale_boxes(P.boxes(v("label_pixels")), 4.0, 2.0, (100, 150), (390, 580), (200, 290))
    return b.select("OID", *(F.col(f"{m}{x}_{end}").cast("double").alias(f"{m}{x}_{end}") for end in ("full", "qc") for m in ("min", "max") for x in "rc"))


@query(f"""WITH {_BOXES}, n AS (SELECT *, 'S' || (row_number() OVER (ORDER BY minr, minc, OID) - 1) AS scan_region FROM b)
  SELECT scan_region, minr * 4 AS offset_row, minc * 4 AS offset_col, minr * 4 AS global_minr, minc * 4 AS global_minc, CAST(least(maxr * 4, 390) AS BIGINT) AS global_maxr, CAST(least(maxc * 4, 580) AS BIGINT) AS global_maxc FROM n""")
def scene_offsets(v):
    return O.scene_offsets(O.rescale_boxes(P.boxes(v("label_pixels")), 4.0, 2.0, (100, 150), (390, 580), (200, 290)))


@query(f"""WITH {_BOXES}, n AS (SELECT *, row_number() OVER (ORDER BY minr, minc, OID) - 1 AS i FROM b)
  SELECT 'S' || i AS scan_region, 'M' || OID % 3 AS slide_name, (minr + maxr) / 2 AS meanr, (minc + maxc) / 2 AS meanc, CAST(i + 1 AS INT) AS scene_number, count(*) OVER (PARTITION BY OID % 3) AS slide_number_scenes, 'U' AS project_operator FROM n""")
def scene_centroids(v):
    b = P.boxes(v("label_pixels")).withColumn("stem", F.concat(F.lit("M"), (F.col("OID") % 3).cast("string"), F.lit("_R01_V01_P_U_DAPI")))
    return O.scene_centroids(b).select("scan_region", "slide_name", "meanr", "meanc", "scene_number", "slide_number_scenes", "project_operator")


@query("SELECT slide_id, marker_id, round_n FROM acquisitions QUALIFY row_number() OVER (PARTITION BY slide_id, marker_id ORDER BY round_n) = 1")
def one_per_group(v):
    return O.one_per_group(v("acquisitions").select("slide_id", "marker_id", "round_n"), ["slide_id", "marker_id"], "round_n")


@query("SELECT DISTINCT slide, slide || '-x y' AS folder FROM tiles")
def fn_normalise_text(v):
    return v("tiles").select("slide").distinct().withColumn("folder", O.normalise_text(F.concat(F.lit(" 　"), "slide", F.lit("–x   y \t"))))


@query("""WITH q AS (SELECT slide, region, x0 + 5000 AS x0, y0 - 2000 AS y0, x1 + 5000 AS x1, y1 - 2000 AS y1 FROM tile_boxes),
  i AS (SELECT a.slide, a.region AS a, b.region AS b, greatest(0, least(a.x1, b.x1) - greatest(a.x0, b.x0)) * greatest(0, least(a.y1, b.y1) - greatest(a.y0, b.y0)) AS o FROM tile_boxes a JOIN q b ON a.slide = b.slide),
  j AS (SELECT slide, a, b, o / (2 * 20000.0 * 20000 - o) AS iou FROM i) SELECT slide, a, b, round(iou, 6) AS iou FROM j QUALIFY iou = max(iou) OVER (PARTITION BY slide, a)""")
def box_iou(v):
    b = v("tile_boxes").select("slide", F.col("region").alias("name"), *(F.col(c).cast("double").alias(c) for c in ("x0", "y0", "x1", "y1")))
    moved = b.withColumns({"x0": F.col("x0") + 5000, "x1": F.col("x1") + 5000, "y0": F.col("y0") - 2000, "y1": F.col("y1") - 2000})
    return T.best_ties(T.box_iou(b, moved), ["slide", "a"], "iou")


@query("SELECT slide_id, channel_id, count(DISTINCT marker_id) AS n_names, count(DISTINCT round_n % 4) AS n_indexes FROM images GROUP BY 1, 2 HAVING count(DISTINCT marker_id) <> count(DISTINCT round_n % 4)")
def qc_channel_names(v):
    return Q.channel_counts(v("images").withColumn("i", F.col("round_n") % 4), ["slide_id", "channel_id"], "marker_id", "i")


# pixels -----------------------------------------------------------------------------------------------------------

@query("""WITH w AS (SELECT CAST(floor(r / 25) AS INT) AS k, r, c, CASE WHEN k2 % 7 = 0 THEN 0 ELSE k2 END AS OID FROM (SELECT r, c, CAST(floor(c / 10) AS INT) + 1 AS k2 FROM pixels WHERE image_id = 'MS') p),
  l AS (SELECT k AS "window", r, c, OID FROM w UNION ALL SELECT k + 1, r, c, OID FROM w WHERE r % 25 >= 20 AND OID % 2 = 0), b AS (SELECT "window", sum(max(OID)) OVER (ORDER BY "window") - max(OID) AS b FROM l GROUP BY 1),
  f AS (SELECT r, c, min("window") AS first FROM l WHERE OID <> 0 GROUP BY 1, 2), x AS (SELECT DISTINCT "window", OID FROM l JOIN f USING (r, c) WHERE OID <> 0 AND "window" > first)
  SELECT r, c, CAST(OID + b AS BIGINT) AS OID FROM l JOIN b USING ("window") WHERE OID <> 0 AND NOT EXISTS (SELECT 1 FROM x WHERE x."window" = l."window" AND x.OID = l.OID)""")
def seg_label_offset(v):
    k = F.floor(F.col("c") / 10).cast("int") + 1
    w = v("pixels").where("image_id = 'MS'").select(F.floor(F.col("r") / 25).cast("int").alias("window"), "r", "c", F.when(k % 7 == 0, 0).otherwise(k).alias("OID"))
    again = w.where("r % 25 >= 20 and OID % 2 = 0").withColumn("window", F.col("window") + 1)
    return P.offset_labels(w.union(again))


@query("SELECT file_name, CASE WHEN channel_id = 'C0' THEN 'KASK' WHEN channel_id = 'C1' THEN 'BASIC' END AS method FROM images")
def ffc_method(v):
    i = v("images").withColumnRenamed("channel_id", "channel").withColumn("technology", F.lit("MILAN"))
    known = i.select("channel").distinct().where("channel in ('C0', 'C1')").select(F.lit("MILAN").alias("technology"), "channel", F.when(F.col("channel") == "C0", "KASK").otherwise("BASIC").alias("method"))
    return P.field_method(i, known).select("file_name", "method")


@query("""SELECT CAST(r // 16 AS INT) AS tmp_row, CAST(c // 16 AS INT) AS tmp_column, CASE WHEN max(v) > 55000 THEN 0 ELSE max(v) END AS score FROM pixels WHERE image_id = 'MS' GROUP BY 1, 2 HAVING max(v) BETWEEN 1 AND 55000""")
def patch_score_table(v):
    s = P.patches(v("pixels").where("image_id = 'MS'"), 16).select("pr", "pc", F.when(F.col("most") > 55000, 0.0).otherwise(F.col("most")).alias("score"))
    return P.patch_score_table(s)


_VERSIONS = """ref AS (SELECT p.r, p.c, CASE WHEN l.OID = 0 THEN 0 ELSE p.v END AS v FROM pixels p JOIN label_pixels l ON l.r = p.r AND l.c = p.c WHERE image_id = 'MS'),
  alt AS (SELECT r, c, v FROM pixels WHERE image_id = 'AF' AND v > 0), hole AS (SELECT r, c FROM ref WHERE v = 0), solid AS (SELECT r, c, v FROM ref WHERE v <> 0),
  o AS (SELECT i, j, sqrt(i * i + j * j) AS d FROM (SELECT unnest(range(-4, 5)) AS i) x, (SELECT unnest(range(-4, 5)) AS j) y WHERE i * i + j * j <= 16),
  ring AS (SELECT DISTINCT s.r, s.c, s.v FROM hole h, o JOIN solid s ON s.r = h.r + o.i AND s.c = h.c + o.j),
  fit AS (SELECT regr_slope(ring.v, alt.v) AS a, regr_intercept(ring.v, alt.v) AS b, count(*) AS n FROM ring JOIN alt USING (r, c)),
  deep AS (SELECT h.r, h.c, min(o.d) AS d FROM solid s, o JOIN hole h ON h.r = s.r + o.i AND h.c = s.c + o.j GROUP BY 1, 2)"""


@query(f"""WITH {_VERSIONS} SELECT ref.r, ref.c, round(CASE WHEN h.r IS NULL OR alt.v IS NULL THEN ref.v ELSE least(1.0, coalesce(d / 4, 1.0)) *
    least(65535.0, greatest(0.0, (CASE WHEN n > 200 THEN greatest(a, 0) ELSE 1 END) * alt.v + CASE WHEN n > 200 THEN b ELSE 0 END)) END, 6) + 0.0 AS v
  FROM fit, ref LEFT JOIN hole h ON h.r = ref.r AND h.c = ref.c LEFT JOIN alt ON alt.r = ref.r AND alt.c = ref.c LEFT JOIN deep ON deep.r = ref.r AND deep.c = ref.c""")
def merge_versions_match(v):
    ref = v("pixels").where("image_id = 'MS'").join(v("label_pixels"), ["r", "c"]).select("r", "c", F.when(F.col("OID") == 0, 0.0).otherwise(F.col("v")).alias("v"))
    return P.match_versions(ref, v("pixels").where("image_id = 'AF'"), 4)


@query("""WITH f AS (SELECT OID, count(*) AS area, avg(l.c) AS X, avg(l.r) AS Y, avg(v) FILTER (image_id = 'MS') AS signal FROM label_pixels l JOIN pixels p ON p.r = l.r AND p.c = l.c WHERE OID <> 0 AND image_id = 'MS' GROUP BY 1)
  SELECT OID, area, round(X, 6) AS X, round(Y, 6) AS Y, round(signal, 6) AS signal, 'scene01' AS scene_id FROM f""")
def feature_table(v):
    return P.feature_table(v("pixels"), v("label_pixels"), {"MS": "signal", "AF": None}, "scene01")


@query("""WITH s AS (SELECT image_id, max(r) + 1 AS rows, max(c) + 1 AS cols FROM pixels GROUP BY 1), d AS (SELECT p.*, CAST(floor((8 - rows) / 2.0) AS INT) AS offset_r, CAST(floor((160 - cols) / 2.0) AS INT) AS offset_c FROM pixels p JOIN s USING (image_id))
  SELECT image_id, CAST(r + offset_r AS INT) AS r, CAST(c + offset_c AS INT) AS c, v, offset_r, offset_c FROM d WHERE r + offset_r BETWEEN 0 AND 7 AND c + offset_c BETWEEN 0 AND 159""")
def px_crop_or_pad(v):
    return P.crop_or_pad(v("pixels"), 8, 160)


@query("SELECT image_id, CAST(r - 3 AS INT) AS r, CAST(c - 50 AS INT) AS c, v FROM pixels WHERE r BETWEEN 3 AND 5 AND c BETWEEN 50 AND 99")
def px_middle_tile(v):
    return P.middle_tile(v("pixels"), 3, 50)


@query("""WITH b AS (SELECT image_id, min(r) + 2 AS r0, max(r) - 2 AS r1, min(c) + 2 AS c0, max(c) - 2 AS c1 FROM pixels WHERE v <> 0 GROUP BY 1), t AS (SELECT p.* FROM pixels p JOIN b USING (image_id) WHERE r BETWEEN r0 AND r1 AND c BETWEEN c0 AND c1 AND v <> 0)
  SELECT r, c, arg_max(v, CASE WHEN image_id = 'AF' THEN 2 ELSE 1 END) AS v FROM t GROUP BY 1, 2""")
def two_pass_layers(v):
    px = v("pixels")
    return P.two_pass_layers(px, px.select("image_id").distinct().withColumn("score", F.when(F.col("image_id") == "AF", 2.0).otherwise(1.0)), 2)


@query()
def paint_cells_rgb(v):
    l = v("label_pixels")  # noqa: E741
    colours = l.where("OID % 3 <> 2").select("OID", (F.col("OID") % 256).alias("red"), F.lit(100).alias("green"), F.lit(0).alias("blue")).distinct()
    return P.paint_rgb(l, colours.union(colours.withColumn("red", F.lit(200))))


@query()
def afs_class(v):
    px = v("pixels").withColumn("part", F.floor(F.col("r") / 30).cast("string"))
    hist = px.where("image_id = 'AF'").groupBy(F.col("part").alias("image_id"), F.least(F.floor(F.col("v") / 25), F.lit(39)).cast("int").alias("bin")).agg(F.count("*").alias("n"))
    total = hist.groupBy("image_id").agg(F.sum("n").alias("t"))
    hist = hist.join(total, "image_id").select("image_id", "bin", (100 * F.col("n") / F.col("t")).alias("share"))
    medoids = hist.where("image_id in ('0', '1')").select(F.concat(F.lit("class"), "image_id").alias("class"), "bin", F.col("share").alias("value"))
    return P.nearest_medoid(hist, medoids)


# learning ---------------------------------------------------------------------------------------------------------

@query()
def som(v):
    return L.som(v("cells"), MARKERS, ("sample_id", "OID"), 5)


@query()
def graph_communities(v):
    cells = v("vector_cells")
    return L.communities(N.jaccard_graph(N.knn(cells, cells, 10, skip_self=True), 10))


# files ------------------------------------------------------------------------------------------------------------

def _sample(v) -> DataFrame:
    return v("cells").select("sample_id", "OID", "X", "TAX")


@query("SELECT sample_id, OID, X, TAX FROM cells")
def src_table(v):
    df = _sample(v)
    path = new_path(_session(df), "table") + "/t.csv"
    files.write_table(df, path)
    return files.read_table(_session(df), path)


@query("SELECT sample_id, OID, X, TAX FROM cells")
def src_sniff_decimal(v):
    df = _sample(v)
    path = new_path(_session(df), "table") + "/t.csv"
    comma = lambda c: F.replace(F.col(c).cast("string"), F.lit("."), F.lit(","))
    files.write_table(df.withColumns({c: comma(c) for c in ("X", "TAX")}), path)
    return files.read_table(_session(df), path)


@query("SELECT sample_id, OID, X, TAX FROM cells")
def src_folder_union(v):
    df = _sample(v)
    paths = []
    for i, part in enumerate((df.where("X < 100"), df.where("X >= 100"))):
        paths.append(f"{new_path(_session(df), 'table')}/{i}.parquet")
        files.write_table(part, paths[-1])
    return files.read_folder(_session(df), paths)


@query("SELECT sample_id AS part, OID FROM cells")
def sink_per_sample(v):
    df = _sample(v)
    path = new_path(_session(df), "samples")
    files.write_per_sample(df, path)
    return _session(df).read.option("header", True).csv(path).select("part", "OID")


@query("""SELECT cl_method, cluster, coalesce(annotation, '') AS annotation FROM annotation_dictionary""")
def sink_annotation_state(v):
    state = S.annotation_state(v("annotation_dictionary"))
    item = "struct<clusters:array<struct<cl_method:string,cluster:string,annotation:string>>>"
    return state.select(F.explode(F.from_json("state", item)["clusters"]).alias("x")).select("x.*")


@query("SELECT slide_id, round_n, 'C' || round_n AS channel_name FROM acquisitions")
def src_jobfile_xml(v):
    a = v("acquisitions").select("slide_id", "round_n")
    path = new_path(_session(a), "jobs")
    cycle = F.concat(F.lit('<CycleModels TileFolderPath="x/'), "slide_id", F.lit("/Cycle_"), F.col("round_n").cast("string"), F.lit('/"><ChannelMeta><Channel Name="C'), F.col("round_n").cast("string"), F.lit('"/></ChannelMeta></CycleModels>'))
    jobs = a.groupBy("slide_id").agg(F.concat(F.lit("<Job>"), F.array_join(F.collect_list(cycle), ""), F.lit("</Job>")).alias("value"))
    folders.write_files(jobs.select(F.concat("slide_id", F.lit(".xml")).alias("path"), F.col("value").alias("content")), path)  # tasks write them; a committer would rename each on the driver
    found = files.read_job_files(_session(a), path)
    return found.select(F.regexp_extract("tile_folder", "x/(.*)/Cycle", 1).alias("slide_id"), F.col("cycle_number").alias("round_n"), "channel_name")

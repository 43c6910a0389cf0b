"""Steps that must stay whole on tables whose compressed files look small."""

from pyspark.sql import functions as F

from tessera.operators import overlaps as O
from tessera.operators import tiles as T
from tessera.operators.rectangles import meeting
from tessera.plans.lineage import cut


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _tiles(spark):
    t = spark.range(4000).select(F.lit("s").alias("slide"), F.col("id").cast("int").alias("tile"), (F.col("id") % 40 * 1836.0).alias("stage_x"), (F.floor(F.col("id") / 40) * 1836.0).alias("stage_y"))
    return cut(t, "tiles")


def test_tile_neighbours_broadcast_no_table(spark):
    got = T.tile_neighbours(_tiles(spark))
    assert "BroadcastHashJoin" not in _plan(got)
    assert {r["tile"]: tuple(r)[2:] for r in got.where("tile in (0, 41)").collect()} == {0: (1, None, 40, None), 41: (42, 40, 81, 1)}


def test_pairs_and_their_extension_broadcast_no_table(spark):
    t = _tiles(spark)
    near = t.select("tile", (F.col("tile") + 1).alias("other"))
    pairs = cut(t.select(F.col("tile").alias("a"), (F.col("tile") + 40).alias("b"), *(F.lit(x).alias(c) for c, x in (("x0", 0.0), ("x1", 9.0), ("y0", 0.0), ("y1", 9.0)))), "pairs")
    got = O.extend_pairs(pairs, near, t.select("tile", F.col("stage_x").alias("x"), F.col("stage_y").alias("y")), 100.0)
    assert "BroadcastHashJoin" not in _plan(got)
    assert tuple(got.where("a = 0").first()) == (0, 41, 40, 1836.0, 1845.0, 0.0, 9.0)


def test_meeting_rectangles_are_merged(spark):
    t = _tiles(spark).select("slide", F.col("tile").alias("id"), F.col("stage_x").alias("x0"), (F.col("stage_x") + 2040).alias("x1"), F.col("stage_y").alias("y0"), (F.col("stage_y") + 2040).alias("y1"))
    got = meeting(t, t, ["slide"]).where("a < b")
    assert _plan(got).count("SortMergeJoin") >= 2
    assert got.where("a = 41").count() == 4


def test_winners_merge_their_scores(spark):
    g = cut(spark.range(300).select(F.array(F.col("id"), F.col("id") + 1).alias("members")), "groups")
    scores = cut(g.select("members", F.explode("members").alias("tile")).withColumn("score", F.col("tile") % 7 / 1.0), "scores")
    got = O.overlap_winners(g, scores)
    assert "BroadcastHashJoin" not in _plan(got) and got.where("rank = 1").count() == 300


def test_kmeans_reads_its_rows_once_for_all_restarts(spark):
    from tessera.operators import learning as L

    seen = spark.sparkContext.accumulator(0)

    def count(x):
        seen.add(1)
        return x

    df = spark.range(60).select(F.col("id").cast("string").alias("OID"), F.udf(count, "double")((F.col("id") % 6 * 10).cast("double")).alias("a"), F.lit(1.0).alias("b"))
    got = L.kmeans(df, ("a", "b"), ("OID",), 3, restarts=4).collect()
    assert len(got) == 60 and len({(int(r["OID"]) % 6, r["cluster"]) for r in got}) == 6
    assert seen.value < 4 * 60  # once to count, and once or twice to assign


def test_acquisition_files_without_items(spark, tmp_path):
    from tessera.sources import files

    (tmp_path / "s1").mkdir()
    (tmp_path / "s1" / "x.json").write_text('{"resolution": 0.5, "wells": []}')
    assert files.read_acquisition_json(spark, str(tmp_path), pattern="*.json").count() == 0


def test_job_files_are_written_without_a_committer(spark, tmp_path, monkeypatch):
    from tessera import queries  # first: it imports the others
    from tessera import more_queries

    monkeypatch.setattr(more_queries, "new_path", lambda s, n: f"file://{tmp_path}/jobs")
    got = queries.QUERIES["src_jobfile_xml"](spark, "/root/testdata/sf0.001")
    assert got.count() == spark.read.parquet("/root/testdata/sf0.001/events.parquet").count()
    assert not (tmp_path / "jobs" / "_SUCCESS").exists() and len(list((tmp_path / "jobs").glob("u*.xml"))) > 1


def test_rounds_of_three_digits_are_named_as_in_the_sql(spark, tmp_path):
    import duckdb

    from tessera import queries

    spark.read.parquet("/root/testdata/sf0.001/events.parquet").withColumn("user_id", F.lit(1).cast("long")).limit(120).write.parquet(f"{tmp_path}/events.parquet")
    got = sorted(map(tuple, queries.QUERIES["fn_round_version_norm"](spark, str(tmp_path)).collect()))
    c = duckdb.connect()
    c.execute(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet/*.parquet'")
    assert len(got) > 100 and got == sorted(c.execute(queries.ORACLE_SQL["fn_round_version_norm"]).fetchall())


def test_labels_are_not_what_rows_are_dealt_by(spark):
    from tessera.operators import cells as C
    from tessera.operators import pixels as P
    from tessera.operators import summaries as S

    a = cut(spark.range(300).select(F.lit("s").alias("sample_id"), (F.col("id") % 200).cast("string").alias("OID"), F.when(F.col("id") < 200, "T").otherwise("B").alias("CellType")), "cells")
    chosen = cut(spark.createDataFrame([("B", 1)], "CellType string, include int"), "chosen")
    px = cut(spark.range(50).select(F.lit("AF").alias("image_id"), F.col("id").cast("int").alias("r"), F.lit(0).alias("c"), F.lit(1.0).alias("v")), "px")
    scores = px.groupBy("image_id").agg(F.lit(1.0).alias("score"))
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # tables too large for Spark to broadcast by itself
    try:
        plans = [_plan(x) for x in (S.conflicts(a), C.join_selected(a, chosen), P.layer_priority(px, scores))]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    assert all("SortMergeJoin" not in p for p in plans)
    assert S.conflicts(a).count() == 100 and C.join_selected(a, chosen).count() == 100


def test_cells_are_shuffled_once_for_their_labels(spark):
    from tessera.operators import summaries as S

    rows = [("s", "1", "a", "T_x"), ("s", "1", "b", "T_y"), ("s", "2", "a", "B_x"), ("s", "2", "b", "T_y")]
    a = cut(spark.createDataFrame(rows, "sample_id string, OID string, cl_method string, annotation string"), "annotated")
    assert _plan(S.consensus(a)).count("Exchange hashpartitioning(sample_id") == 1
    assert _plan(S.jaccard_table(a)).count("SortMergeJoin [sample_id") == 0
    assert [tuple(r) for r in S.consensus(a).collect()] == [("s", "1", "T", 2)]


def test_weak_signals_are_dealt_by_pixel_once(spark):
    from tessera import queries
    from tessera.operators import pixels

    px = spark.createDataFrame([(i, r, r % 7, float(v)) for r in range(60) for i, v in (("MS", r * 900), ("AF", r % 9 + 1)) if r % 5 or i == "MS"], "image_id string, r int, c int, v double")
    got = pixels.angles(queries._weak(lambda _: px))
    plan = _plan(got)
    assert "Join" not in plan and plan.count("Exchange hashpartitioning") == 1
    s = {r: r * 900 // 40 + 0.1414 + (9000 if (r * 7 + r % 7) % 29 == 0 else 0) for r in range(60)}
    want = {(r, r % 7, s[r], float(r % 9 + 1)) for r in range(60) if r % 5 and s[r] <= 20 * (r % 9 + 1)}
    assert {tuple(x)[:4] for x in got.collect()} == want and want

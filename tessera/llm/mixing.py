"""Mixing sources to target weights by capped water-filling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WEIGHTS = (3.0, 1.0, 2.0)
WORD = r"[^\x20\x09-\x0D]+"
HEX_DIGITS = 3


def count_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def water_fill(sizes: DataFrame, share: float = 1.5, max_epochs: float = 2.0, weights: tuple = WEIGHTS) -> DataFrame:
    """Add ``target`` to rows (source, source_size).

    Sources in code point order, null last, take ``weights`` in turn. ``share`` times all sizes is dealt
    out by weight; no source gets more than ``max_epochs`` times its size, and what it cannot take goes to the
    others by weight. With cap/weight rising, the capped sources come first, so one running sum finds the
    level at which the rest stand. Holds one row per source, whatever the corpus size.
    """
    turn = F.row_number().over(Window.orderBy(F.col("source").isNull(), F.col("source"))) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (turn % len(weights) + 1).cast("int"))
    cap = F.col("source_size") * max_epochs
    order = Window.orderBy("ratio", F.col("source").isNull(), "source")
    done = order.rowsBetween(Window.unboundedPreceding, -1)
    rest = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranked = sizes.withColumn("weight", weight).withColumn("cap", cap).withColumn("ratio", F.col("cap") / F.col("weight"))
    budget = F.sum("source_size").over(everything) * share
    levels = ranked.withColumn("level", (budget - F.coalesce(F.sum("cap").over(done), F.lit(0.0))) / F.sum("weight").over(rest))
    # The first source, in order of ratio, that the level leaves below its cap fixes the level of all after it.
    fixed = F.min(F.when(F.col("ratio") > F.col("level"), F.struct("ratio", F.col("source").isNull().alias("last"), "source", "level"))).over(everything)["level"]
    return (
        levels.withColumn("fixed", fixed)
        .withColumn("target", F.when(F.col("ratio") > F.col("fixed"), F.col("fixed") * F.col("weight")).otherwise(F.col("cap")))
        .select("source", "source_size", "target")
    )


def mix(
    docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", seed: str = "mix-1",
    share: float = 1.5, max_epochs: float = 2.0, weights: tuple = WEIGHTS, keep: tuple[str, ...] = (),
) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, whole, taken[, columns in ``keep``].

    A source's target is ``whole`` repetitions of all its documents and a fraction more. For the fraction
    documents stand in the order of a seeded digest of their id, and those before the target are taken once more;
    the one at the target in part (its first words). The order is found from the sizes in 4096 digest ranges per
    source, and only inside the range at the target from documents, so that a source with a third of all rows is
    never sorted in one task.

    Null texts count 0 words; a null source is a source of its own, after all others. Rows with null ids stand in the order
    of their texts' digests, rows with equal digests in that of their sizes; equal ones are interchangeable. An empty table gives no rows.
    """
    d = docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), count_words(F.col(text_col)).alias("size"),
        F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col(id_col).cast("string"), F.md5(F.col(text_col)), F.lit("")))).alias("digest"),
        *(F.col(c).alias(f"keep_{c}") for c in keep),
    ).withColumn("part", F.substring("digest", 1, HEX_DIGITS))
    parts = d.groupBy("source", "part").agg(F.sum("size").alias("part_size"))
    totals = parts.groupBy("source").agg(F.sum("part_size").alias("source_size"))
    targets = water_fill(totals, share, max_epochs, weights)
    ahead = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    plan = (
        parts.withColumn("ahead", F.coalesce(F.sum("part_size").over(ahead), F.lit(0)).cast("long"))
        .withColumnRenamed("source", "s").join(targets, F.col("s").eqNullSafe(F.col("source"))).drop("s")
        .withColumn("whole", whole)
        .withColumn("extra", F.round(F.col("target") - F.col("whole") * F.col("source_size")).cast("long"))
        .withColumnRenamed("source", "p_source").withColumnRenamed("part", "p_part")
    )
    d = d.join(plan, F.col("source").eqNullSafe(F.col("p_source")) & (F.col("part") == F.col("p_part")))
    inside = (F.col("ahead") < F.col("extra")) & (F.col("ahead") + F.col("part_size") > F.col("extra"))
    before = Window.partitionBy("p_source", "part").orderBy("digest", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    edge = d.where(inside).withColumn("before", F.col("ahead") + F.coalesce(F.sum("size").over(before), F.lit(0)))
    edge = edge.withColumn("once_more", F.greatest(F.lit(0), F.least(F.col("size"), F.col("extra") - F.col("before"))))
    clear = d.where(~inside).withColumn("before", F.col("ahead")).withColumn(
        "once_more", F.when(F.col("ahead") < F.col("extra"), F.col("size")).otherwise(F.lit(0)))
    return clear.unionByName(edge).select(
        "doc_id", "source", "size", F.col("source_size").cast("long").alias("source_size"), "target", "whole",
        (F.col("whole") * F.col("size") + F.col("once_more")).cast("long").alias("taken"),
        *(F.col(f"keep_{c}").alias(c) for c in keep),
    )


MIX_SQL = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS digest FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, [3.0::DOUBLE, 1.0, 2.0][((row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1)::INT] AS weight FROM s),
r AS (SELECT *, source_size * 2.0::DOUBLE AS cap, source_size * 2.0::DOUBLE / weight AS ratio FROM w),
l AS (SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE
        - coalesce(sum(cap) OVER (ORDER BY ratio, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
        / sum(weight) OVER (ORDER BY ratio, source IS NULL, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM r),
f AS (SELECT level FROM l WHERE ratio > level ORDER BY ratio, source IS NULL, source LIMIT 1),
t AS (SELECT source, source_size, CASE WHEN ratio > (SELECT level FROM f) THEN (SELECT level FROM f) * weight ELSE cap END AS target FROM l),
e AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole FROM t),
o AS (SELECT d.doc_id, d.size, e.source_size, e.target, e.whole,
        CAST(round(e.target - e.whole * e.source_size) AS BIGINT) AS extra,
        coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY digest, d.doc_id, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead
      FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, size, source_size, target,
       CAST(whole * size + greatest(0, least(size, extra - ahead)) AS BIGINT) AS taken FROM o
"""

"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import minhash, mixing, packing, pii, toxicity
from tessera.llm.queries import table, tokenizer_path
from tessera.plans.lineage import cut


def whole_rows(docs: DataFrame, *columns: str) -> DataFrame:
    """The named columns and ``row``, all columns as one, so that no name of an operator's meets one of the table's."""
    return docs.select(*columns, F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity scorer predicts as toxic go; null and empty texts, repeated rows and rows with a null id are each judged by their text."""
    scored = toxicity.score_toxicity(whole_rows(docs, "doc_id", "text"), table(spark, sf_dir, "labels"), keep=("row",))
    return scored.where("predicted = 0").select("row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, that of the smallest id: five-word shingles, similarity 0.8.

    Null and empty texts are near nothing and stay, as do rows with a null id. Of rows that repeat an id and a text one stays, the smallest by
    all other columns; where an id has several texts, the operator counts them as one document, and all of them stay or go with it.
    """
    found = cut(minhash.near_duplicates(docs, size=5, percent=80), "near")
    kept = docs.join(found.where("kept and doc_id is not null").select("doc_id").distinct(), "doc_id", "left_semi").select(*(F.col(f"`{c}`") for c in docs.columns))
    if not found.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").isEmpty():
        kept = whole_rows(kept, "doc_id", "text").groupBy("doc_id", "text").agg(F.min("row").alias("row")).select("row.*")
    return kept.unionByName(docs.where("doc_id is null"))


def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data becomes its kind in angle brackets, and n_chars, where there is one, follows the text. Null texts stay null; no row and no other column changes."""
    out = pii.redact(docs)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("long")))
    return out.select(*(F.col(f"`{c}`") for c in docs.columns))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat documents as the mix says; the one at a source's target is cut after the words that are taken.

    Null and empty texts have no words, so the mix takes none of them and they go, at whatever number of repeats. Repeated rows are mixed each.
    """
    mixed = mixing.mix(whole_rows(docs, "doc_id", "source", "text"), keep=("row", "text"))
    extra = F.col("taken") - F.col("whole") * F.col("size")
    part = F.when((extra > 0) & (extra < F.col("size")), F.array_join(
        F.slice(F.regexp_extract_all("text", F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), 0), F.lit(1), extra.cast("int")), ""))
    times = F.when(F.col("size") > 0, F.col("whole") + F.when(extra == F.col("size"), 1).otherwise(0)).otherwise(0).cast("int")
    copies = F.concat(F.array_repeat(F.col("text"), times), F.when(part.isNotNull(), F.array(part)).otherwise(F.array().cast("array<string>")))
    rows = mixed.select("row", F.explode(copies).alias("copy"))
    text = {"text": F.col("copy"), "n_chars": F.length("copy").cast("long")}
    return rows.select(*((text[c] if c in text else F.col("row")[c]).alias(c) for c in docs.columns))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of power-of-two lengths, with their ids; null and empty texts give the end token, repeated rows are packed each."""
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("pii", redact_pii),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Learned scores, tokenizers and MinHash have no SQL form; tests/llm compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

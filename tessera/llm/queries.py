"""Queries over whole tables, one per operator, and their SQL where there is one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import collision_search, conversations, licenses, minhash, mixing, near_vectors, packing, phrases, pii, suffix_arrays, suffix_tree, toxicity, warc
from tessera.plans.lineage import new_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors.near_vectors(table(spark, sf_dir, "embeddings"))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = pii.find_pii(table(spark, sf_dir, "documents").select("doc_id", "text"))
    count = lambda kind: F.size(F.filter("pii_spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("pii_spans", lambda s: s["kind"].isin(*pii.BASE_KINDS))
    return d.select("doc_id", *map(count, pii.BASE_KINDS), F.sha2(pii.render(base), 256).alias("base_sha256"), pii.render(F.col("pii_spans")).alias("spans"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(table(spark, sf_dir, "documents"), tokenizer_path(), with_ids=False)
    return packed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "bucket")


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "warc")
    warc.write_warc(warc.to_records(table(spark, sf_dir, "pages")), path)
    columns = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    return warc.read_warc(spark, path, columns, verify=True).where(F.col("record_type").isin("response", "revisit")).select(*columns)


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op6_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_tree.score(table(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def op9_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), size=4)


def op10_collision_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return collision_search.search(rows, rows.where("vec_id % 20 = 0"))


def op11_suffix_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_arrays.remove_repeats(table(spark, sf_dir, "documents"))


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.prefix_trie(table(spark, sf_dir, "conversations"))


QUERIES = {f.__name__: f for f in (op1_near_vectors, op2_pii, op3_packing, op4_warc, op5_mixing, op6_suffix_tree, op7_toxicity, op8_licenses, op9_minhash, op10_collision_search, op11_suffix_arrays, op12_phrases, op13_prefix_trie)}
ORACLE_SQL = {
    "op1_near_vectors": near_vectors.NEAR_VECTORS_SQL, "op9_minhash": minhash.NEAR_SQL,
    "op2_pii": pii.PII_SQL, "op4_warc": warc.WARC_SQL, "op5_mixing": mixing.MIX_SQL, "op8_licenses": licenses.LICENSE_SQL,
    "op11_suffix_arrays": suffix_arrays.REPEATS_SQL, "op12_phrases": phrases.PHRASES_SQL, "op13_prefix_trie": conversations.TRIE_SQL}

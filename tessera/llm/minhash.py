"""Near-duplicate documents: tensored MinHash banding, candidates verified on full shingle sets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.hashes import blocks, split
from tessera.operators.graph import connected_components
from tessera.plans.lineage import cut, discard

#: Two collections of 8 keys of 2 minima each make 64 tables from 32 minima. At similarity 0.8 a pair
#: meets in none of them with a probability of 2 * (1 - 0.8^2)^8 = 0.0006.
ROWS, KEYS = 2, 8
#: Bytes of text that are hashed together.
TOGETHER = 1 << 20
#: Sets in the sample that orders shingles by frequency (the order decides speed only), and shingles kept from it.
ORDER_SETS, ORDER_SHINGLES = 4096, 200_000
FILTER_BITS = 1 << 25

_ODD = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def shingles(texts, size: int) -> Iterator[np.ndarray]:
    """For each text (bytes) its sorted distinct 64-bit hashes of shingles of ``size`` words; a shorter text is one shingle.

    Hashes of words come from all bytes of a block at once; they lower-case A-Z only and split at exactly the white space that counts.
    """
    for block in blocks(texts, TOGETHER):
        *_, h, stand = split(block)
        acc = np.full(max(len(h) - size + 1, 0), size, np.uint64)
        for k in range(size):
            acc = _mix(acc * _ODD + h[k : k + len(acc)])
        for first, last in zip([0, *stand[:-1].tolist()], stand.tolist(), strict=True):
            n = last - first
            if n >= size:
                yield np.unique(acc[first : last - size + 1])
            elif n:
                one = np.full(1, n, np.uint64)
                for k in range(first, last):
                    one = _mix(one * _ODD + h[k : k + 1])
                yield one
            else:
                yield np.empty(0, np.uint64)


def _minima(seed: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    n = 2 * KEYS * ROWS
    return rng.integers(1, 2**63, n, dtype=np.uint64) | np.uint64(1), rng.integers(0, 2**63, n, dtype=np.uint64)


def sketch(docs: DataFrame, size: int, seed: int = 17) -> DataFrame:
    """Rows (doc_id, n, h1, h2, a, b) of (doc_id, text): set size, 128-bit digest of the set, both key collections."""
    schema = "doc_id long, n long, h1 long, h2 long, a array<long>, b array<long>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mul, add = _minima(seed)
        salt = np.arange(2 * KEYS, dtype=np.uint64) + np.uint64(1)
        for batch in batches:
            ns, digests, keys = [], [], []
            for s in shingles(batch.column(1).to_pylist(), size):
                ns.append(len(s))
                digests.append(np.frombuffer(xxhash.xxh3_128_digest(s.tobytes()), np.int64))
                if not len(s):
                    keys.append(np.zeros(2 * KEYS, np.int64))
                    continue
                low = np.full(len(mul), np.iinfo(np.uint64).max, np.uint64)
                for at in range(0, len(s), 8192):
                    low = np.minimum(low, (s[None, at : at + 8192] * mul[:, None] + add[:, None]).min(axis=1))
                low, key = low.reshape(2 * KEYS, ROWS), salt
                for k in range(ROWS):
                    key = _mix(key * _ODD + low[:, k])
                keys.append(key.view(np.int64))
            both, dig = np.array(keys, np.int64).reshape(len(ns), 2, KEYS), np.array(digests, np.int64).reshape(len(ns), 2)
            lists = [pa.array(list(np.ascontiguousarray(both[:, k])), pa.list_(pa.int64())) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(ns, pa.int64()), pa.array(dig[:, 0]), pa.array(dig[:, 1]), *lists],
                names=["doc_id", "n", "h1", "h2", "a", "b"])

    return docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(run, schema)


def shingle_sets(docs: DataFrame, met: DataFrame, size: int) -> DataFrame:
    """Rows (rep, n, s) of those of (doc_id, text) whose id is in ``met``: the whole shingle set.

    A bitmap of FILTER_BITS hashed ids, of one size for any input, lets the scan pass over nearly all other texts, so
    that texts are not shuffled; the join after it is exact.
    """
    bit = F.pmod(F.xxhash64("doc_id"), F.lit(FILTER_BITS))
    marks = met.select(bit.alias("bit")).groupBy(F.shiftright("bit", 6).alias("word"))
    marks = marks.agg(F.expr("bit_or(shiftleft(1L, cast(bit & 63 as int)))").alias("x")).toPandas()
    words = np.zeros(FILTER_BITS >> 6, np.int64)
    words[marks.word.to_numpy(np.int64)] = marks.x.to_numpy(np.int64)
    held = docs.sparkSession.sparkContext.broadcast(words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = held.value
        for batch in batches:
            at = batch.column(2).to_numpy(zero_copy_only=False)
            batch = batch.filter(pa.array((words[at >> 6] >> (at & 63)) & 1 == 1))
            sets = [s.view(np.int64) for s in shingles(batch.column(1).to_pylist(), size)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(sets, pa.list_(pa.int64()))], names=["rep", "n", "s"])

    d = docs.where("doc_id is not null").select("doc_id", F.col("text").cast("binary").alias("text"), bit.alias("bit"))
    return d.mapInArrow(run, "rep long, n long, s array<long>").join(met.select(F.col("doc_id").alias("rep")), "rep", "left_semi")


def verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose sets have 100 * intersection >= percent * union."""
    side = lambda x: sets.select(F.col("rep").alias(x), F.col("n").alias(f"n{x}"), F.col("s").alias(f"s{x}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").withColumn("i", F.size(F.array_intersect("sa", "sb")))
    return both.where(F.col("i") * 100 >= percent * (F.col("na") + F.col("nb") - F.col("i"))).select("a", "b")


def rare_prefixes(sets: DataFrame, percent: int) -> DataFrame:
    """Rows (shingle, rep, comp, n, position) of each set's rarest shingles.

    Two sets with the similarity share one of their n - ceil(percent * n / 100) + 1 first shingles, in any order
    common to all sets. Frequency in a sample puts passages that many documents share at the end of it.
    """
    every = max(1, sets.count() // ORDER_SETS)
    sample = sets.where(F.pmod(F.xxhash64("rep"), F.lit(every)) == 0).select(F.explode("s").alias("x")).groupBy("x").count()
    often = sample.where("count > 1").orderBy(F.desc("count"), "x").limit(ORDER_SHINGLES).orderBy("x").collect()
    common, counts = np.array([r[0] for r in often], np.int64), np.array([r[1] for r in often] + [0], np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in range(5)]
            for rep, comp, n, s in zip(*(c.to_pylist() if k < 3 else c for k, c in enumerate(batch.columns)), strict=True):
                s = s.values.to_numpy()
                at = np.searchsorted(common, s)
                known = at < len(common)
                known[known] = common[at[known]] == s[known]
                first = s[np.lexsort((s, np.where(known, counts[at], 0)))][: n - -(-percent * n // 100) + 1]
                for column, value in zip(out, (first, np.full(len(first), rep), np.full(len(first), comp), np.full(len(first), n), np.arange(len(first))), strict=True):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c).astype(np.int64)) for c in out], names=names)

    names = ["shingle", "rep", "comp", "n", "position"]
    return sets.select("rep", "comp", "n", "s").mapInArrow(run, ", ".join(f"{x} long" for x in names))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, percent: int = 80) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    1. Documents with equal sets are one class, that of the smallest id.
    2. Each class enters a table per pair of keys (one of either collection). A table entry links its members to the
       smallest one, never to each other, and each such pair is verified once.
    3. What the verified links leave apart within a table entry is settled exactly: of the sets that met any other,
       those in different components that share one of their rarest shingles (prefix, length and positional filters
       of a set join) are verified, too. So no link between sets that met in a table is lost, at a cost that follows the
       true candidates and not the square of an entry.
    4. Components of all links; the smallest id names a component, and the document of that id is kept.

    Null and empty texts have no shingles and stand alone, as do rows with a null id (component null, kept). A text of fewer
    words than ``size`` is one shingle. Rows that share an id count as one document: they are linked. Extra columns are
    not read. An empty table gives no rows.
    """
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    known = cut(sketch(d, size), "sketch")
    classes = known.where("n > 0 and doc_id is not null").groupBy("h1", "h2").agg(
        F.min("doc_id").alias("rep"), F.first("a").alias("a"), F.first("b").alias("b"))
    tables = F.flatten(F.transform("a", lambda x: F.transform("b", lambda y: F.xxhash64(x, y))))
    keys = classes.select("rep", F.explode(tables).alias("key"))
    entries = keys.groupBy("key").agg(F.min("rep").alias("a"), F.max("rep").alias("last")).where("a < last").drop("last")
    star = cut(keys.join(entries, "key").where("rep > a").select("a", F.col("rep").alias("b")).distinct(), "star")

    met = star.select(F.col("a").alias("doc_id")).union(star.select("b")).distinct()
    sets = cut(shingle_sets(d, met, size), "sets")
    first = cut(connected_components(verify(star, sets, percent)), "components")
    placed = sets.join(first, F.col("rep") == F.col("node"), "left").withColumn("comp", F.coalesce("component", "rep"))
    prefixes = cut(rare_prefixes(placed.select("rep", "comp", "n", "s"), percent), "prefixes")
    apart = prefixes.groupBy("shingle").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).where("x < y").select("shingle")
    p = prefixes.join(apart, "shingle", "left_semi")
    side = lambda x: p.select("shingle", *(F.col(c).alias(f"{c}_{x}") for c in ("rep", "comp", "n", "position")))
    rest = "least(n_a - position_a, n_b - position_b)"
    pairs = side("a").join(side("b"), "shingle").where(
        f"rep_a < rep_b and comp_a <> comp_b and least(n_a, n_b) * 100 >= {percent} * greatest(n_a, n_b)"
        f" and {rest} * {100 + percent} >= {percent} * (n_a + n_b)")
    pairs = pairs.select("rep_a", "rep_b").distinct().toDF("a", "b")
    more = verify(pairs, sets, percent)
    comp = lambda x: first.select(F.col("node").alias(x), F.col("component").alias(f"c{x}"))
    joined = more.join(comp("a"), "a", "left").join(comp("b"), "b", "left")
    second = connected_components(joined.select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b")))
    discard(star, sets, prefixes)

    named = classes.select("h1", "h2", "rep").join(first, F.col("rep") == F.col("node"), "left").select(
        "h1", "h2", F.coalesce("component", "rep").alias("one"))
    named = named.join(second, F.col("one") == F.col("node"), "left").select("h1", "h2", F.coalesce("component", "one").alias("c"))
    out = known.select("doc_id", "n", "h1", "h2").join(named, ["h1", "h2"], "left")
    c = F.when(F.col("n") > 0, F.col("c")).otherwise(F.col("doc_id"))
    out = out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), c).alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


NEAR_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
  ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i : i + 3], ' ')) END) AS s FROM d),
n AS (SELECT doc_id, CAST(len(s) AS BIGINT) AS n FROM s),
x AS (SELECT doc_id, hash(unnest(s)) AS h FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM x a JOIN x b ON a.h = b.h AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * i >= 80 * (na.n + nb.n - i)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
c(u, v) AS (SELECT doc_id, doc_id FROM n UNION SELECT c.u, e.b FROM c JOIN e ON c.v = e.a)
SELECT u AS doc_id, n AS n_shingles, min(v) AS component_id, u = min(v) AS kept FROM c JOIN n ON n.doc_id = u GROUP BY u, n
"""

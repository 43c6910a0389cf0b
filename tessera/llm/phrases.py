"""Collocations: phrases of two and three words, mined from a sample and its negative border (Toivonen)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.hashes import LETTERS, blocks, byte_set, mix, split
from tessera.plans.lineage import collect, cut, discard

#: One document in so many is sampled, and a phrase seen so often in the sample is proposed. Both decide speed only.
SAMPLE, PROPOSED = 8, 2
#: The pass over all texts counts keys in so many parts, one after the other, so that the sums of a task and the shuffle hold a part of them.
PARTS = 2
#: Bytes of text that are counted together.
TOGETHER = 1 << 21
#: Bits of the maps of proposed and frequent words and pairs, of one size for any input. What a full map lets through is counted in vain, exactly.
MAP_BITS = 26

#: Parts of a language's candidates that are ranked by themselves before the best of each meet.
DEALS = 64

#: What ends a piece, and what ends a word within it.
ENDS_PIECE, SPACES = b".,;:!?\n\x0b\x0c\r", b" \t"
_ENDS, _CUT = byte_set(ENDS_PIECE), byte_set(ENDS_PIECE + SPACES)
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_ODD = np.uint64(0x9E3779B97F4A7C15)

_ROWS = "a long, b long, c long, word string, n long"


class _Block:
    """Words of a block of texts: keys (by language), which follow their predecessor in one piece, and keys of pairs."""

    def __init__(self, langs: list[str], texts: list[bytes], seed: int):
        self.langs = langs
        self.data, self.starts, self.ends, h, stand = split([t.translate(_LOWER) for t in texts], _CUT, LETTERS)
        self.text = np.repeat(np.arange(len(texts)), np.diff(stand, prepend=0))
        codes = {x: np.frombuffer(_digest(x, seed), np.uint64)[0] for x in set(langs)}
        self.key = mix(h ^ np.array([codes[x] for x in langs], np.uint64)[self.text]) | np.uint64(1)
        ends = np.cumsum(_ENDS[np.frombuffer(self.data, np.uint8)], dtype=np.int32)
        self.follows = ends[self.starts[1:]] == ends[self.ends[:-1] - 1]
        self.pair = mix(self.key[:-1] * _ODD + self.key[1:])

    def words(self, some: np.ndarray) -> tuple[list, ...]:
        at = np.flatnonzero(some)
        keys, place, n = np.unique(self.key[at], return_index=True, return_counts=True)
        place = at[place]
        first = zip(self.text[place].tolist(), self.starts[place].tolist(), self.ends[place].tolist(), strict=True)
        return keys, [f"{self.langs[t]}\0{self.data[a:b].decode()}" for t, a, b in first], n

    def enabled(self, maps: tuple) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of words that are both in a pass's map, and triples whose pairs are both in its other map, too."""
        words, pairs = maps
        some = _is_set(words, self.key)
        both = self.follows & some[:-1] & some[1:]
        near = both & _is_set(pairs, self.pair) if pairs is not None else np.zeros(len(both), bool)
        return both, near[:-1] & near[1:]


def _digest(x: str, seed: int) -> bytes:
    import hashlib

    return hashlib.blake2b(x.encode(), digest_size=8, key=str(seed).encode()).digest()


def _is_set(bits: np.ndarray | None, key: np.ndarray) -> np.ndarray:
    if bits is None:
        return np.ones(len(key), bool)
    at = key & np.uint64((1 << MAP_BITS) - 1)
    return (bits[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) == 1


def _summed(keys: list[np.ndarray], by: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct tuples of keys and their counts. ``by`` brings equal ones together; if it mixes others in between, a tuple has several rows."""
    order = np.argsort(by)
    keys = [k[order] for k in keys]
    edge = np.ones(len(order) + 1, bool)
    edge[1:-1] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
    at = np.flatnonzero(edge)
    return *(k[at[:-1]] for k in keys), np.diff(at)


def _counts(held, first: bool, seed: int, part: int = 0, parts: int = 1):
    """Of each block: words (in the first pass), and the pairs and triples that this pass's maps enable and no earlier ones did; of all keys one of ``parts``."""

    def rows(kind: int, keys: tuple, n: np.ndarray, words=None) -> pa.RecordBatch:
        columns = [pa.array(k.view(np.int64)) for k in keys] + [pa.array(np.zeros(len(n), np.int64))] * (3 - kind)
        return pa.RecordBatch.from_arrays([*columns, pa.array(words if words else [None] * len(n), pa.string()), pa.array(n.astype(np.int64))], names=names)

    names = [x.split()[0] for x in _ROWS.split(", ")]
    mine = lambda key: (key >> np.uint64(32)) % np.uint64(parts) == part if parts > 1 else np.ones(len(key), bool)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, before = held.value
        for batch in batches:
            langs, at = batch.column(0).to_pylist(), 0
            for texts in blocks((t.as_py() for t in batch.column(1)), TOGETHER):
                b = _Block(langs[at : at + len(texts)], texts, seed)
                at += len(texts)
                if first and len(b.key):
                    keys, words, n = b.words(mine(b.key))
                    yield rows(1, (keys,), n, words)
                if len(b.key) < 2:
                    continue
                two, three = b.enabled(now)
                for maps in before:
                    old_two, old_three = b.enabled(maps)
                    two, three = two & ~old_two, three & ~old_three
                i = np.flatnonzero(two & mine(b.pair))
                if len(i):
                    *keys, n = _summed([b.key[i], b.key[i + 1]], b.pair[i])
                    yield rows(2, keys, n)
                i = np.flatnonzero(three)
                if parts > 1:
                    i = i[mine(b.pair[i] * _ODD + b.key[i + 2])]
                if len(i):
                    *keys, n = _summed([b.key[i], b.key[i + 1], b.key[i + 2]], b.pair[i] * _ODD + b.key[i + 2])
                    yield rows(3, keys, n)

    return run


def _bits(keys: DataFrame) -> np.ndarray:
    """The map with a bit set for each (key)."""
    bit = keys.select(F.col("key").bitwiseAND((1 << MAP_BITS) - 1).alias("bit"))
    rows = bit.groupBy(F.shiftright("bit", 6).alias("i")).agg(F.expr("bit_or(shiftleft(1L, cast(bit & 63 AS int)))").alias("x")).toArrow()
    out = np.zeros(1 << (MAP_BITS - 6), np.uint64)
    out[rows.column("i").to_numpy()] = rows.column("x").to_numpy().view(np.uint64)
    return out


def _pair_keys(pairs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (batch.column(k).to_numpy().view(np.uint64) for k in (0, 1))
            yield pa.RecordBatch.from_arrays([pa.array(mix(a * _ODD + b).view(np.int64))], names=["key"])

    return pairs.select("a", "b").mapInArrow(run, "key long")


def _maps(table: DataFrame, least: int) -> tuple[np.ndarray, np.ndarray]:
    often = table.where(F.col("n") >= least)
    return _bits(often.where("b = 0").select(F.col("a").alias("key"))), _bits(_pair_keys(often.where("b <> 0 and c = 0")))


def mine(docs: DataFrame, least: int = 10, sample: int = SAMPLE, seed: int = 1) -> DataFrame:
    """Rows (a, b, c, word, n) of (doc_id, lang, text): all words, and all phrases of two and three words with n >= ``least``.

    a, b, c are keys of words (0: none), word is ``lang\\0text`` for words and null for phrases.

    1. A sample proposes words and pairs. Its negative border is what it does not propose though all parts are proposed.
    2. A pass over all texts (once for each of ``PARTS`` of the keys) counts exactly: all words (proposed or, as nothing stands below them, border), pairs of two
       proposed words and triples of two proposed pairs, which are proposed or border as well.
    3. Where words or pairs of the border turn out frequent, a further pass counts what these make possible and no
       earlier pass has counted; passes go on until none is found.

    Counts are exact whatever the sample. Two words with one key would be an error, which is looked for and raised; another ``seed`` mends it.
    """
    d = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"), F.xxhash64("doc_id").alias("_h"))
    context = docs.sparkSession.sparkContext

    def counted(of: DataFrame, now: tuple, before: list, first: bool, part: int = 0, parts: int = 1) -> DataFrame:
        held = context.broadcast((now, before))
        return of.select("lang", "text").mapInArrow(_counts(held, first, seed, part, parts), _ROWS).groupBy("a", "b", "c", "word").agg(F.sum("n").alias("n"))

    proposed = cut(counted(d.where(F.pmod("_h", F.lit(sample)) == 0), (None, None), [], True).where(F.col("n") >= PROPOSED), "proposed")
    now, before = _maps(proposed, PROPOSED), []
    discard(proposed)
    kept = F.col("word").isNotNull() | (F.col("n") >= least)
    found = cut(counted(d, now, before, True, 0, PARTS).where(kept), "counted")
    for part in range(1, PARTS):
        collect(docs.sparkSession)
        found = found.unionByName(cut(counted(d, now, before, True, part, PARTS).where(kept), "counted"))
    twice = found.where("b = 0").groupBy("a").count().where("count > 1")
    if not twice.isEmpty():
        raise ValueError("two words have the same key: take another seed")
    out = found
    while True:
        before = [*before, now]
        words, pairs = _maps(out, least)
        if not ((words & ~_any(m[0] for m in before)).any() or (pairs & ~_any(m[1] for m in before)).any()):
            return out
        now = words, pairs
        out = out.unionByName(cut(counted(d, now, before, False).where(F.col("n") >= least), "counted"))


def _any(maps) -> np.ndarray:
    maps = list(maps)
    out = maps[0].copy()
    for m in maps[1:]:
        out |= m
    return out


def collocations(docs: DataFrame, least: int = 10, top: int = 2000, part: int = 50, sample: int = SAMPLE, seed: int = 1) -> DataFrame:
    """The ``top`` phrases of each language of (doc_id, lang, text): lang, rank, phrase, a, l, r, n, score.

    a is the phrase's count, n all words of the language, l and r the counts of its two parts at the cut with the lowest score
    floor(1000000 * a * a / (l * r)), of equal ones the first cut. Phrases inside a longer candidate that makes up ``part`` percent of
    them are dropped. Ties in score and count go to the phrase first in UTF-8 order.

    Null texts are empty; a null lang is ``und``, as is one of that name. Repeated rows and rows without an id count like others; very long
    texts are counted whole. Extra columns are not read. An empty table, or one without a phrase of ``least``, gives no rows.
    """
    table = cut(mine(docs, least, sample, seed), "phrases")
    word = table.where("b = 0").select("a", F.substring_index("word", "\0", 1).alias("lang"), F.expr("substring(word, instr(word, '\\0') + 1)").alias("text"), "n")
    total = word.groupBy("lang").agg(F.sum("n").alias("n_words"))
    often = word.where(F.col("n") >= least)
    one = lambda x: often.select(F.col("a").alias(x), F.col("text").alias(f"t_{x}"), F.col("n").alias(f"n_{x}"), *([F.col("lang")] if x == "a" else []))
    two = table.where("b <> 0 and c = 0").select("a", "b", "n")
    three = table.where("c <> 0").select("a", "b", "c", "n")
    inside = three.select("a", "b", "n").union(three.select("b", "c", "n")).groupBy("a", "b").agg(F.max("n").alias("longer"))
    pairs = two.join(inside, ["a", "b"], "left").where(f"longer is null or 100 * longer < {part} * n").drop("longer").join(one("a"), "a").join(one("b"), "b")

    def score(n: str, left: str, right: str) -> F.Column:
        wide = lambda c: f"cast({c} AS decimal(19, 0))"
        return F.expr(f"cast((cast(1000000 AS decimal(7, 0)) * cast({n} AS decimal(15, 0)) * cast({n} AS decimal(15, 0))) div ({wide(left)} * {wide(right)}) AS bigint)")

    pairs = pairs.select("lang", F.concat_ws(" ", "t_a", "t_b").alias("phrase"), "n", F.col("n_a").alias("l"), F.col("n_b").alias("r"), score("n", "n_a", "n_b").alias("score"))
    triples = three.join(two.select("a", "b", F.col("n").alias("n_ab")), ["a", "b"]).join(two.select(F.col("a").alias("b"), F.col("b").alias("c"), F.col("n").alias("n_bc")), ["b", "c"])
    triples = triples.join(one("a"), "a").join(one("b"), "b").join(one("c"), "c").withColumns({"s1": score("n", "n_a", "n_bc"), "s2": score("n", "n_ab", "n_c")})
    first = F.col("s1") <= F.col("s2")
    pick = lambda x, y: F.when(first, F.col(x)).otherwise(F.col(y))
    triples = triples.select("lang", F.concat_ws(" ", "t_a", "t_b", "t_c").alias("phrase"), "n", pick("n_a", "n_ab").alias("l"), pick("n_bc", "n_c").alias("r"), pick("s1", "s2").alias("score"))
    place = lambda *by: F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("score"), F.desc("n"), "phrase"))
    every = pairs.unionByName(triples).withColumn("deal", F.pmod(F.xxhash64("phrase"), F.lit(DEALS)))
    dealt = every.withColumn("rank", place("lang", "deal")).where(F.col("rank") <= top)  # what is further down among so many cannot be among the first of all
    best = dealt.withColumn("rank", place("lang")).where(F.col("rank") <= top)  # of a language DEALS * top at most
    return best.join(total, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", F.col("n").alias("a"), "l", "r", F.col("n_words").alias("n"), "score")


PHRASES_SQL = r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
g AS (SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: w[i : i + k - 1])) AS g FROM w, (VALUES (1), (2), (3)) v(k) WHERE len(w) >= k),
f AS (SELECT lang, k, g, count(*) AS a FROM g GROUP BY ALL),
n AS (SELECT lang, sum(a) AS n FROM f WHERE k = 1 GROUP BY 1),
c AS (SELECT lang, k, g, a, unnest(range(1, k)) AS cut FROM f WHERE k > 1 AND a >= 10),
s AS (SELECT c.*, l.a AS l, r.a AS r, CAST((CAST(1000000 AS HUGEINT) * c.a * c.a) // (CAST(l.a AS HUGEINT) * r.a) AS BIGINT) AS score FROM c
  JOIN f l ON l.lang = c.lang AND l.g = c.g[1 : cut] JOIN f r ON r.lang = c.lang AND r.g = c.g[cut + 1 : c.k]),
b AS (SELECT lang, k, g, a, l, r, score FROM (SELECT *, row_number() OVER (PARTITION BY lang, g ORDER BY score, cut) AS o FROM s) WHERE o = 1),
u AS (SELECT lang, g[1:2] AS g, a FROM b WHERE k = 3 UNION ALL SELECT lang, g[2:3], a FROM b WHERE k = 3),
m AS (SELECT lang, g, max(a) AS longer FROM u GROUP BY 1, 2),
o AS (SELECT b.lang, array_to_string(b.g, ' ') AS phrase, b.a, l, r, score FROM b LEFT JOIN m ON m.lang = b.lang AND m.g = b.g WHERE longer IS NULL OR 100 * longer < 50 * b.a),
k AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM o)
SELECT lang, rank, phrase, a, l, r, CAST(n.n AS BIGINT) AS n, score FROM k JOIN n USING (lang) WHERE rank <= 2000
"""

"""Language-model scoring with a probabilistic suffix tree over words.

A state is a context of up to ``DEPTH`` words. It is kept when the next words seen often enough after it diverge enough
from what its suffix predicts; its distribution is smoothed towards the suffix's; a word is scored by the longest kept
states of what precedes it. The root is the unigram distribution. Words, states and entries are tables that grow with the
corpus, by absolute evidence; tasks hold the most frequent ones only to spare the join their rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.hashes import mix, split
from tessera.plans.lineage import cut, discard

#: Most words, and most states and entries, that tasks hold. Both save shuffles and do not enter the result.
CACHE_WORDS, CACHE = 1 << 21, 3 << 20
#: Bits of the maps by which tasks pass over keys that no table has.
BITS = 26
#: How often an entry and a state must have been seen.
LEAST_COUNT, LEAST_STATE = 4, 16
#: Nats of likelihood that an entry must gain over the suffix, and a state for each of its entries: about what it takes to
#: write an entry down (half the logarithm of 10^9 tokens), so that what chance brings together is no entry.
DIVERGENCE = 10.0
#: Weight of the suffix's distribution, in tokens.
SMOOTHING = 20.0
#: Most words of a context. Levels end earlier where no state diverges.
DEPTH = 3
#: Text bytes read at a time, tokens counted at a time, and tokens behind a bucket of counts.
BLOCK, FLUSH, BUCKET = 1 << 23, 1 << 21, 1 << 20
#: A context seen so often has its counts dealt out by what follows it.
HOT = 1 << 18

END = np.uint64(1)  # the end of a text as a word
STATE = np.uint64(0x5851F42D4C957F2D)  # told apart from a gram's key
_ODD = np.uint64(0x9E3779B97F4A7C15)


def held_out(id_: Column) -> Column:
    return F.coalesce(F.crc32(id_.cast("string").cast("binary")) % 5 == 1, F.lit(False))


def pair(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """64 bits that stand for two grams that overlap in all but their ends, or for two words."""
    return mix(x * _ODD + y)


def tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of texts, an END after each text's, and where each text ends."""
    *_, h, words = split(texts)
    return np.insert(h, words, END), words + np.arange(1, len(texts) + 1)


def blocks(batches: Iterator[pa.RecordBatch], column: int = 0) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of batches of about BLOCK bytes of text with their tokens; a longer text is a slice of its own."""
    for batch in batches:
        texts = [t or b"" for t in batch.column(column).to_pylist()]
        size, first = 0, 0
        for k, t in enumerate(texts):
            size += len(t) + 1
            if size >= BLOCK or k == len(texts) - 1:
                yield batch.slice(first, k + 1 - first), *tokens(texts[first : k + 1])
                size, first = 0, k + 1


def flushes(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    parts, n = [], 0
    for _, h, _ in blocks(batches):
        parts.append(h)
        n += len(h)
        if n >= FLUSH:
            yield np.concatenate(parts)
            parts, n = [], 0
    if parts:
        yield np.concatenate(parts)


def longs(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def word_counts(docs: DataFrame) -> DataFrame:
    """Rows (key, n) of all words of (text binary), summed per task before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for h in flushes(batches):
            h, n = np.unique(h, return_counts=True)
            yield pa.RecordBatch.from_arrays([longs(h), pa.array(n.astype(np.int64))], names=["key", "n"])

    return docs.select("text").mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


def bit_map(keys: DataFrame) -> np.ndarray:
    """2^BITS bits, set at the low bits of each (key)."""
    low = keys.select(F.col("key").bitwiseAND(F.lit((1 << BITS) - 1)).alias("k"))
    rows = low.groupBy(F.shiftright("k", 6).alias("i")).agg(F.bit_or(F.expr("shiftleft(1L, cast(k & 63 AS int))")).alias("x")).toArrow()
    out = np.zeros(1 << (BITS - 6), np.uint64)
    out[rows.column("i").to_numpy()] = rows.column("x").to_numpy().view(np.uint64)
    return out


def in_map(bits: np.ndarray, key: np.ndarray) -> np.ndarray:
    at = key & np.uint64((1 << BITS) - 1)
    return (bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1


def find(keys: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of x in sorted keys, and whether they are there."""
    if not len(keys):
        return np.zeros(len(x), int), np.zeros(len(x), bool)
    at = np.minimum(np.searchsorted(keys, x), len(keys) - 1)
    return at, keys[at] == x


def grams(h: np.ndarray, depth: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each level: contexts of that many words, the grams one place on, and the places whose context crosses no end."""
    g, good = h, h != END
    for d in range(1, depth + 1):
        if len(g) < 2:
            return
        yield g[:-1], g[1:], np.flatnonzero(good[: len(g) - 1])
        g, good = pair(g[:-1], g[1:]), good[: len(g) - 1] & (h[d : d + len(g) - 1] != END)


def gram_counts(docs: DataFrame, level: int, maps: tuple[np.ndarray, np.ndarray], hot: tuple[np.ndarray, np.ndarray], buckets: int) -> DataFrame:
    """Rows (ctx, suf, key, n, total): runs of ``level`` + 1 words seen LEAST_COUNT times, over all of (text binary).

    ``ctx`` stands for all words but the last, ``suf`` for all but the first, ``key`` for the run, ``total`` counts the
    context. Tasks send sorted distinct runs by ranges of the context's hash, contexts once each; a bucket gets about
    BUCKET tokens' runs. The runs of ``hot`` contexts (keys, counts) are dealt out by what follows. Only contexts and
    what follows them that the ``maps`` hold can be frequent enough; other followers are counted together.
    """
    held = docs.sparkSession.sparkContext.broadcast((maps, hot))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (state_map, entry_map), (hot_keys, _) = held.value
        for h in flushes(batches):
            for d, (ctx, suf, at) in enumerate(grams(h, level), 1):
                if d == level:
                    at = at[in_map(state_map, ctx[at])]
                    ctx, suf = ctx[at], suf[at]
                    del at
                    suf[~in_map(entry_map, suf)] = 0
                    u, i = np.unique(ctx, return_inverse=True)
                    del ctx
                    v, j = np.unique(suf, return_inverse=True)
                    del suf
                    i *= len(v)
                    i += j
                    del j
                    code, n = np.unique(i, return_counts=True)
                    del i
                    yield rows(u[code // max(len(v), 1)], v[code % max(len(v), 1)], n, hot_keys)

    def rows(ctx: np.ndarray, suf: np.ndarray, n: np.ndarray, hot_keys: np.ndarray) -> pa.RecordBatch:
        by = np.where(find(hot_keys, ctx)[1], mix(suf), ctx)
        bucket = ((by >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        ctx, suf, n, bucket = ctx[order], suf[order], n[order], bucket[order]
        new = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1]))) if len(bucket) else np.zeros(0, int)
        first = np.flatnonzero(np.concatenate(([True], (ctx[1:] != ctx[:-1]) | (bucket[1:] != bucket[:-1])))) if len(bucket) else np.zeros(0, int)
        outer = np.append(new, len(bucket)).astype(np.int32)
        inner = np.searchsorted(first, outer).astype(np.int32)
        lists = lambda off, x, kind: pa.ListArray.from_arrays(pa.array(off), pa.array(x, kind))
        return pa.RecordBatch.from_arrays([
            pa.array(bucket[new]), lists(inner, ctx[first].view(np.int64), pa.int64()),
            lists(inner, np.diff(np.append(first, len(bucket))).astype(np.int32), pa.int32()),
            lists(outer, suf.view(np.int64), pa.int64()), lists(outer, n.astype(np.int32), pa.int32())],
            names=["bucket", "ctx", "times", "suf", "n"])

    def merge(group: pa.Table) -> pa.Table:
        flat = lambda c: group.column(c).combine_chunks().flatten().to_numpy(zero_copy_only=False)
        hot_keys, hot_n = held.value[1]
        ctx = np.repeat(flat("ctx").view(np.uint64), flat("times"))
        u, i = np.unique(ctx, return_inverse=True)
        v, j = np.unique(flat("suf").view(np.uint64), return_inverse=True)
        n = flat("n").astype(np.int64)
        total = np.bincount(i, n, len(u)).astype(np.int64)
        at, is_hot = find(hot_keys, u)
        total[is_hot] = hot_n[at[is_hot]]
        code = i * len(v) + j
        order = np.argsort(code)
        code, n = code[order], n[order]
        first = np.flatnonzero(np.concatenate(([True], code[1:] != code[:-1])))
        code, n = code[first], np.add.reduceat(n, first)
        i, j = code // len(v), code % len(v)
        keep = (n >= LEAST_COUNT) & (v[j] != 0) & (total[i] >= LEAST_STATE)
        i, j = i[keep], j[keep]
        return pa.table({"ctx": longs(u[i]), "suf": longs(v[j]), "key": longs(pair(u[i], v[j])), "n": n[keep], "total": total[i]})

    out = docs.select("text").mapInArrow(run, "bucket long, ctx array<long>, times array<int>, suf array<long>, n array<int>")
    return out.groupBy("bucket").applyInArrow(merge, "ctx long, suf long, key long, n long, total long")


def grow(entries: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of (ctx, key, n, total, parent): the kept states (ctx, total, other), and the entries with log_new where they diverge.

    ``parent``: log10 of what the suffix gives; ``other``: log10 of the factor for words without an entry of their own.
    """
    q = F.pow(F.lit(10.0), F.col("parent"))
    e = entries.withColumn("q", q).withColumn("p", (F.col("n") + SMOOTHING * F.col("q")) / (F.col("total") + SMOOTHING))
    e = e.withColumn("gain", F.col("n") * F.log(F.col("p") / F.col("q")))
    s = e.where(F.col("gain") >= DIVERGENCE).groupBy("ctx").agg(
        F.max("total").alias("total"), F.count("*").alias("entries"), F.sum("n").alias("n"), F.sum("q").alias("q"), F.sum("gain").alias("gain"))
    rest_n = F.greatest(F.col("total") - F.col("n"), F.lit(0))
    s = s.withColumn("rest", (rest_n / F.greatest(1 - F.col("q"), F.lit(1e-9)) + SMOOTHING) / (F.col("total") + SMOOTHING))
    s = s.where(F.col("gain") + rest_n * F.log("rest") >= DIVERGENCE * (F.col("entries") + 1))
    new = e.withColumn("log_new", F.when(F.col("gain") >= DIVERGENCE, F.log10("p"))).select("ctx", "key", "n", "parent", "log_new")
    return s.select("ctx", "total", F.log10("rest").alias("other")), new


def most_frequent(table: DataFrame, most: int) -> int:
    """The least count of which no more than ``most`` rows (n) have that much or more."""
    step = F.when(F.col("n") < 1024, F.col("n")).otherwise(F.pow(F.lit(2.0), F.floor(F.log2("n"))).cast("long"))
    sizes = {r["s"]: r["k"] for r in table.groupBy(step.alias("s")).agg(F.count("*").alias("k")).collect()}
    least, fit = 1 << 62, 0
    for s in sorted(sizes, reverse=True):
        fit += sizes[s]
        if fit > most:
            break
        least = s
    return least


def sorted_columns(rows: pa.Table, *columns: str) -> list[np.ndarray]:
    key = rows.column("key").to_numpy().view(np.uint64)
    order = np.argsort(key)
    return [key[order], *(rows.column(c).to_numpy()[order] for c in columns)]


@dataclass
class Tree:
    """What tasks hold: frequent words, the values of frequent states and entries, and maps of the keys of the others.

    The gain at a word is the sum of its contexts' values and of its entries' values, each 0 where there is none: a
    state's value is what a word without an entry gets, an entry's is what it gets more than that (log10, to the suffix).
    """

    words: np.ndarray  # sorted hashes
    counts: np.ndarray
    n: int
    v: int
    keys: np.ndarray
    values: np.ndarray
    maps: tuple[np.ndarray | None, np.ndarray | None, np.ndarray | None]  # other words, those seen twice, other keys
    levels: int
    table: DataFrame | None = None  # (key, value, word) of all that is not held

    held: np.ndarray | None = None  # map of ``keys``

    def __getstate__(self) -> dict:
        return self.__dict__ | {"table": None}

    def __post_init__(self) -> None:
        self.held = np.zeros(1 << (BITS - 6), np.uint64)
        at = self.keys & np.uint64((1 << BITS) - 1)
        np.bitwise_or.at(self.held, (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63)))

    def log_p(self, c: np.ndarray | float) -> np.ndarray | float:
        return np.log10((c + 0.5) / (self.n + 0.5 * (self.v + 1)))

    def base(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For words in order: their counts, and whether they are in the join table at all, and with a count above one."""
        at, hit = find(self.words, h)
        c = np.where(hit, self.counts[at] if len(self.words) else 0, 0)
        some = [~hit & in_map(m, h) if m is not None else np.zeros(len(h), bool) for m in self.maps[:2]]
        return c, *some

    def look_up(self, key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places in ``key`` of held keys and their values, and places of those to join."""
        may = np.flatnonzero(in_map(self.held, key))
        at, hit = find(self.keys, key[may])
        join = np.flatnonzero(in_map(self.maps[2], key)) if self.maps[2] is not None else np.zeros(0, int)
        hits, at = may[hit], at[hit]
        return hits, self.values[at], np.setdiff1d(join, hits, assume_unique=True)

    def gains(self, h: np.ndarray, u: np.ndarray, i: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Of all contexts' states and entries: places and values of those held, places and keys of those to join.

        ``u``, ``i``: the distinct words and where each token stands among them.
        """
        for level, (ctx, suf, at) in enumerate(grams(h, self.levels), 1):
            if level == 1:  # each distinct word once
                hits, found, more = self.look_up(u ^ STATE)
                value, is_state, to_join = np.zeros(len(u)), np.zeros(len(u), bool), np.zeros(len(u), bool)
                value[hits], is_state[hits], to_join[more] = found, True, True
                own = i[at]
                held, join = np.flatnonzero(is_state[own]), np.flatnonzero(to_join[own])
                values = value[own[held]]
            else:
                held, values, join = self.look_up(ctx[at] ^ STATE)
            yield at[held], values, at[join], ctx[at[join]] ^ STATE
            at = at[np.union1d(held, join)]
            key = pair(ctx[at], suf[at])
            hits, values, join = self.look_up(key)
            yield at[hits], values, at[join], key[join]


def learn(train: DataFrame, counts: DataFrame) -> Tree:
    """The tree of (text binary), given all word counts (key, n). Its tables are whole; the driver gets what tasks hold."""
    n, v = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    least = most_frequent(counts, CACHE_WORDS)
    words, held = sorted_columns(counts.where(F.col("n") >= least).toArrow(), "n")
    others = counts.where(F.col("n") < least)
    maps = [bit_map(others), bit_map(others.where("n > 1"))] if least > 1 else [None, None]
    log_p = F.log10((F.col("n") + 0.5) / F.lit(n + 0.5 * (v + 1)))
    before = counts.where(F.col("n") >= LEAST_COUNT).select("key", "n", log_p.alias("after"))
    tables, written, level = [], [], 0
    for level in range(1, DEPTH + 1):
        often = sorted_columns(before.where(F.col("n") >= max(HOT, n >> 20)).select("key", "n").toArrow(), "n")
        both = bit_map(before.where(F.col("n") >= LEAST_STATE)), bit_map(before)
        if not both[0].any():
            break
        found = gram_counts(train, level, both, tuple(often), max(1, -(-n // BUCKET)))
        parents = before.select(F.col("key").alias("suf"), F.col("after").alias("parent"))
        entries = cut(found.join(parents, "suf").select("ctx", "key", "n", "total", "parent"), "entries")
        states, new = grow(entries)
        states = cut(states, "states")
        new = new.join(states.select("ctx", "other"), "ctx", "left")
        after = F.when(F.col("other").isNull(), F.col("parent")).otherwise(F.coalesce("log_new", F.col("parent") + F.col("other")))
        value = F.col("log_new") - F.col("parent") - F.col("other")
        before = cut(new.select("key", "n", after.alias("after"), value.alias("value")), "grams")
        discard(entries)
        written += [states, before]
        key = F.col("ctx").bitwiseXOR(F.lit(int(STATE.view(np.int64)))).alias("key")
        tables += [states.select(key, F.col("total").alias("n"), F.col("other").alias("value")), before.where("value is not null").select("key", "n", "value")]
        if states.isEmpty():
            break
    keys, values, rest = np.zeros(0, np.uint64), np.zeros(0), None
    if tables:
        table = tables[0]
        for t in tables[1:]:
            table = table.union(t)
        table = cut(table, "tree")
        discard(*written)
        least_n = most_frequent(table, CACHE)
        keys, values = sorted_columns(table.where(F.col("n") >= least_n).select("key", "value").toArrow(), "value")
        rest = table.where(F.col("n") < least_n).select("key", "value")
    maps.append(bit_map(rest) if rest is not None and not rest.isEmpty() else None)
    tree = Tree(words, held, n, v, keys, values, tuple(maps), level)
    if maps[0] is not None:
        more = others.select("key", F.log10((F.col("n") + 0.5) / 0.5).alias("value"), F.lit(True).alias("word"))
        tree.table = more
    if maps[2] is not None:
        rest = rest.withColumn("word", F.lit(False))
        tree.table = rest if tree.table is None else tree.table.union(rest)
    return tree


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Learns from the documents that are not held out. ``base_score`` is the unigram model's log10 probability, ``score``
    the tree's. Words, states and entries that tasks hold are summed where the text is read; the others (each a tiny
    share of the tokens) are joined with the tables of all. Words and grams are told apart by 64-bit hashes.

    Null and empty texts hold their end only. Rows with a null id are trained on. Repeated rows count and are scored each.
    Extra columns are not read. An empty table gives no rows. Without any training text every token has probability 1.
    """
    d = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text"), held_out(F.col(id_col)).alias("held_out"))
    train = d.where(~F.col("held_out"))
    counts = cut(word_counts(train), "words")
    tree = learn(train, counts)
    held = docs.sparkSession.sparkContext.broadcast(tree)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = held.value
        for batch, h, ends in blocks(batches, 1):
            size, of = len(ends), np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
            trained = ~np.asarray(batch.column(2).to_numpy(zero_copy_only=False), bool)
            total = lambda at, x: np.bincount(of[at], x, size)
            u, i = np.unique(h, return_inverse=True)
            c, some, twice = tree.base(u)
            once = trained[of] & ((c == 0) & ~twice)[i]  # a word of a training text has been seen
            c = np.where(once, 1, c[i])
            join = some[i] & ~once
            every = np.arange(len(h))
            base, gain, where, keys = total(every, tree.log_p(c)), np.zeros(size), [of[join]], [h[join]]
            known = c > 0
            for at, value, more, key in tree.gains(h, u, i):
                gain += total(at, value)
                where.append(of[more])
                keys.append(key)
            where, keys = np.concatenate(where), np.concatenate(keys)
            order = np.argsort(where, kind="stable")
            offsets = np.searchsorted(where[order], np.arange(size + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(2), pa.array(np.diff(ends, prepend=0)), pa.array(total(every, known).astype(np.int64)),
                pa.array(base), pa.array(gain), pa.ListArray.from_arrays(pa.array(offsets), longs(keys[order]))],
                names=["doc_id", "held_out", "n_tokens", "known", "base", "gain", "keys"])

    kind = dict(d.dtypes)["doc_id"]
    read = d.mapInArrow(run, f"doc_id {kind}, held_out boolean, n_tokens long, known long, base double, gain double, keys array<long>")
    out, zero = read, F.lit(0.0)
    if tree.table is not None:
        out = cut(read.withColumn("row", F.monotonically_increasing_id()), "scored")
        more = out.select("row", F.explode("keys").alias("key")).join(tree.table, "key")
        more = more.groupBy("row").agg(
            F.sum(F.when(F.col("word"), F.col("value"))).alias("more_base"), F.count_if("word").alias("more_known"),
            F.sum(F.when(~F.col("word"), F.col("value"))).alias("more_gain"))
        out = out.join(more, "row", "left")
    else:
        out = out.withColumns({"more_base": zero, "more_known": F.lit(0), "more_gain": zero})
    base = F.col("base") + F.coalesce("more_base", zero)
    return out.select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("more_known", F.lit(0))).cast("long").alias("n_known"),
        F.lit(tree.n).cast("long").alias("train_tokens"), base.alias("base_score"), (base + F.col("gain") + F.coalesce("more_gain", zero)).alias("score"))

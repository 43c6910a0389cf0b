"""Toxicity: noisy-channel deobfuscation, then a score of the restored text."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.hashes import CHUNK, FOLDED, LETTERS, blocks, byte_set, mix, powers, split

#: Labelled rows that the classifier is fitted on, at most: those with the smallest digests of their ids. The character
#: model is counted over all texts.
FIT_ROWS = 30_000
THRESHOLD = 0.3
BUCKETS = 1 << 18
CACHE_WORDS = 1_000_000
#: Bytes of text, and restored words, that are worked on together.
TOGETHER, WORDS = 1 << 20, 50_000

#: What a sign may stand for, and signs that are put between letters.
STANDS_FOR = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t"}
BETWEEN = "._*~^#-"
#: Costs in nats: of reading a sign as a letter, of dropping a sign or a space, of each way to read a run.
SIGN_COST, DROP_COST, RUN_COST = 1.0, 1.0, 0.7

#: All are searched for once in a token or text, without nested repeats: time is in proportion to its length, whatever it holds.
LEAD, LEAD_SIGNS = re.compile(r"[^\w@$!|+]+"), re.compile(r"\W{2,}")
LETTER, TRIPLE = re.compile(r"[^\W\d_]"), re.compile(r"(.)\1\1")
SIGN_AFTER, SIGN_BEFORE = re.compile(r"[0-9@$!|+._*~^#-]"), re.compile(r"[0-9@$!|+]")
RUN = re.compile(r" +|(.)\1+|[\W\d_]", re.DOTALL)
SPACED = re.compile(r"(?<!\S)(?:[^\s._*-][ ._*-]{1,2}){2,}[^\s._*-](?=[^\w\s]*(?!\S))")
_SEPARATOR = byte_set(b"._*-")
_WIDTH = np.array([1] * 192 + [2] * 32 + [3] * 16 + [4] * 16, np.int64)  # bytes of a character, by its first
_CODE = np.array([k - 96 if 97 <= k <= 122 else k - 64 if 65 <= k <= 90 else 0 if k in b" \t\r\n" else 27 + k % 5 for k in range(256)], np.int32)


class CharModel:
    """Trigram model over 32 symbols: the end of a word, a to z, and five classes of other bytes."""

    def __init__(self, counts: np.ndarray):
        n = counts.reshape(32, 32, 32).astype(float)
        self.cost = (-np.log((n + 0.1) / (n.sum(axis=2, keepdims=True) + 3.2))).tolist()

    @staticmethod
    def symbol(x: str) -> int:
        return ord(x) - 96 if "a" <= x <= "z" else 0 if x == " " else 27 + ord(x) % 5

    def step(self, state: tuple[int, int], letters: str) -> tuple[float, tuple[int, int]]:
        cost, (a, b) = 0.0, state
        for x in letters:
            c = self.symbol(x)
            cost += self.cost[a][b][c]
            a, b = b, c
        return cost, (a, b)

    def decode(self, token: str) -> str:
        """The likeliest words behind a token or a row of spelled letters: Viterbi over its runs, each with all its readings.

        A space may stand or go, as words are likelier with it or without; states are the last two symbols, all of which
        are followed, so time is in proportion to the runs. Letters that can be read in one way only go by together: after two of
        them a single state is left.
        """
        paths: dict[tuple[int, int], tuple[float, tuple]] = {(0, 0): (0.0, ())}  # words as links to what stands before
        at = 0
        for run in [*RUN.finditer(token), None]:
            plain = token[at : run.start() if run else len(token)]
            if plain:
                paths = self.follow(paths, [(plain[:2], 0.0)])
                if len(plain) > 2:
                    (cost, word), = paths.values()
                    paths = {(self.symbol(plain[-2]), self.symbol(plain[-1])): (cost, (word, plain[2:]))}
            if run is None:
                break
            at, sign, long = run.end(), run[0][0], len(run[0]) > 1
            if sign == " ":
                ways = [(" ", 0.0), ("", DROP_COST)]
            else:
                letters = [sign] if sign.isalpha() else list(STANDS_FOR.get(sign, ""))
                cost = 0.0 if sign.isalpha() else SIGN_COST
                ways = [(x, cost) for x in letters]
                if long:
                    ways = [(x, c + RUN_COST) for x, c in ways] + [(x + x, c + RUN_COST) for x, c in ways]
                if sign in BETWEEN:
                    ways.append(("", DROP_COST))
                if not sign.isalpha():
                    ways.append((run[0], 3 * SIGN_COST))
            paths = self.follow(paths, ways)
        word = min(((c + self.cost[s[0]][s[1]][0], w) for s, (c, w) in paths.items()), key=lambda x: x[0])[1]
        letters = []
        while word:
            word, last = word
            letters.append(last)
        return "".join(reversed(letters))

    def follow(self, paths: dict, ways: list[tuple[str, float]]) -> dict:
        """The best path to each state that the ways lead to."""
        new: dict[tuple[int, int], tuple[float, tuple]] = {}
        for state, (sofar, word) in paths.items():
            for letters, price in ways:
                step, to = self.step(state, letters)
                total = sofar + step + price
                if to not in new or total < new[to][0]:
                    new[to] = total, (word, letters)
        return new


def trimmed(token: str) -> str:
    """Without the signs at its edges: all in front that stand for no letter or come in twos, all behind that come in twos or are no @ or $."""
    lead = LEAD.match(token) or LEAD_SIGNS.match(token)
    start, stop = lead.end() if lead else 0, len(token)
    last = stop
    while last > start and not (token[last - 1].isalnum() or token[last - 1] == "_"):
        last -= 1
    return token[start : last if stop - last > 1 or (stop > last and token[last] not in "@$") else stop]


def is_odd(word: str) -> bool:
    """Whether a word has a letter before a sign, a sign that stands for one before a letter, or a letter thrice."""
    letter, sign = LETTER.search(word), SIGN_BEFORE.search(word)
    return bool(letter and SIGN_AFTER.search(word, letter.end()) or sign and LETTER.search(word, sign.end()) or TRIPLE.search(word))


def restore(token: str, model: CharModel) -> str:
    """A lower-case token without its edges, decoded if it mixes letters with signs or repeats a letter thrice."""
    word = token if token.isalpha() else trimmed(trimmed(token))
    return model.decode(word) if len(word) > 1 and is_odd(word) else word


def spelled(text: str, model: CharModel) -> list[str]:
    """The words that runs of single characters spell; a run's first or last may be a word of one letter beside it, so
    runs are read without these, too."""
    out: dict[str, None] = {}
    for m in SPACED.finditer(text.lower()):
        run = m[0]
        for part in (run, run[1:].lstrip(" ._*-"), run[:-1].rstrip(" ._*-")):
            out.update(dict.fromkeys(model.decode(part).split()))
    return list(out)


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """For many words: (word, bucket) of each word whole, of its beginnings and of its inner pieces, all in bytes."""
    owners, buckets = [], []
    for at in range(0, len(words), WORDS):
        some = [w.encode("utf-8", "surrogatepass") for w in words[at : at + WORDS]]
        length = np.fromiter(map(len, some), np.int64, len(some))
        first = np.cumsum(length) - length
        data = np.frombuffer(b"".join(some), np.uint8)
        up, down = powers(1 << max(CHUNK.bit_length(), len(data).bit_length()))
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(LETTERS[data] * up[: len(data)])))

        def add(owner: np.ndarray, start: np.ndarray, stop: np.ndarray, kind: int) -> None:
            x = (sums[stop] - sums[start]) * down[start] + np.uint64(kind)
            owners.append(owner + at)
            buckets.append((mix(x * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(BUCKETS)).astype(np.int64))

        real = np.flatnonzero(length)
        add(real, first[real], first[real] + length[real], 1)
        for k in (3, 4, 5, 6):
            some_ = np.flatnonzero(length > k)
            add(some_, first[some_], first[some_] + k, 2)
        inner = np.maximum(length - 5, 0)
        owner = np.repeat(np.arange(len(length)), inner)
        start = first[owner] + 1 + np.arange(len(owner)) - np.repeat(np.cumsum(inner) - inner, inner)
        add(owner, start, start + 5, 3)
    if not owners:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(owners), np.concatenate(buckets)


class Words:
    """The distinct words of a block of texts: per (text, word) pair ``text`` and ``word``, the words' ``keys`` in order, and
    the words that texts spell letter by letter."""

    def __init__(self, texts: list[bytes], model: CharModel):
        self.raw, starts, ends, h, stand = split(texts, letters=FOLDED)
        text = np.repeat(np.arange(len(texts)), np.diff(stand, prepend=0))
        self.keys, place, which = np.unique(h, return_index=True, return_inverse=True)
        self.starts, self.ends = starts[place], ends[place]
        code = np.unique(text * max(len(self.keys), 1) + which)
        self.text, self.word = code // max(len(self.keys), 1), code % max(len(self.keys), 1)
        b = np.frombuffer(self.raw, np.uint8)
        width = _WIDTH[b[starts]]
        short = (ends - starts <= width) | _SEPARATOR[b[np.minimum(starts + width, len(b) - 1)]]
        several = short[1:] & short[:-1] & (text[1:] == text[:-1])
        self.spelled = [(i, w) for i in np.unique(text[1:][several]).tolist() for w in spelled(texts[i].decode("utf-8", "replace"), model)]

    def restored(self, which: np.ndarray, model: CharModel) -> list[str]:
        return [restore(self.raw[a:b].decode("utf-8", "replace").lower(), model) for a, b in zip(self.starts[which].tolist(), self.ends[which].tolist(), strict=True)]


def char_counts(texts: DataFrame) -> np.ndarray:
    """Trigram counts over all of (text): 32^3 numbers."""

    def run(batches):
        counts = np.zeros(32768, np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                for at in range(0, len(text or b""), 1 << 20):  # with two bytes of overlap
                    c = _CODE[np.frombuffer(text[max(0, at - 2) : at + (1 << 20)], np.uint8)]
                    if len(c) > 2:
                        counts += np.bincount((c[:-2] << 10) + (c[1:-1] << 5) + c[2:], minlength=32768)
                        # a word's first letter follows a word's end, whatever stood before
                        counts += np.bincount(c[2:][c[1:-1] == 0], minlength=32768)
        i = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(counts[i])], names=["i", "n"])

    counts = np.zeros(32768)
    for r in texts.select(F.col("text").cast("binary")).mapInArrow(run, "i long, n long").groupBy("i").agg(F.sum("n").alias("n")).collect():
        counts[r["i"]] = r["n"]
    return counts


def fold(id_: Column) -> Column:
    return F.coalesce(F.crc32(id_.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _bucket_counts(fit: DataFrame, model: CharModel) -> np.ndarray:
    """For each bucket the toxic and the other documents of (text binary, toxic) that hold it."""

    def run(batches):
        counts = np.zeros((2, BUCKETS), np.int64)
        for batch in batches:
            toxic, at = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64), 0
            for texts in blocks(batch.column(0).to_pylist(), TOGETHER):
                words = Words(texts, model)
                every = words.restored(np.arange(len(words.keys)), model) + [w for _, w in words.spelled]
                owner, bucket = features(every)
                text = np.concatenate((words.text, np.array([i for i, _ in words.spelled], np.int64)))
                word = np.concatenate((words.word, len(words.keys) + np.arange(len(words.spelled))))
                order = np.argsort(owner, kind="stable")  # the buckets of a word stand together
                bucket, n = bucket[order], np.bincount(owner, minlength=len(every))
                first, n = (np.cumsum(n) - n)[word], n[word]
                of = np.repeat(first - np.cumsum(n) + n, n) + np.arange(n.sum())
                code = np.unique(np.repeat(text, n) * BUCKETS + bucket[of])
                for k in (0, 1):
                    counts[k] += np.bincount(code[toxic[at + code // BUCKETS] == k] % BUCKETS, minlength=BUCKETS)
                at += len(texts)
        i = np.flatnonzero(counts.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(counts[1, i]), pa.array(counts[0, i])], names=["i", "t", "c"])

    out = np.zeros((2, BUCKETS))
    for r in fit.select("text", "toxic").mapInArrow(run, "i long, t long, c long").groupBy("i").agg(F.sum("t").alias("t"), F.sum("c").alias("c")).collect():
        out[:, r["i"]] = r["t"], r["c"]
    return out


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Coefficients with a small ridge, by Newton's method."""
    beta = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + np.eye(x.shape[1]) * 0.1
        beta = beta + np.linalg.solve(hessian, x.T @ (y - p) - 0.1 * beta)
    return beta


class Scorer:
    """Everything a task needs: 1 MB of weights, the character model and seven coefficients. Keeps words' values while it lives."""

    def __init__(self, model: CharModel, weights: np.ndarray, beta: np.ndarray):
        self.model, self.weights, self.beta = model, weights, beta
        self.keys, self.values = np.zeros(0, np.uint64), np.zeros(0)

    def value(self, words: list[str]) -> np.ndarray:
        """The largest weight of each word's features."""
        out = np.zeros(len(words))
        owner, bucket = features(words)
        np.maximum.at(out, owner, self.weights[bucket])
        return out

    def summaries(self, texts: list[bytes]) -> np.ndarray:
        """Seven numbers for each text: one, and its words' largest values and how many are large."""
        words = Words(texts, self.model)
        if len(self.keys) > CACHE_WORDS:
            self.keys, self.values = np.zeros(0, np.uint64), np.zeros(0)
        new = np.append(self.keys, 0)[np.searchsorted(self.keys, words.keys)] != words.keys
        if new.any():
            at = np.searchsorted(self.keys, words.keys[new])
            value = self.value(words.restored(np.flatnonzero(new), self.model))
            self.keys, self.values = np.insert(self.keys, at, words.keys[new]), np.insert(self.values, at, value)
        z = self.values[np.searchsorted(self.keys, words.keys)][words.word]
        text = np.concatenate((words.text, np.array([i for i, _ in words.spelled], np.int64)))
        z = np.concatenate((z, self.value([w for _, w in words.spelled])))
        n = len(texts)
        some = np.flatnonzero(z > 0)
        some = some[np.lexsort((-z[some], text[some]))]
        rank = np.arange(len(some)) - np.searchsorted(text[some], text[some])
        top = np.zeros((n, 8))
        few = rank < 8
        top[text[some[few]], rank[few]] = z[some[few]]
        above = lambda least: np.bincount(text[z > least], minlength=n)
        return np.column_stack((
            np.ones(n), top[:, 0], top[:, :3].mean(axis=1), top.mean(axis=1), np.log1p(above(3)), np.log1p(above(4.5)),
            above(3) / np.maximum(np.bincount(text, minlength=n), 1)))


def learn(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> Scorer:
    """Fit on at most ``fit_rows`` labelled rows outside the held-out fold.

    Half of them give each bucket its log ratio of document shares (with a prior that holds back rare ones); the
    other half fits the logistic curve over a document's highest ones, so that it sees what unseen documents give.
    """
    model = CharModel(char_counts(docs))
    one = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~fold(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    one = one.select(F.col("doc_id").alias("l_id"), (F.col("toxic") > 0).cast("int").alias("toxic"), F.xxhash64("doc_id").alias("h"))
    one = one.orderBy("h", "l_id").limit(fit_rows)
    fit = docs.join(F.broadcast(one), F.col("doc_id") == F.col("l_id")).select(F.col("text").cast("binary").alias("text"), "toxic", (F.pmod("h", F.lit(2)) == 0).alias("first"))
    t, c = _bucket_counts(fit.where("first"), model)
    n_t, n_c = fit.where("first").agg(F.coalesce(F.sum("toxic"), F.lit(0)), F.count("*")).first()
    n_c -= n_t
    ratio = np.log((t + 0.1) / (n_t + 0.2)) - np.log((c + 2.0) / (n_c + 4.0))
    weights = np.where(t > 0, np.maximum(ratio, 0), 0.0).astype(np.float32) if n_t else np.zeros(BUCKETS, np.float32)
    scorer = Scorer(model, weights, np.zeros(7))

    def run(batches):
        for batch in batches:
            x = [row for texts in blocks(batch.column(0).to_pylist(), TOGETHER) for row in scorer.summaries(texts).tolist()]
            yield pa.RecordBatch.from_arrays([batch.column(1).cast(pa.int64()), pa.array(x, pa.list_(pa.float64()))], names=["y", "x"])

    rows = fit.where("not first").select("text", "toxic").mapInArrow(run, "y long, x array<double>").toPandas()
    if rows.y.nunique() < 2:
        scorer.beta = np.array([-5.0, 1, 0, 0, 0, 0, 0]) if n_t else np.array([-5.0, 0, 0, 0, 0, 0, 0])
    else:
        scorer.beta = _logistic(np.stack(rows.x), rows.y.to_numpy(float))
    return scorer


def score_column(scorer: Scorer, text: Column) -> Column:
    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            x = np.concatenate([np.zeros((0, 7)), *map(scorer.summaries, blocks(texts, TOGETHER))])
            yield pd.Series(1 / (1 + np.exp(-np.clip(x @ scorer.beta, -30, 30))))

    return score(text.cast("binary"))


def score_toxicity(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD,
    fit_rows: int = FIT_ROWS, keep: tuple[str, ...] = (),
) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted[, columns in ``keep``].

    A text's tokens are restored (see :class:`CharModel`) and scored; only the text enters a score. Null and empty texts
    are scored as texts without words. Repeated rows get equal scores; of repeated labels the highest counts; rows with a
    null id are scored but not learned from. Without labels of both kinds every score is low. Whole texts are read, and time is
    in proportion to them, whatever tokens they hold. An empty table gives no rows. Columns of other names are not read, and
    those of ``keep`` may bear any name but the four of the result.
    """
    named = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), *(F.col(c).alias(f"keep_{c}") for c in keep))
    scorer = learn(named, labels.select("doc_id", "toxic"), fit_rows)
    out = named.withColumn("held_out", fold(F.col("doc_id"))).withColumn("score", score_column(scorer, F.col("text")))
    return out.select(
        "doc_id", "held_out", "score", F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"),
        *(F.col(f"keep_{c}").alias(c) for c in keep))

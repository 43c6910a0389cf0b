"""Phrases of two and three words against brute force."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tessera.llm import phrases

DOCS = "doc_id long, text string, lang string, a long, score double, word string"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, lang, 1, 0.5, "w") for i, (t, lang) in enumerate(rows)], DOCS)


def brute(rows, least=10, top=2000):
    f, n, out = defaultdict(Counter), Counter(), []
    lower = {65 + k: 97 + k for k in range(26)}
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(lower)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in (1, 2, 3):
                f[lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    for lang, c in f.items():
        rows = []
        for g, a in c.items():
            if len(g) > 1 and a >= least:
                if len(g) == 2 and any(100 * b >= 50 * a for h, b in c.items() if len(h) == 3 and b >= least and g in (h[:2], h[1:])):
                    continue
                score, k = min((1000000 * a * a // (c[g[:k]] * c[g[k:]]), k) for k in range(1, len(g)))
                rows.append((-score, -a, " ".join(g).encode(), c[g[:k]], c[g[k:]]))
        for rank, (s, a, p, l, r) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, n[lang], -s))
    return sorted(out)


def found(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def texts(seed, n=120):
    rng = random.Random(seed)
    words = ["of", "the", "New", "york", "city", "Été", "été", "x-y", "\x00", "漢字"] + [f"w{k}" for k in range(12)]
    out = []
    for i in range(n):
        parts = []
        for _ in range(rng.randrange(25)):
            parts.append(rng.choice(["new york city", "of the", "York  city", " ".join(rng.choices(words, k=rng.randrange(1, 6)))]))
            parts.append(rng.choice([" ", " ", "\t", ". ", ",", "\n", "\v", "\x85", ";;"]))
        out.append(("".join(parts), rng.choice(["en", "de", None, "und"])))
    return out + [(None, "en"), ("", None), ("new york city " * 3000, "fr"), ("a" * 50_000, "fr"), (". , ;", "es"), ("one two", "es")]


@pytest.mark.parametrize("seed,sample,least", [(1, 8, 10), (2, 1_000_000, 10), (3, 1, 4), (4, 2, 2)])
def test_against_brute_force_whatever_the_sample(spark, seed, sample, least):
    rows = texts(seed)
    assert found(phrases.collocations(docs(spark, rows), least=least, sample=sample)) == brute(rows, least)


def test_top_ties_and_bytes(spark):
    rows = [("B a. É b. z z. a b. a a b. B c", "en")] * 12
    for top in (1, 3, 2000):
        assert found(phrases.collocations(docs(spark, rows), top=top)) == brute(rows, top=top)


def test_empty_tables_and_repeated_rows(spark):
    assert phrases.collocations(docs(spark, [])).count() == 0 and phrases.collocations(docs(spark, [("a b c", "en")] * 9)).count() == 0
    assert found(phrases.collocations(docs(spark, [("a b c", "en")] * 10))) == [("en", 1, "a b c", 10, 10, 10, 30, 1000000)]


def test_counts_beyond_64_bits(spark):
    from pyspark.sql import functions as F

    n = 9_000_000_000_000
    table = spark.createDataFrame([(n, n + 1, n + 2)], "n long, l long, r long")
    expr = "cast((cast(1000000 AS decimal(7, 0)) * cast(n AS decimal(15, 0)) * cast(n AS decimal(15, 0))) div (cast(l AS decimal(19, 0)) * cast(r AS decimal(19, 0))) AS bigint)"
    assert table.select(F.expr(expr).alias("s")).first().s == 1000000 * n * n // ((n + 1) * (n + 2))


def test_tuples_with_equal_hashes_are_told_apart():
    keys = np.array([5, 5, 7], np.uint64)
    *k, n = phrases._summed([keys, keys + np.uint64(1)], keys)
    assert [x.tolist() for x in k] == [[5, 7], [6, 8]] and n.tolist() == [2, 1]
    first, n = phrases._summed([np.array([1, 2, 1], np.uint64)], np.array([9, 9, 9], np.uint64))
    assert sorted(zip(first.tolist(), n.tolist(), strict=True)) in ([(1, 1), (1, 1), (2, 1)], [(1, 2), (2, 1)])


def test_a_part_of_the_keys_is_counted_at_a_time():
    import pyarrow as pa

    class Held:
        value = (None, None), []

    batch = pa.RecordBatch.from_arrays([pa.array(["en"] * 100), pa.array([t.encode() for t, _ in texts(5, 100)[:100]])], names=["lang", "text"])
    count = lambda *part: Counter(tuple(r.values())[:3] for b in phrases._counts(Held, True, 1, *part)(iter([batch])) for r in b.to_pylist())
    whole, parts = count(), [count(i, phrases.PARTS) for i in range(phrases.PARTS)]
    assert sum(parts, Counter()) == whole and phrases.PARTS > 1
    assert max(map(len, parts)) < 0.7 * len(whole)

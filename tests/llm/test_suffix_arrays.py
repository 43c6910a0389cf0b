"""Removal of repeated byte strings against brute force."""

import hashlib
import random

import numpy as np
import pytest

from tessera.llm import suffix_arrays

DOCS = "doc_id long, text string, begin long, key string, runs int"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, 7, "k", 1) for i, t in rows], DOCS)


def brute(rows, length=100):
    first, out = {}, []
    for i, t in rows:
        if i is not None:
            b = (t or "").encode()
            for s in range(len(b) - length + 1):
                g = b[s : s + length]
                first[g] = min(first.get(g, (i, s)), (i, s))
    for i, t in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b) + 1, bool)
        if i is not None:
            for s in range(len(b) - length + 1):
                if first[b[s : s + length]] < (i, s):
                    gone[s : s + length] = True
        spans = int((gone[:-1] & ~np.concatenate(([False], gone[:-2]))).sum()) if len(b) else 0
        out.append((i, len(b), int(gone.sum()), spans, hashlib.sha256(bytes(x for x, g in zip(b, gone, strict=False) if not g)).hexdigest()))
    return sorted(out, key=repr)


def found(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()), key=repr)


def random_docs(seed, alphabet="abcdefgh ", n=60):
    rng = random.Random(seed)
    make = lambda k: "".join(rng.choice(alphabet) for _ in range(k))
    shared = [make(k) for k in (99, 100, 101, 130, 180, 260, 900)]
    rows = []
    for i in range(n):
        parts = [make(rng.choice([0, 5, 40, 300]))]
        for _ in range(rng.randrange(4)):
            p = rng.choice(shared)
            cut = rng.randrange(0, 30) if rng.random() < 0.3 else 0
            parts += [p[cut:], make(rng.choice([0, 1, 3, 200]))]
        rows.append((i * 7 % n, "".join(parts)))
    return rows


@pytest.mark.parametrize("seed,bucket", [(1, 2000), (2, 3), (3, 1)])
def test_against_brute_force_with_buckets_that_recur(spark, seed, bucket):
    rows = random_docs(seed)
    assert found(suffix_arrays.remove_repeats(docs(spark, rows), bucket=bucket)) == brute(rows)


def test_runs_of_one_letter_and_of_two_in_turn(spark):
    rows = [(1, "a" * 500), (2, "a" * 99), (3, "b" + "a" * 150 + "b"), (4, "ab" * 200), (5, "ba" * 60), (6, "é" * 90), (7, "x" + "é" * 60)]
    assert found(suffix_arrays.remove_repeats(docs(spark, rows), bucket=2)) == brute(rows)


def test_odd_rows(spark):
    long = "".join(map(chr, np.random.default_rng(1).integers(97, 123, 150)))
    rows = [(None, long), (None, None), (1, None), (2, ""), (3, long), (4, long), (5, long[:-1]), (6, "\0" * 120 + "\n"), (7, "\0" * 101)]
    assert found(suffix_arrays.remove_repeats(docs(spark, rows))) == brute(rows)
    same = found(suffix_arrays.remove_repeats(docs(spark, [(3, long), (3, long), (4, long), (4, "z" + long)])))
    assert [r[:4] for r in same] == [(3, 150, 0, 0), (3, 150, 0, 0), (4, 150, 150, 1), (4, 151, 150, 1)]


def test_an_empty_table(spark):
    assert suffix_arrays.remove_repeats(docs(spark, [])).count() == 0


def test_a_text_over_several_pieces_of_the_parse(spark):
    rng = np.random.default_rng(4)
    text = "".join(map(chr, rng.integers(97, 123, 300_000)))
    rows = [(1, text[1000:260_000]), (2, text), (3, text[131_000:131_150])]
    got = found(suffix_arrays.remove_repeats(docs(spark, rows)))
    assert [r[1:4] for r in got] == [(259_000, 0, 0), (300_000, 259_000, 1), (150, 150, 1)]


def test_parts_of_the_parse_hold_all_strings(monkeypatch):
    rng = random.Random(2)
    texts = ["a" * 3000, "".join(rng.choice("ab") for _ in range(5000)), "", "x" * 99]
    texts = [t.encode() for t in texts]
    whole = list(suffix_arrays.parse(texts))
    monkeypatch.setattr(suffix_arrays, "TOGETHER_ROWS", 500)
    monkeypatch.setattr(suffix_arrays, "CHUNK", 1000)
    for parts in (whole, list(suffix_arrays.parse(texts))):
        got = [(t, s + k) for p in parts for t, s, m in zip(p.text.tolist(), p.start.tolist(), p.many.tolist(), strict=True) for k in range(m)]
        assert sorted(got) == [(t, s) for t, b in enumerate(texts) for s in range(len(b) - 99)]
    assert len(parts) > 3 and len(whole) == 1


def test_many_texts_share_a_passage_between_texts_of_their_own(spark):
    rng = random.Random(9)
    passage = "".join(rng.choice("abcdefghij") for _ in range(140))
    rows = [(i, "".join(rng.choice("klmnop") for _ in range(60)) + passage + "".join(rng.choice("qrstuv") for _ in range(60))) for i in range(300)]
    got = found(suffix_arrays.remove_repeats(docs(spark, rows), bucket=20))
    assert got == brute(rows)
    assert all(r[2] >= 140 for r in got if r[0])


def test_induced_repeats_equal_sets_of_strings():
    rng = random.Random(5)
    core = bytes(rng.choice(b"ab") for _ in range(90))
    rows = sorted({(bytes(rng.choice(b"ab") for _ in range(9)) + core + bytes(rng.choice(b"ab") for _ in range(9))) for _ in range(200)}, key=lambda t: t[20:])
    many, anchor = np.full(len(rows), 9), np.full(len(rows), 20)
    order = np.array([rng.randrange(100) for _ in rows])
    row, string = suffix_arrays.induce(np.zeros(len(rows), np.int64), rows, anchor, many, order, 100)
    least = {}
    for t, o in zip(rows, order.tolist(), strict=True):
        for j in range(9):
            least[j, t[j : j + 100]] = min(o, least.get((j, t[j : j + 100]), o))
    want = {(k, j) for k, t in enumerate(rows) for j in range(9) if least[j, t[j : j + 100]] < order[k]}
    assert set(zip(row.tolist(), string.tolist(), strict=True)) == want and want


def test_no_task_keeps_two_python_workers(spark):
    plan = suffix_arrays.remove_repeats(docs(spark, [(1, "x" * 300), (2, "y" * 30)]))._jdf.queryExecution().executedPlan()
    found = []

    def walk(node, inside):
        name = node.nodeName()
        found.append(name)
        assert not (inside and name == "MapInArrow")
        inside = (inside or name == "MapInArrow") and "Exchange" not in name
        for i in range(node.children().size()):
            walk(node.children().apply(i), inside)

    walk(plan.initialPlan() if plan.nodeName() == "AdaptiveSparkPlan" else plan, False)
    assert found.count("MapInArrow") == 3


def test_a_run_of_one_letter_leaves_the_parse_piece_by_piece():
    most = suffix_arrays.CHUNK + suffix_arrays.TOGETHER_ROWS
    parts = [len(p.start) for p in suffix_arrays.parse([b"a" * 1_000_000])]
    assert sum(parts) > 900_000 and max(parts) <= most < 1 << 18

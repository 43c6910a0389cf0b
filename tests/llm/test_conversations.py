"""The prefix trie of rebuilt conversations against brute force."""

import hashlib
import random
import re
import zlib

import pytest

from tessera.llm import conversations

TURNS = "conv_id long, turn long, role string, text string, depth long, digest string, n_convs int"


def turns(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 2) for r in rows], TURNS)


def brute(rows):
    own = {}
    for c, t, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        own.setdefault(c, []).append((role or "", text or ""))
    built = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = tuple(own.get(c - c % 20, [])[:h] + own[c][h:])
    nodes = {}
    for c, seq in built.items():
        for d in range(len(seq) + 1):
            nodes.setdefault(seq[:d], []).append(c)
    children = {}
    for path in nodes:
        if path:
            children.setdefault(path[:-1], []).append(path)

    def total(path):
        mine = (len(nodes[path]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", path[-1][1])) if path else 0
        below = [total(k) for k in children.get(path, [])]
        return sum(x[0] for x in below) or 1, mine + sum(x[1] for x in below)

    out = []
    for path, cs in nodes.items():
        ends = ",".join(str(c) for c in sorted(c for c in cs if built[c] == path))
        out.append((min(cs), len(path), min(nodes[path[:-1]]) if path else None, len(cs), len(children.get(path, [])), *total(path), hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def found(df):
    cols = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted((tuple(r) for r in df.select(cols).collect()), key=repr)


def rows_of(seed):
    rng = random.Random(seed)
    pick = lambda: (rng.choice(["user", "assistant", None]), rng.choice(["a b", "hello  there\nyou", "", None, "é 漢字 x", "user"]))
    rows = []
    for c in [*range(0, 45), 1000, 1007, 12345678901]:
        n = rng.choice([0, 1, 2, 3, 5, 8])
        rows += [(c, rng.choice([None, k, k, k]), *pick()) for k in range(n)]
    return rows + rows[:5] + [(None, 1, "user", "lost")]


@pytest.mark.parametrize("seed", [1, 2])
def test_trie_against_brute_force(spark, seed):
    rows = rows_of(seed)
    assert found(conversations.prefix_trie(turns(spark, rows))) == brute(rows)


def test_a_conversation_over_several_partitions(spark):
    rows = [(21, k, "user", f"t{k % 7}") for k in range(400)] + [(c, k, "user", f"t{k % 7}") for c in (20, 22, 40, 41) for k in range(30)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        prefixes = conversations.turn_prefixes(turns(spark, rows))
        assert sorted((r.conv_id, r.i) for r in prefixes.collect()) == sorted((c, i + 1) for c, n in ((20, 30), (21, 400), (22, 30), (40, 30), (41, 30)) for i in range(n))
        same = {(r.i, r.f0, r.f1, r.f2, r.f3) for r in prefixes.where("i <= 30").collect()}
        assert len(same) == 30
        assert found(conversations.prefix_trie(turns(spark, rows))) == brute(rows)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_very_many_members_of_a_node(spark):
    rows = [(c, 0, "user", "same") for c in range(1500)] + [(2, 1, "user", "x" * 200_000)]
    assert found(conversations.prefix_trie(turns(spark, rows))) == brute(rows)


def test_an_empty_table(spark):
    assert conversations.prefix_trie(turns(spark, [])).count() == 0


def test_repeated_and_null_rows(spark):
    rows = [(40, 1, "user", "a")] * 3 + [(41, 1, "user", "a")] * 5 + [(43, None, None, None)]
    assert found(conversations.prefix_trie(turns(spark, rows))) == brute(rows)

"""Operators for training data: edge cases, and brute force where SQL cannot follow."""

import base64
import gzip
import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tessera.llm import collision_search, hashes, licenses, minhash, mixing, near_vectors, packing, pii, queries, suffix_tree, toxicity, warc
from tessera.plans.lineage import new_path

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, n long, score double, size long, rep long"


def docs(spark, texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame([(i, t, "en", "s", 0, 1, 0.5, 7, 9) for i, t in zip(ids, texts, strict=True)], DOCS)


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 0, 1, 2) for i, v in rows], "vec_id long, embedding array<float>, label int, n_links int, v int")


ODD = [None, "", "word", "a b c d e f", "a b c d e f", "x " * 30_000, "é 漢字 \U0001f600 İ"]


# 1 ----------------------------------------------------------------------------------------------------------------

def brute_links(rows, t=0.9):
    good = {i: np.array(v, np.float32).astype(float) for i, v in rows if v and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    links = {i: {j for j, b in good.items() if i != j and len(a) == len(b) and a @ b / math.sqrt((a @ a) * (b @ b)) >= t} for i, a in good.items()}
    out = {}
    for i, _ in rows:
        seen, todo = {i}, [i]
        while todo:
            new = links.get(todo.pop(), set()) - seen
            seen |= new
            todo += new
        out[i] = (len(links.get(i, ())), min(seen))
    return out


@pytest.mark.parametrize("block", [16, 4096])
def test_near_vectors_against_brute_force(spark, block):
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((12, 40))
    x = [(int(i), (centres[i % 12] + rng.standard_normal(40) * (0.1 + 0.35 * (i % 5 == 0))).astype(np.float32).tolist()) for i in range(240)]
    x += [(300, None), (301, []), (302, [0.0] * 40), (303, [math.nan] * 40), (304, [None] * 40), (305, x[0][1]), (306, x[0][1]), (307, [1.0, 2.0]), (308, [2.0, 4.0]), (309, [math.inf] + [1.0] * 39)]
    got = {r.vec_id: (r.n_links, r.component_id) for r in near_vectors.near_vectors(vectors(spark, x), block=block).collect()}
    assert got == brute_links(x)


def test_near_vectors_of_an_empty_table_and_null_ids(spark):
    assert near_vectors.near_vectors(vectors(spark, [])).count() == 0
    r = near_vectors.near_vectors(vectors(spark, [(None, [1.0, 0.0]), (4, [1.0, 0.0])])).collect()
    assert sorted((x.vec_id or -1, x.n_links, x.kept) for x in r) == [(-1, 0, True), (4, 0, True)]


def test_near_vectors_repeated_rows(spark):
    got = near_vectors.near_vectors(vectors(spark, [(1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [0.0, 2.0]), (3, [1.0, 0.1])])).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in got) == [(1, 1, 1), (1, 1, 1), (2, 1, 1), (3, 2, 1), (3, 2, 1)]


# 2 ----------------------------------------------------------------------------------------------------------------

def spans(spark, text):
    r = pii.find_pii(docs(spark, [text])).select(pii.render(F.col("pii_spans")).alias("s")).first()
    return r.s


@pytest.mark.parametrize("text,want", [
    ("a@b.c_d@e.f", "email:0:5,email:5:11"), ("é x@y.zz", "email:2:8"), ("1.2.3.4 1.2.3.256 01.002.3.4", "ip:0:7,ip:18:28"),
    ("4111 1111 1111 1111 4111", ""), ("4111-1111-1111-1111", "card:0:19"), ("+1 (499) 555-6503 +12 3", "phone:0:17"),
    ("iban GB82 WEST 1234 5698 7654 32.", "iban:5:32"), ("ssn 123-45-6789", "ssn:4:15"), ("123-45-6789", ""), (None, ""), ("", ""),
    ("IBAN DE89 3704 0044 0532 0130 00 BIC COBADEFFXXX", "iban:5:32"), ("DE89370400440532013000 A new", "iban:0:22"), ("DE893704004405320130001", ""),
    ("DE89 3704 0044 0532 0130 00 GB82 WEST 1234 5698 7654 32", "iban:0:27,iban:28:55"), ("GB82WEST12345698765432,DE89370400440532013000", "iban:0:22,iban:23:45"),
    ("DE89 3704 0044 0532 0130 0 GB82 WEST 1234 5698 7654 32", "iban:27:54"), ("XX89370400440532", ""),
    ("ssn " + "1" * 60 + " 123-45-6789", ""), ("123-45-6789 " + "x" * 27 + " tax", "ssn:0:11"), ("123-45-6789 " + "x" * 37 + " tax", ""),
])
def test_spans(spark, text, want):
    assert spans(spark, text) == want


def test_long_runs_take_no_stack_and_little_time(spark):
    text = "1" * 60_000 + " " + "a.b" * 20_000 + " " + "1.1" * 20_000 + " " + "A1 " * 20_000
    assert "email" not in spans(spark, text)


def test_many_spans_in_one_text(spark):
    text = "a@b.c 1.2.3.4 " * 5000
    d = docs(spark, [text])
    r = pii.find_pii(d).select("pii_spans").first()[0]
    assert len(r) == 10_000 and (r[4999].start, r[4999].end) == (4999 * 14, 4999 * 14 + 5) and r[9999].start == 4999 * 14 + 6
    assert pii.redact(d).first().text == "<EMAIL> <IP> " * 5000


def test_spans_overlap_and_other_columns_stay(spark):
    d = docs(spark, ["mail +1 555 555 0100@x.yz or 4111111111111111", None]).withColumn("pii_spans", F.lit(7)).withColumn("pii_email", F.lit(8)).withColumn("_pii_i_ip", F.lit(9))
    out = pii.redact(d)
    assert out.columns == d.columns
    assert [(r.text, r.pii_spans, r.pii_email, r["_pii_i_ip"]) for r in out.orderBy("doc_id").collect()] == [("mail <PHONE> or <CARD>", 7, 8, 9), (None, 7, 8, 9)]
    found = pii.find_pii(d)
    assert found.first().pii_email == 8 and [s.kind for s in found.orderBy("doc_id").first().pii_spans] == ["email", "card", "phone"]


def test_redaction(spark):
    d = docs(spark, ["mail x@y.zz now", None, "nothing"])
    assert [r.text for r in pii.redact(d).orderBy("doc_id").collect()] == ["mail <EMAIL> now", None, "nothing"]


# 3 ----------------------------------------------------------------------------------------------------------------

def test_packing_round_trip(spark):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(queries.tokenizer_path())
    texts = [*ODD, "The, THE. don't <|endoftext|> a\x01b c\x1cd  ΣΑΣ!!", "tok " * 5000]
    got = defaultdict(list)
    for r in packing.pack(docs(spark, texts), queries.tokenizer_path()).collect():
        got[r.doc_id].append(r)
        assert r.length & (r.length - 1) == 0 and r.length <= 4096 and r.offset == 0 and zlib.crc32(r.ids) == r.ids_crc32
    for i, text in enumerate(texts):
        pieces = sorted(got[i], key=lambda r: r.start)
        ids = np.frombuffer(b"".join(p.ids for p in pieces), "<u4").tolist()
        assert ids == [*t.encode(text or "", add_special_tokens=False).ids, 2]
        assert [p.start for p in pieces] == [sum(q.length for q in pieces[:k]) for k in range(len(pieces))]
    every = [r.sequence_id for rs in got.values() for r in rs]
    assert len(set(every)) == len(every)


@pytest.mark.parametrize("n", [0, 1, 4095, 4096, 4097, 12_345])
def test_binary_pieces(n):
    p = packing.binary_pieces(n)
    assert sum(p) == n and p == sorted(p, reverse=True) and len(p) == n // 4096 + bin(n % 4096).count("1")


# 4 ----------------------------------------------------------------------------------------------------------------

def test_warc_round_trip_with_pushdown(spark):
    html = {1: "same", 2: "same", 3: None, 4: "", 5: "é WARC/1.1\r\n\r\nWARC-Type: x", 6: "y" * 3_000_000, 7: "same", 8: "\r\n\r\n"}
    pages = spark.createDataFrame([(i, f"http://a/{i}\r\nX: y", h, 1) for i, h in html.items()], "page_id long, url string, html string, digest int")
    path = new_path(spark, "test")
    warc.write_warc(warc.to_records(pages), path, bytes_per_file=300)
    rows = {r.page_id: r for r in warc.read_warc(spark, path, verify=True).where("record_type <> 'warcinfo'").collect()}
    for i, h in html.items():
        data = (h or "").encode()
        later = [j for j, g in html.items() if (g or "") == (h or "") and j > i]
        assert rows[i].payload_digest == base64.b32encode(hashlib.sha1(data).digest()).decode() and rows[i].payload_bytes == len(data)
        assert (rows[i].record_type, rows[i].refers_to) == (("revisit", max(later)) if later else ("response", None))
        assert rows[i].payload == (None if later else data) and rows[i].target_uri == f"http://a/{i}  X: y"
    some = warc.read_warc(spark, path, ("page_id", "record_type")).where("record_type = 'revisit'")
    assert "revisit" in some._jdf.queryExecution().toString() and sorted(r.page_id for r in some.collect()) == [1, 2, 3]
    assert warc.read_warc(spark, path).where("record_type = 'warcinfo'").count() >= 2


def test_warc_repeated_and_null_ids(spark):
    rows = [(1, "same"), (1, "same"), (2, "same"), (2, "same"), (None, "same"), (3, "short")]
    pages = spark.createDataFrame([(i, None, h) for i, h in rows], "page_id long, url string, html string")
    kinds = lambda least: sorted((r.page_id or 0, r.record_type, r.refers_to) for r in warc.to_records(pages, least_bytes=least).collect())
    assert kinds(0) == [(0, "response", None), (1, "revisit", 2), (1, "revisit", 2), (2, "response", None), (2, "response", None), (3, "response", None)]
    assert {k for _, k, _ in kinds(5)} == {"response"}


def test_warc_keeps_payloads_whose_digests_share_bits(spark):
    rows = [(i, f"twice {i // 2}") for i in range(400)] + [(1000 + i, f"once {i}") for i in range(300)] + [(2000, None), (None, "once 1"), (None, "null id")]
    pages = spark.createDataFrame([(i, "http://a", h) for i, h in rows], "page_id long, url string, html string")
    for bits in (6, 9):
        path = new_path(spark, "test")
        warc.write_warc(warc.to_records(pages, map_bits=bits), path)
        got = warc.read_warc(spark, path, verify=True).where("record_type in ('response', 'revisit')").collect()
        assert len(got) == len(rows) and {r.page_id: r.payload for r in got if r.page_id and r.page_id >= 1000} == {i: (h or "").encode() for i, h in rows if i and i >= 1000}
        assert all((r.record_type, r.refers_to) == (("revisit", r.page_id + 1) if r.page_id % 2 == 0 else ("response", None)) for r in got if r.page_id is not None and r.page_id < 400)
    with pytest.raises(ValueError):
        warc.page_record({"record_type": "response", "payload": None, "payload_bytes": 3, "page_id": 1, "refers_to": None, "date": "", "target_uri": "", "payload_digest": ""})


def test_warc_archives_of_others(spark, tmp_path):
    http = b"HTTP/1.1 200 OK\r\nServer: x\r\n\r\n<html>"
    def record(version, headers, block):
        return f"WARC/{version}\r\n{headers}content-length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"
    records = [
        record("1.0", "WARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:1>\r\n", b"software: y\r\n"),
        record("1.0", "warc-type: request\r\nWARC-Record-ID: <urn:uuid:2>\r\n", b"GET / HTTP/1.1\r\n\r\n"),
        record("1.0", "WARC-Type: response\r\nWARC-Record-ID: <urn:uuid:3>\r\nWARC-Target-URI: http://a/\r\n b\r\nContent-Type: application/http; msgtype=response\r\n", http),
        record("1.1", "WARC-Type: resource\r\nWARC-Record-ID: <urn:uuid:4>\r\n", b"z" * 2_500_000),
        record("1.1", "WARC-Type: revisit\r\nWARC-Record-ID: <urn:uuid:5>\r\nWARC-Refers-To: <urn:uuid:3>\r\n", b""),
    ]
    for name, data in (("plain", b"".join(records)), ("members", b"".join(map(gzip.compress, records))), ("whole", gzip.compress(b"".join(records)))):
        (tmp_path / name).mkdir()
        (tmp_path / name / "a.warc").write_bytes(data)
        got = {r.record_id[-2]: r for r in warc.read_warc(spark, f"file://{tmp_path}/{name}").collect()}
        assert [got[k].record_type for k in "12345"] == ["warcinfo", "request", "response", "resource", "revisit"]
        assert got["3"].payload == b"<html>" and got["3"].target_uri == "http://a/ b" and got["3"].page_id is None and got["3"].payload_bytes == 6
        assert got["3"].payload_digest == base64.b32encode(hashlib.sha1(b"<html>").digest()).decode() and len(got["4"].payload) == 2_500_000
        assert got["5"].refers_to_id == "<urn:uuid:3>" and got["5"].payload is None
        few = warc.read_warc(spark, f"file://{tmp_path}/{name}", ("record_id",)).where("record_id = '<urn:uuid:5>'").collect()
        assert [r.record_id for r in few] == ["<urn:uuid:5>"]
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "a.warc.gz").write_bytes(gzip.compress(b"".join(records))[:-400])
    with pytest.raises(Exception, match="breaks off"):
        warc.read_warc(spark, f"file://{tmp_path}/bad").collect()


def test_warc_of_no_pages(spark):
    path = new_path(spark, "test")
    warc.write_warc(warc.to_records(spark.createDataFrame([], "page_id long, url string, html string")), path)
    assert warc.read_warc(spark, path).count() == 0


# 5 ----------------------------------------------------------------------------------------------------------------

def test_water_filling_meets_the_budget(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 1000), (None, 400), ("c", 0), ("d", 300)], "source string, source_size long")
    t = {r.source: r.target for r in mixing.water_fill(sizes).collect()}
    assert abs(sum(t.values()) - 1.5 * 1710) < 1e-6 and t["a"] == 20 and t["c"] == 0


def test_mix_takes_its_targets_and_reruns_agree(spark):
    d = spark.createDataFrame([(i, "w " * (i % 50 + 1), [None, "a", "b", "b", "b"][i % 5], 0) for i in range(500)], "doc_id long, text string, source string, size int")
    a = mixing.mix(d).collect()
    b = mixing.mix(d.repartition(13)).collect()
    assert sorted((r.doc_id, r.taken) for r in a) == sorted((r.doc_id, r.taken) for r in b)
    taken, target = Counter(), {}
    for r in a:
        taken[r.source] += r.taken
        target[r.source] = r.target
        assert r.taken <= 2 * r.size
    assert all(abs(taken[s] - target[s]) <= 1 for s in target)


@pytest.mark.parametrize("f", [lambda d: mixing.mix(d), lambda d: minhash.near_duplicates(d), lambda d: licenses.scan_licenses(d), lambda d: suffix_tree.score(d),
                               lambda d: packing.pack(d, queries.tokenizer_path()), lambda d: pii.find_pii(d)])
def test_empty_tables_and_odd_rows(spark, f):
    assert f(docs(spark, []).where("doc_id is not null")).count() == 0
    assert f(docs(spark, ODD, [0, 1, 2, 3, 3, None, None])).count() >= 7


def test_odd_rows_have_defined_results(spark):
    d = docs(spark, ODD, [0, 1, 2, 3, 3, None, None])
    order = lambda rows: sorted(rows, key=lambda r: tuple((x is None, x) for x in r))
    got = order((r.doc_id, r.size, r.taken) for r in mixing.mix(d).collect())
    assert [x[:2] for x in got] == [(0, 0), (1, 0), (2, 1), (3, 6), (3, 6), (None, 4), (None, 30_000)] and got[0][2] == got[1][2] == 0
    got = order((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(d, size=4).collect())
    assert got == [(0, 0, 0, True), (1, 0, 1, True), (2, 1, 2, True), (3, 3, 3, True), (3, 3, 3, True), (None, 1, None, True), (None, 1, None, True)]
    got = order((r.doc_id, r.n_words, r.n_base, r.labels) for r in licenses.scan_licenses(d).collect())
    assert got == [(0, 0, 0, ""), (1, 0, 0, ""), (2, 1, 0, ""), (3, 6, 0, ""), (3, 6, 0, ""), (None, 4, 0, ""), (None, 30_000, 0, "")]
    got = order((r.doc_id, r.n_tokens) for r in suffix_tree.score(d).collect())
    assert got == [(0, 1), (1, 1), (2, 2), (3, 7), (3, 7), (None, 5), (None, 30_001)]


# 6 ----------------------------------------------------------------------------------------------------------------

def test_suffix_tree_base_and_gain(spark):
    texts = [("left right " if i % 2 else "up down ") * 40 for i in range(200)] + [None, "Never seen"]
    got = {r.doc_id: r for r in suffix_tree.score(docs(spark, texts)).collect()}
    words = [[*(t or "").lower().split(), ""] for t in texts]
    train = Counter(w for i, ws in enumerate(words) if zlib.crc32(str(i).encode()) % 5 != 1 for w in ws)
    n, v = sum(train.values()), len(train)
    for i, ws in enumerate(words):
        want = sum(math.log10((train[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws)
        assert abs(got[i].base_score - want) < 1e-6 * max(1, abs(want)) and got[i].n_tokens == len(ws) and got[i].train_tokens == n
        assert got[i].n_known == sum(train[w] > 0 for w in ws) and got[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 1)
    assert all(got[i].score > got[i].base_score + 10 for i in range(200))


def brute_tree(texts):
    """States {context: factor} and entries {(context, word): gain}, log10, from plain counts."""
    s = suffix_tree
    words = [[*t.lower().split(), ""] for t in texts]
    count = Counter(w for ws in words for w in ws)
    n, v = sum(count.values()), len(count)
    root = lambda w: math.log10((count[w] + 0.5) / (n + 0.5 * (v + 1)))
    before, states, entries = {(w,): root(w) for w, c in count.items() if c >= s.LEAST_COUNT}, {}, {}
    for d in range(1, s.DEPTH + 1):
        seen, total = Counter(), Counter()
        for ws in words:
            for i in range(len(ws) - d):
                total[tuple(ws[i : i + d])] += 1
                seen[tuple(ws[i : i + d + 1])] += 1
        found, now = defaultdict(list), {}
        for g, k in seen.items():
            if k >= s.LEAST_COUNT and total[g[:-1]] >= s.LEAST_STATE and g[1:] in before:
                q = 10 ** before[g[1:]]
                p = (k + s.SMOOTHING * q) / (total[g[:-1]] + s.SMOOTHING)
                found[g[:-1]].append((g, k, q, p, k * math.log(p / q)))
        for ctx, rows in found.items():
            some = [r for r in rows if r[4] >= s.DIVERGENCE]
            rest_n, q = total[ctx] - sum(r[1] for r in some), sum(r[2] for r in some)
            rest = (rest_n / max(1 - q, 1e-9) + s.SMOOTHING) / (total[ctx] + s.SMOOTHING)
            kept = some and sum(r[4] for r in some) + rest_n * math.log(rest) >= s.DIVERGENCE * (len(some) + 1)
            if kept:
                states[ctx] = math.log10(rest)
            for g, k, q, p, gain in rows:
                parent = before[g[1:]]
                if kept and gain >= s.DIVERGENCE:
                    now[g] = math.log10(p)
                    entries[g] = now[g] - parent - states[ctx]
                else:
                    now[g] = parent + (states[ctx] if kept else 0.0)
        before = now
    def score(text):
        ws = [*text.lower().split(), ""] if isinstance(text, str) else text
        out = sum(map(root, ws))
        for d in range(1, s.DEPTH + 1):
            out += sum(states.get(tuple(ws[i : i + d]), 0.0) + entries.get(tuple(ws[i : i + d + 1]), 0.0) for i in range(len(ws) - d))
        return out
    return score, states, count


def phrases(seed, n):
    rng = np.random.default_rng(seed)
    words = [f"w{i}" for i in range(60)]
    some = [" ".join(rng.choice(words, 7)) for _ in range(12)]
    return [" ".join([some[rng.integers(12)] if rng.random() < 0.4 else words[min(59, int(rng.exponential(12)))] for _ in range(40)]) for _ in range(n)]


def test_suffix_tree_against_brute_force(spark, monkeypatch):
    texts = phrases(6, 150) + ["", "never seen w1 w2"]
    train = [t for i, t in enumerate(texts) if zlib.crc32(str(i).encode()) % 5 != 1]
    score, states, _ = brute_tree(train)
    assert {len(c) for c in states} >= {1, 2, 3}
    d = docs(spark, texts)
    for words, cache, hot in ((1 << 20, 1 << 20, 1 << 18), (3, 2, 50), (0, 0, 1 << 18)):  # what tasks hold does not enter the result
        monkeypatch.setattr(suffix_tree, "CACHE_WORDS", words)
        monkeypatch.setattr(suffix_tree, "CACHE", cache)
        monkeypatch.setattr(suffix_tree, "HOT", hot)
        monkeypatch.setattr(suffix_tree, "BUCKET", 500)
        got = {r.doc_id: r.score for r in suffix_tree.score(d).collect()}
        assert all(abs(got[i] - score(t)) < 1e-6 for i, t in enumerate(texts))


def test_suffix_tree_distributions_sum_to_one():
    score, states, count = brute_tree(phrases(7, 150))
    for ctx in list(states)[:40]:
        before = score(list(ctx))
        after = [10 ** (score([*ctx, w]) - before) for w in [*count, "unknown"]]
        assert abs(sum(after) - 1) < 1e-6


def test_tokens_and_hashes_follow_white_space(monkeypatch):
    texts = [b"", b"One  two\x0bONE\x1ctwo", b" \t", "é w\u00a0x".encode(), b"z" * 10_000 + b" y"]
    for chunk in (1, 7, 1 << 20):
        monkeypatch.setattr(hashes, "CHUNK", chunk)
        h, ends = suffix_tree.tokens(texts)
        words = [[*t.lower().split(), None] for t in texts]
        assert ends.tolist() == np.cumsum([len(w) for w in words]).tolist()
        seen = {}
        for w, x in zip([w for ws in words for w in ws], h.tolist(), strict=True):
            assert seen.setdefault(w, x) == x
        assert len(set(seen.values())) == len(seen) and seen[None] == 1


def test_suffix_tree_keeps_states_by_evidence_whatever_the_corpus(spark):
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(3000)]
    texts = [" ".join(rng.choice(words, 400)) for _ in range(250)]
    for i in range(24):  # each of these words is a small share of all tokens
        texts[i * 10] += " seldom seen pair"
    texts += ["seldom seen pair"] * 2
    got = {r.doc_id: (r.base_score, r.score) for r in suffix_tree.score(docs(spark, texts)).collect()}
    assert got[250][1] > got[250][0] + 1.5


# 7 ----------------------------------------------------------------------------------------------------------------

def test_restoring_disguised_words(spark):
    text = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text")
    m = toxicity.CharModel(toxicity.char_counts(text))
    for disguised in ("1d10t", "idiooooot", "id*iot", "!diot"):
        assert toxicity.restore(disguised, m) == "idiot"
    assert toxicity.restore("the,", m) == "the" and toxicity.restore("", m) == ""
    for spelled in ("an i d i o t", "he is a i d i o t ok", "x 1 d 1 0 t", "i. d. i. o. t."):
        assert "idiot" in toxicity.spelled(spelled, m)
    words = toxicity.Words([b"", b"a b", b"you i d i o t", b"the 1d10t"], m)
    assert {(i, w) for i, w in words.spelled} >= {(2, "idiot")} and {i for i, _ in words.spelled} <= {1, 2}


def brute_decode(token, m):
    """All readings of a token by enumeration."""
    import itertools
    import re

    ways = []
    for run in re.finditer(r"(.)\1*", token):
        x, long, own = run[1], len(run[0]) > 1, []
        cost = 0.0 if x.isalpha() else toxicity.SIGN_COST
        for letter in [x] if x.isalpha() else toxicity.STANDS_FOR.get(x, ""):
            own += [(letter, cost + toxicity.RUN_COST), (letter * 2, cost + toxicity.RUN_COST)] if long else [(letter, cost)]
        own += [("", toxicity.DROP_COST)] if x in toxicity.BETWEEN else []
        own += [] if x.isalpha() else [(run[0], 3 * toxicity.SIGN_COST)]
        ways.append(own)
    best = {}
    for path in itertools.product(*ways):
        word = "".join(w for w, _ in path)
        cost = sum(c for _, c in path) + m.step((0, 0), word + " ")[0]
        best[word] = min(cost, best.get(word, cost))
    return best


def test_decoding_against_all_readings(spark):
    text = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text")
    m = toxicity.CharModel(toxicity.char_counts(text))
    for token in ("1d10t", "st00pid", "f00l", "b4-d", "$h!!t", "a1l1", "x.y.z", "wh4t3v3r", "looo0ser"):
        best = brute_decode(token, m)
        got = m.decode(token)
        assert abs(best[got] - min(best.values())) < 1e-9


def test_restoring_long_runs_hyphens_and_spelling_before_punctuation(spark):
    text = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text")
    m = toxicity.CharModel(toxicity.char_counts(text))
    assert toxicity.restore("idi" + 45 * "o" + "t", m) == "idiot" and toxicity.restore("stu-pid", m) == "stupid"
    assert "idiot" in toxicity.spelled("i-d-i-o-t,", m) and "idiot" in toxicity.spelled("you i d i o t.", m)


def test_no_token_takes_more_than_time_in_proportion(spark):
    import time

    rng = np.random.default_rng(1)
    m = toxicity.CharModel(np.ones(32768))
    for token in ("".join(map(chr, rng.integers(97, 123, 1_000_000))), "a" + "." * 1_000_000 + "b", "-" * 1_000_000, "-" * 200 + "word", "- " * 100 + "word"):
        start = time.process_time()
        words = toxicity.Words([f"a b {token} c d word".encode()], m)
        assert len(words.restored(np.arange(len(words.keys)), m)) == len(words.keys) and time.process_time() - start < 4


def test_toxicity_scores_against_plain_features(spark):
    rng = np.random.default_rng(2)
    bad, good = ["idiot", "moron"], ["the", "house", "stands", "on", "hill", "green"]
    texts = [" ".join(rng.choice(good, 9)) + (" " + str(rng.choice(bad)) if i % 3 == 0 else "") for i in range(400)] + ODD
    d, labels = docs(spark, texts), spark.createDataFrame([(i, int(i < 400 and i % 3 == 0)) for i in range(len(texts))], "doc_id long, toxic int")
    scorer = toxicity.learn(d.select("doc_id", "text"), labels)
    got = {r.doc_id: (r.score, r.predicted) for r in toxicity.score_toxicity(d, labels).collect()}
    for i, text in enumerate(texts):
        words = {w.translate(toxicity_lower) for w in re.findall(r"[^\x20\x09-\x0D]+", text or "")}
        every = [toxicity.restore(w.lower(), scorer.model) for w in words] + toxicity.spelled(text or "", scorer.model)
        z = sorted((max([0.0, *(float(scorer.weights[b]) for b in plain_buckets(w))]) for w in every), reverse=True)
        top = [x for x in z[:8] if x > 0] + [0.0] * 8
        x = [1, top[0], sum(top[:3]) / 3, sum(top[:8]) / 8, math.log1p(sum(v > 3 for v in z)), math.log1p(sum(v > 4.5 for v in z)), sum(v > 3 for v in z) / max(len(z), 1)]
        want = 1 / (1 + math.exp(-min(30, max(-30, float(np.dot(x, scorer.beta))))))
        assert abs(got[i][0] - want) < 1e-6 and got[i][1] == (want >= 0.3)
    assert sum(got[i][1] for i in range(400)) == 134


toxicity_lower = {65 + k: 97 + k for k in range(26)}


def plain_buckets(word):
    """Buckets of a word whole, of its beginnings of 3 to 6 bytes and of its inner pieces of 5, with the hash of bytes spelled out."""
    b, full = word.encode(), (1 << 64) - 1
    pieces = [(b, 1)] * bool(b) + [(b[:k], 2) for k in (3, 4, 5, 6) if len(b) > k] + [(b[k : k + 5], 3) for k in range(1, len(b) - 4)]
    for piece, kind in pieces:
        h = (sum(int(hashes.LETTERS[x]) * pow(0x9E3779B97F4A7C13, k, 1 << 64) for k, x in enumerate(piece)) + kind) * 0x9E3779B97F4A7C15 & full
        yield int(hashes.mix(np.array([h], np.uint64))[0]) % toxicity.BUCKETS


def test_toxicity_of_an_empty_table_and_of_kept_columns(spark):
    labels = spark.createDataFrame([(1, 1)], "doc_id long, toxic int")
    assert toxicity.score_toxicity(docs(spark, []), labels).count() == 0
    kept = toxicity.score_toxicity(docs(spark, ["a b"]), labels, keep=("lang", "n", "rep"))
    assert kept.columns[-3:] == ["lang", "n", "rep"] and kept.first().rep == 9


def test_toxicity_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    r = queries.op7_toxicity(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").select("predicted", "toxic").collect()
    hits = sum(x.predicted and x.toxic for x in r)
    assert hits / sum(x.predicted for x in r) > 0.8 and hits / sum(x.toxic for x in r) > 0.6


def test_toxicity_without_labels(spark):
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert [r.predicted for r in toxicity.score_toxicity(docs(spark, ODD), labels).collect()] == [0] * len(ODD)


# 8 ----------------------------------------------------------------------------------------------------------------

def test_licenses(spark):
    texts = ["Released under the MIT License.", "no license", "licensed under CC BY-NC 4.0", "Apache\nLICENSE mit license", None, "pad " * 100 + "licensed under the apache license version 2.0 " + "pad " * 100]
    got = {r.doc_id: r for r in licenses.scan_licenses(docs(spark, texts)).collect()}
    assert (got[0].labels, got[0].base_labels, got[0].first_word, got[0].score) == ("mit", "mit", 3, 1.0)
    assert (got[1].labels, got[1].n_base, got[1].first_word, got[1].score) == ("", 0, None, 0.0)
    assert got[2].labels == "cc-by-nc" and got[2].base_labels == "" and got[2].score >= 0.8
    assert (got[3].base_labels, got[3].first_word, got[3].last_word) == ("apache,mit", 0, 2)
    assert got[4].n_words == 0 and "apache" in got[5].labels


def test_related_licenses_are_told_apart(spark):
    texts = {
        "released under the Apache license, version 2.0": "apache", "Licensed under CC BY 4.0": "cc-by", "Licensed under CC BY-SA 4.0": "cc-by-sa",
        "licensed under the Mozilla license version 2 0 the file": "", "all men have rights, and he reserved a table": "", "All rights reserved.": "",
        "licensed under the GNU Lesser General Public License version 3": "gpl",  # by the base phrase alone
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License": "cc-by-sa",
        "All rights reserved. No part of this work may be reproduced or transmitted in any form or by any means without the prior written permission of us": "proprietary",
    }
    got = [r.labels for r in licenses.scan_licenses(docs(spark, list(texts))).orderBy("doc_id").collect()]
    assert got == list(texts.values())


def test_licenses_that_wrap_over_lines_and_long_templates(spark):
    texts = [
        "Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files",
        "Redistribution and use in source and binary forms,\n# with or without\n# modification, are permitted",
        "This program is free software: you can redistribute it\nand/or modify it under the terms of\nthe GNU General\nPublic License",
        "pad\n" * 90 + "This Source Code Form is subject\nto the terms\nof the Mozilla\nPublic License",
    ]
    got = [r.labels.split(",") for r in licenses.scan_licenses(docs(spark, texts)).orderBy("doc_id").collect()]
    assert all(x in y for x, y in zip(("mit", "bsd", "gpl", "mpl"), got, strict=True))
    long = " ".join(f"t{i}" for i in range(100))
    d = docs(spark, ["pad " * 70 + long + " pad" * 70, "pad\n" * 55 + long.replace(" ", "\n"), long[:200]])
    assert [r.labels for r in licenses.scan_licenses(d, templates={"own": (long,)}).orderBy("doc_id").collect()] == ["own", "own", ""]


# 9 ----------------------------------------------------------------------------------------------------------------

def brute_groups(texts, size, percent):
    sets = {}
    for i, t in texts.items():
        w = (t or "").lower().split()
        sets[i] = {tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1))} if w else set()
    root = {i: i for i in texts}
    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a in texts:
        for b in texts:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in texts}


def test_minhash_against_brute_force(spark):
    rng = np.random.default_rng(2)
    words = [f"w{i}" for i in range(3000)]
    base = [" ".join(rng.choice(words, 150)) for _ in range(15)]
    texts = {}
    for i in range(150):
        w = base[i % 15].split()
        for k in rng.integers(0, len(w), rng.integers(0, 9)):
            w[k] = "edit%d" % rng.integers(10**6)
        texts[i] = " ".join(w)
    texts |= {200: None, 201: "", 202: "one two", 203: "One two", 204: texts[0]}
    d = docs(spark, list(texts.values()), list(texts))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(d, size=4).collect()}
    assert got == brute_groups(texts, 4, 80)


# 10 ---------------------------------------------------------------------------------------------------------------

def test_search_recall_and_exact_scores(spark):
    rng = np.random.default_rng(4)
    x = rng.standard_normal((3000, 24)).astype(np.float32)
    rows = vectors(spark, [(i, v.tolist()) for i, v in enumerate(x)] + [(9000, None), (9020, [0.0] * 24), (9040, [1.0, 2.0])])
    got = defaultdict(list)
    for r in collision_search.search(rows, rows.where("vec_id % 100 = 0"), 20, data_block=800, query_block=10).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    y = x.astype(float)
    hits = 0
    for q in range(0, 3000, 100):
        s = y @ y[q]
        s[q] = -np.inf
        best = np.lexsort((np.arange(3000), -s))[:20]
        hits += len({v for v, _ in got[q]} & set(best.tolist()))
        assert len(got[q]) == 20 and all(abs(z - s[v]) < 1e-9 for v, z in got[q]) and got[q] == sorted(got[q], key=lambda p: (-p[1], p[0]))
    assert hits >= 0.9 * 600 and set(got) == set(range(0, 3000, 100))


def test_search_of_few_rows_gives_all(spark):
    rows = vectors(spark, [(i, [1.0, float(i % 2)]) for i in range(6)])
    got = collision_search.search(rows, rows.where("vec_id = 0"), 20).orderBy("rank").collect()
    assert [r.vec_id for r in got] == [1, 2, 3, 4, 5]


def test_search_repeated_rows_ties_and_empty_tables(spark):
    rows = vectors(spark, [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (3, [2.0, 0.0]), (3, [2.0, 0.0]), (2, [2.0, 5.0]), (1, [1.0, 1.0])])
    got = collision_search.search(rows, rows.where("vec_id = 0"), 2).orderBy("rank").collect()
    assert [(r["rank"], r.vec_id, r.score) for r in got] == [(1, 2, 2.0), (2, 3, 2.0)]
    assert collision_search.search(rows.where("false"), rows.where("false")).count() == 0


def test_search_counts_each_window_once_and_misses_little(monkeypatch):
    rng, calls = np.random.default_rng(7), []
    x = rng.standard_normal((2000, 64))
    x[300:340] = x[0]  # copies, all at one place of every projection
    x /= np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]
    most, ids, axes = 1 + 1e-12, np.arange(2000), rng.standard_normal((65, collision_search.PROJECTIONS))
    count = collision_search._Index.collisions
    monkeypatch.setattr(collision_search._Index, "collisions", lambda self, h, width: calls.append(len(h)) or count(self, h, width))
    q = x[:256]
    h = np.hstack((q, np.zeros((256, 1)))) @ axes
    s = q @ x.T
    s[np.arange(256), np.arange(256)] = -np.inf

    index = collision_search._Index(collision_search._augment(x, most), axes)
    got = collision_search._batch(index, q, ids[:256], h, x, ids, 20, most)
    assert sum(len(set(r) & set(np.lexsort((ids, -s[i]))[:20])) for i, (r, _) in enumerate(got)) > 0.98 * 256 * 20 and calls == [256]
    index = collision_search._Index(collision_search._augment(x[:260], most), axes)
    assert {len(r) for r, _ in collision_search._batch(index, q, ids[:256], h, x[:260], ids[:260], 300, most)} == {259}  # fewer rows than asked for: all of them


# pipeline ---------------------------------------------------------------------------------------------------------

def test_pipeline_stages(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        path = new_path(spark, f"stage-{name}")
        stage(spark, d, SF).write.parquet(path)
        before, d = d, spark.read.parquet(path)
        seen[name] = (before, d)
        if name != "packing":
            assert d.columns == before.columns
    a, b = seen["near_dedup"]
    texts = {r.doc_id: r.text for r in a.collect()}
    want = {i for i, (_, c) in brute_groups(texts, 5, 80).items() if c == i}
    assert {r.doc_id for r in b.collect()} == want
    assert seen["pii"][1].where(F.col("text").rlike("[A-Za-z0-9]+@[A-Za-z0-9-]+[.][a-z]")).count() == 0
    words = lambda t: t.select(mixing.count_words(F.col("text")).alias("n")).agg(F.sum("n")).first()[0]
    assert abs(words(seen["mixing"][1]) - 1.5 * words(seen["mixing"][0])) <= 20
    a, b = seen["toxicity"]
    judged = {r.doc_id: r.predicted for r in toxicity.score_toxicity(a, spark.read.parquet(f"{SF}/labels.parquet")).collect()}
    assert sorted(r.doc_id for r in b.collect()) == sorted(r.doc_id for r in a.collect() if not judged[r.doc_id])
    from tokenizers import Tokenizer

    whole, got, want = Tokenizer.from_file(queries.tokenizer_path()), Counter(), Counter()
    for r in seen["packing"][0].collect():
        want[r.doc_id] += len(whole.encode(r.text or "", add_special_tokens=False).ids) + 1
    for r in seen["packing"][1].collect():
        got[r.doc_id] += r.length
    assert got == want


NAMES = ["score", "predicted", "row", "size", "taken", "pii_spans", "keep_text", "whole", "target", "x.y"]


def test_pipeline_stages_with_odd_rows_and_clashing_columns(spark):
    rows = [(0, None), (1, ""), (2, "mail x@y.zz " * 3 + "one two three four five six"), (3, "a b c d e f g"), (3, "a b c d e f g"), (4, "a b c d e f g"), (None, "a b c d e f g"), (5, "w " * 30_000)]
    d = spark.createDataFrame([(i, t, "en", "s", 0, *([k] * len(NAMES))) for k, (i, t) in enumerate(rows)], "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{n}` long" for n in NAMES))
    toxic = corpus_pipeline.drop_toxic(spark, d, SF)
    assert toxic.columns == d.columns and toxic.count() == 8
    near = corpus_pipeline.drop_near_duplicates(spark, d, SF)
    assert near.columns == d.columns and sorted((r.doc_id if r.doc_id is not None else -1, r.score) for r in near.collect()) == [(-1, 6), (0, 0), (1, 1), (2, 2), (3, 3), (5, 7)]
    pii_ = corpus_pipeline.redact_pii(spark, d, SF)
    by_score = {r.score: r for r in pii_.collect()}
    assert pii_.columns == d.columns and by_score[2].text.startswith("mail <EMAIL> mail") and by_score[2].n_chars == len(by_score[2].text) and by_score[0].text is None and by_score[0].n_chars == 0
    mixed = corpus_pipeline.mix_sources(spark, d, SF)
    out = mixed.collect()
    assert mixed.columns == d.columns and not [r for r in out if r.score in (0, 1)]
    assert abs(sum(len(r.text.split()) for r in out) - 1.5 * sum(len((t or "").split()) for _, t in rows)) <= 1
    assert max(Counter(r.score for r in out).values()) <= 2 and all(r.n_chars == len(r.text) for r in out)
    packed = corpus_pipeline.pack_sequences(spark, d, SF)
    assert packed.where("doc_id in (0, 1)").select("doc_tokens").distinct().collect()[0][0] == 1 and packed.where("doc_id = 3").agg(F.sum("length")).first()[0] == 16
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, d.where("false"), SF).count() == 0


def test_packing_words_of_letters_equal_whole_encoding():
    from tokenizers import Tokenizer

    from tessera.llm.queries import tokenizer_path

    texts = ["İstanbul iß ΣΑΣ Σ áb ́x 가 ǅ ﬁ Ⅷ x² 中文 字a don't I'M <|endoftext|> a\x01b \x01", "plain words only", "", "x\x1cy z", "aİ b"]
    whole = Tokenizer.from_file(tokenizer_path())
    want = [whole.encode(t, add_special_tokens=False).ids for t in texts]
    assert [x.tolist() for x in packing.WordEncoder(tokenizer_path())([t.encode() for t in texts])] == want


def test_packing_random_strings_equal_whole_encoding():
    from tokenizers import Tokenizer

    rng = np.random.default_rng(8)
    signs = list("aZ09.,;:!?%$#&*|'-_ \t\n") + ["İ", "ß", "Σ", "é", "e\u0301", "\u0307", "\u0338", "漢", "\U0001f600", "x", "'s", "ǅ", "가", "²", "<|", "|>", "K", "ﬁ"]
    texts = ["".join(rng.choice(signs, rng.integers(1, 14))) for _ in range(12_000)] + ["İ!", "aİ.", "İİ?!", "İ"]
    whole = Tokenizer.from_file(queries.tokenizer_path())
    want = [x.ids for x in whole.encode_batch(texts, add_special_tokens=False)]
    encode = packing.WordEncoder(queries.tokenizer_path())
    assert [x.tolist() for k in range(0, len(texts), 1000) for x in encode([t.encode() for t in texts[k : k + 1000]])] == want


def test_packing_with_a_tokenizer_of_another_kind():
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    want = [x.ids for x in Tokenizer.from_file(path).encode_batch(["A  b", "a b."], add_special_tokens=False)]
    assert [x.tolist() for x in packing.WordEncoder(path)([b"A  b", b"a b."])] == want


def test_sequences_are_written_by_length(spark):
    path = new_path(spark, "sequences")
    packing.write_sequences(packing.pack(docs(spark, ["tok " * k for k in range(1, 40)]), queries.tokenizer_path()), path)
    d = spark.read.parquet(path)
    assert d.where("length <> cast(pow(2, bucket) as long) or size(split(hex(ids), '')) <> length * 8").count() == 0
    assert d.agg(F.sum("length")).first()[0] == sum(range(2, 41))

"""Removal of repeated byte strings: suffixes sorted by induction, in buckets that Spark deals out and sorts on disk."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.hashes import LETTERS, blocks, mix, powers
from tessera.plans.lineage import cut, discard

#: Bytes of a repeated string, and of the gram that chooses where the strings around it are sorted.
LENGTH, GRAM = 100, 24
#: Bytes of text that are scanned together, and places parsed at a time.
TOGETHER, CHUNK = 1 << 21, 1 << 17
#: Rows of a batch that become Python objects together.
ROWS = 256
#: Sample substrings that leave a task together: a run of one letter has one for each byte.
TOGETHER_ROWS = 1 << 15
#: Different substrings around one gram that a task sorts together; above it the bucket is dealt anew by longer keys.
BUCKET = 2000
#: Substrings that a task sorts in one go (whole buckets).
BATCH = 20_000
#: Bits of the maps that tell the scan what may repeat. Of one size for any input: a full map lets more through, which exact joins sort out.
MAP_BITS = 26

_PLACE = np.uint64((1 << 18) - 1)


@dataclass
class Parse:
    """Sample substrings of a block of texts: text number, start in the text, number of strings, anchor's place in it, anchor's key."""

    text: np.ndarray
    start: np.ndarray
    many: np.ndarray
    anchor: np.ndarray
    key: np.ndarray


def _least(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` neighbours: a running minimum forward and one backward over segments of that width."""
    n = len(x) - width + 1
    full = np.full(-(-len(x) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    full[: len(x)] = x
    rows = full.reshape(-1, width)
    forward = np.minimum.accumulate(rows, axis=1).ravel()
    backward = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(backward[:n], forward[width - 1 : width - 1 + n])


def parse(texts: list[bytes], length: int = LENGTH, gram: int = GRAM) -> Iterator[Parse]:
    """Cut texts into sample substrings, some TOGETHER_ROWS at a time.

    Each string of ``length`` bytes has an anchor: the gram in it with the smallest hash, the first of equals. Neighbouring
    strings with the same anchor are one sample substring. Anchors depend on the strings alone, so that equal strings
    meet under equal anchors, at equal distances from them.
    """
    size = np.array([len(t) for t in texts], np.int64)
    first = np.cumsum(size + 1) - size - 1
    raw = np.frombuffer(b"\0".join([*texts, b""]), np.uint8)
    width, found, rows = length - gram + 1, [], 0
    up, down = powers(1 << (CHUNK + length).bit_length())
    for at in range(0, max(len(raw) - length + 1, 0), CHUNK):
        b = raw[at : at + CHUNK + length - 1]
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(LETTERS[b] * up[: len(b)])))
        grams = mix((sums[gram:] - sums[:-gram]) * down[: len(b) - gram + 1])
        least = _least((grams & ~_PLACE) | np.arange(len(grams), dtype=np.uint64), width)
        anchor = (least & _PLACE).astype(np.int64)
        begin = np.arange(at, at + len(anchor))
        text = np.searchsorted(first, begin, side="right") - 1
        whole = begin + length <= first[text] + size[text]
        edge = np.flatnonzero(np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1]) | (whole[1:] != whole[:-1]), [True])))
        head, many = edge[:-1], np.diff(edge)
        head, many = head[whole[head]], many[whole[head]]
        if len(head):
            found.append([text[head], begin[head] - first[text[head]], many, anchor[head] - head, grams[anchor[head]]])
            rows += len(head)
        if rows >= TOGETHER_ROWS:
            yield Parse(*(np.concatenate(x) for x in zip(*found, strict=True)))
            found, rows = [], 0
    if found:
        yield Parse(*(np.concatenate(x) for x in zip(*found, strict=True)))


def _bits(keys: DataFrame) -> np.ndarray:
    """The map with a bit set for each (bit)."""
    rows = keys.groupBy(F.shiftright("bit", 6).alias("i")).agg(F.expr("bit_or(shiftleft(1L, cast(bit & 63 AS int)))").alias("x")).toArrow()
    out = np.zeros(1 << (MAP_BITS - 6), np.uint64)
    out[rows.column("i").to_numpy()] = rows.column("x").to_numpy().view(np.uint64)
    return out


def _is_set(bits: np.ndarray, at: np.ndarray) -> np.ndarray:
    return (bits[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1


def _bit(column: str) -> Column:
    return (F.col(column).bitwiseAND((1 << MAP_BITS) - 1)).alias("bit")


def _listed(column: pa.Array) -> Iterator:
    """The column's values as Python objects, some ROWS at a time."""
    for at in range(0, len(column), ROWS):
        yield from column.slice(at, ROWS).to_pylist()


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, list[bytes]]]:
    """Ids and texts (null: empty) of a batch by blocks."""
    ids, at = batch.column(0).to_numpy(), 0
    for block in blocks(_listed(batch.column(1)), TOGETHER):
        yield ids[at : at + len(block)], block
        at += len(block)


def _anchors(length: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, block in _texts(batch):
                for p in parse(block, length, gram):
                    keys, n = np.unique(p.key.view(np.int64), return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n.astype(np.int32))], names=["key", "n"])

    return run


_NAMED = ["key", "name", "more", "doc_id", "text_hash", "start", "many", "anchor"]


def _substrings(held, length: int, gram: int, with_text: bool):
    """Rows of sample substrings whose key (or, with their texts, whose own digest) is in the map."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        some, named = held.value
        for batch in batches:
            for ids, block in _texts(batch):
                own = np.array([xxhash.xxh3_64_intdigest(t) for t in block], np.uint64).view(np.int64)
                for p in parse(block, length, gram):
                    kept = np.flatnonzero(_is_set(some, p.key.view(np.int64) & ((1 << MAP_BITS) - 1)))
                    stop = p.start[kept] + p.many[kept] + length - 1
                    pieces = [block[t][a:b] for t, a, b in zip(p.text[kept].tolist(), p.start[kept].tolist(), stop.tolist(), strict=True)]
                    names = np.frombuffer(b"".join(xxhash.xxh3_128_digest(x) for x in pieces), np.int64).reshape(-1, 2)
                    if with_text:
                        chosen = np.flatnonzero(_is_set(named, names[:, 0] & ((1 << MAP_BITS) - 1)))
                        kept, names, pieces = kept[chosen], names[chosen], [pieces[k] for k in chosen.tolist()]
                    if not len(kept):
                        continue
                    of = p.text[kept]
                    columns = [p.key[kept].view(np.int64), names[:, 0], names[:, 1], ids[of], own[of], p.start[kept], p.many[kept], p.anchor[kept]]
                    arrays = [pa.array(c) for c in columns]
                    if with_text:
                        yield pa.RecordBatch.from_arrays([*arrays, pa.array(pieces, pa.binary())], names=[*_NAMED, "text"])
                    else:
                        yield pa.RecordBatch.from_arrays(arrays, names=_NAMED)

    return run


def _join(lcp: np.ndarray, kept: np.ndarray) -> np.ndarray:
    """Common prefixes of neighbours after rows between them are gone."""
    if not len(kept):
        return lcp[:0]
    return np.minimum.reduceat(lcp[: kept[-1] + 1], np.concatenate(([0], kept[:-1] + 1)))


def induce(key: np.ndarray, texts: list[bytes], anchor: np.ndarray, many: np.ndarray, order: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, string) of all strings of the sample substrings that another one holds with a smaller ``order``.

    Rows come sorted by key and by what stands from the anchor on. From the sorted suffixes at the anchors, those one byte to the left are
    induced: a stable sort by the byte before moves each tuple of (row, common prefix with the one before it) into its
    bucket, and the common prefix of new neighbours is one more than the least between their old places. Strings are equal
    where that reaches ``length``. Rows that cannot reach it any more leave.
    """
    size = np.array([len(t) for t in texts], np.int64)
    first = np.cumsum(size) - size
    data = np.frombuffer(b"".join(texts), np.uint8)
    right = size - anchor
    rows, most = len(texts), int(right.max())
    lcp = np.zeros(rows, np.int64)
    for at in range(0, rows - 1, 4096):  # of neighbours at their anchors
        some = np.arange(at, min(at + 4096, rows - 1) + 1)
        m = np.zeros((len(some), most), np.int16)
        m[:] = -1 - (some[:, None] & 1)
        inside = np.arange(most) < right[some][:, None]
        m[inside] = data[((first + anchor)[some][:, None] + np.arange(most))[inside]]
        differ = m[1:] != m[:-1]
        lcp[some[1:]] = np.where(differ.any(axis=1), differ.argmax(axis=1), most)
    lcp[1:][key[1:] != key[:-1]] = 0
    row, out_row, out_string = np.arange(rows), [], []
    bucket = np.cumsum(np.concatenate(([0], key[1:] != key[:-1])))
    for back in range(int(anchor.max()) + 1):
        if back:
            near = np.maximum(lcp, np.append(lcp[1:], 0))
            kept = np.flatnonzero((anchor[row] >= back) & (near + anchor[row] - back + 1 >= length))
            lcp, row = _join(lcp, kept), row[kept]
            if len(row) < 2:
                break
            code = (bucket[row] << 8) | data[first[row] + anchor[row] - back]
            by = np.argsort(code, kind="stable")
            same = code[by][1:] == code[by][:-1]
            pairs = np.column_stack((by[:-1][same] + 1, by[1:][same] + 1)).ravel()
            new = np.zeros(len(row), np.int64)
            if len(pairs):
                new[1:][same] = 1 + np.minimum.reduceat(np.append(lcp, 0), pairs)[::2]
            lcp, row = new, row[by]
        group = np.cumsum(lcp < length)
        least = np.full(int(group[-1]) + 1, np.iinfo(np.int64).max)
        np.minimum.at(least, group, order[row])
        again = (order[row] > least[group]) & (anchor[row] >= back) & (anchor[row] - many[row] < back)
        out_row.append(row[again])
        out_string.append(anchor[row[again]] - back)
    if not out_row:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(out_row), np.concatenate(out_string)


def _runs(doc, own, start, rows: np.ndarray, strings: np.ndarray, length: int) -> pa.RecordBatch:
    """Byte runs that the strings cover, one row for neighbouring strings."""
    by = np.lexsort((strings, rows))
    rows, strings = rows[by], strings[by]
    edge = np.flatnonzero(np.concatenate(([True], (rows[1:] != rows[:-1]) | (strings[1:] != strings[:-1] + 1), [True]))) if len(rows) else np.zeros(1, np.int64)
    head, tail = edge[:-1], edge[1:] - 1
    of = rows[head]
    return pa.RecordBatch.from_arrays(
        [pa.array(doc[of]), pa.array(own[of]), pa.array(start[of] + strings[head]), pa.array(start[of] + strings[tail] + length)],
        names=["doc_id", "text_hash", "begin", "end"])


def _induced(length: int):
    """Whole buckets of sorted sample substrings, some BATCH rows at a time."""

    def work(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(parts)
        key, doc, own, start, many, anchor = (t.column(c).to_numpy() for c in ("key", "doc_id", "text_hash", "start", "many", "anchor"))
        _, order = np.unique(np.rec.fromarrays([doc, own, start + anchor]), return_inverse=True)
        rows, strings = induce(key, t.column("text").to_pylist(), anchor, many, order, length)
        return _runs(doc, own, start, rows, strings, length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            key = batch.column(0).to_numpy()
            if n >= BATCH and len(key):
                last = held[-1].column(0)[-1].as_py()
                new = int(np.argmax(key != last)) if (key != last).any() else len(key)
                held.append(batch.slice(0, new))
                n += new
                if new < len(key):
                    yield work(held)
                    held, n = [batch.slice(new)], len(key) - new
                continue
            if len(key):
                held.append(batch)
                n += len(key)
        if n:
            yield work(held)

    return run


def repeated_runs(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, bucket: int = BUCKET) -> DataFrame:
    """Rows (doc_id, text_hash, begin, end) of (doc_id, text): runs of bytes covered by strings that also start earlier.

    1. Texts are parsed into sample substrings (:func:`parse`), and anchors are counted. What stands around an anchor that occurs
       once is not repeated.
    2. Sample substrings get names: equal ones have one, that of the first. All strings of the others are repeats.
    3. Differing ones around one anchor are a bucket, sorted from the anchor on by Spark, which spills to disk. Within a bucket the
       suffixes to the left are induced with their common prefixes (:func:`induce`).
    4. A bucket of more than ``bucket`` names recurs: its substrings are cut at halved distances from the anchor and dealt by
       what all strings of a part have in common, which grows until it is the whole string.
    """
    d = docs.where("doc_id is not null and octet_length(text) >= " + str(length)).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    spark, empty = docs.sparkSession, np.zeros(1 << (MAP_BITS - 6), np.uint64)
    anchors = d.mapInArrow(_anchors(length, gram), "key long, n int").groupBy("key").agg(F.sum("n").alias("n")).where("n > 1")
    anchors = cut(anchors.select("key"), "anchors")
    some = spark.sparkContext.broadcast((_bits(anchors.select(_bit("key"))), empty))
    schema = "key long, name long, more long, doc_id long, text_hash long, start long, many long, anchor long"
    places = cut(d.mapInArrow(_substrings(some, length, gram, False), schema), "places")
    discard(anchors)
    at = F.struct("doc_id", "text_hash", "start")
    named = cut(places.groupBy("key", "name", "more").agg(F.min(at).alias("first"), F.count("*").alias("n")), "named")
    marks = _later(places, named, ["key", "name", "more"], length)
    several = named.groupBy("key").agg(F.count("*").alias("names")).where("names > 1")
    firsts = cut(named.join(several, "key").select("key", "name", "more", "first", "names"), "firsts")
    known = spark.sparkContext.broadcast((some.value[0], _bits(firsts.select(_bit("name")))))
    texts = d.mapInArrow(_substrings(known, length, gram, True), schema + ", text binary")
    one = firsts.select("key", "name", "more", "first.*", "names")
    here = cut(texts.join(one, ["key", "name", "more", "doc_id", "start", "text_hash"]).dropDuplicates(["key", "name", "more"]).drop("name", "more"), "substrings")
    marks, written, span = [marks], [here], 1 << (length - gram).bit_length()
    while True:
        cold = here.where(F.col("names") <= bucket)
        cold = cold.select("key", "doc_id", "text_hash", "start", "many", "anchor", "text", F.expr("substring(text, cast(anchor + 1 AS int))").alias("right"))
        cold = cold.repartition("key").sortWithinPartitions("key", "right").drop("right")
        marks.append(cold.mapInArrow(_induced(length), "doc_id long, text_hash long, begin long, end long"))
        hot = here.where(F.col("names") > bucket)
        if hot.isEmpty():
            break
        span //= 2
        parts = _cut_up(hot, span, length)
        named = cut(parts.groupBy("key", "text").agg(F.min(at).alias("first"), F.count("*").alias("n"), F.first("many").alias("many"), F.first("anchor").alias("anchor")), "named")
        marks.append(_later(parts, named, ["key", "text"], length))
        several = named.groupBy("key").agg(F.count("*").alias("names")).where("names > 1")
        here = cut(named.join(several, "key").select("key", "text", "many", "anchor", "first.*", "names"), "substrings")
        written.append(here)
    out = marks[0]
    for m in marks[1:]:
        out = out.unionByName(m)
    return out


def _later(places: DataFrame, named: DataFrame, by: list[str], length: int) -> DataFrame:
    """All strings of sample substrings that are not the first with their name."""
    again = named.where("n > 1").select(*by, "first")
    both = places.join(again, by).where("(doc_id, text_hash, start) > (first.doc_id, first.text_hash, first.start)")
    return both.select("doc_id", "text_hash", F.col("start").alias("begin"), (F.col("start") + F.col("many") - 1 + length).alias("end"))


def _cut_up(rows: DataFrame, span: int, length: int) -> DataFrame:
    """Sample substrings cut so that each part's strings begin within one range of ``span`` distances before the anchor; the
    new key is the old one, the range and the bytes that all strings of the range hold."""
    lo, hi = F.col("anchor") - F.col("many") + 1, F.col("anchor")
    part = rows.withColumn("s", F.explode(F.sequence((lo / span).cast("long"), (hi / span).cast("long")))).withColumn("s", F.col("s") * span)
    part = part.withColumn("from", F.least("anchor", F.col("s") + span - 1)).withColumn("to", F.greatest(lo, "s"))
    skip = F.col("anchor") - F.col("from")
    part = part.withColumn("skip", skip).withColumn("left", F.col("from") - F.col("to") + 1)
    text = F.expr(f"substring(text, cast(skip + 1 AS int), cast(left + {length - 1} AS int))")
    core = F.expr(f"substring(text, cast(anchor - s + 1 AS int), {length - span + 1})")
    return part.select(
        F.xxhash64("key", "s", core).alias("key"), "doc_id", "text_hash", (F.col("start") + F.col("skip")).alias("start"), F.col("left").alias("many"), F.col("from").alias("anchor"), text.alias("text"))


_DONE = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What is left of (doc_id, text[, runs])."""
    for batch in batches:
        out = []
        for doc, text, *runs in zip(*map(_listed, batch.columns), strict=True):
            text, kept, at, spans, gone = text or b"", hashlib.sha256(), 0, 0, 0
            end = -1
            for begin, stop in sorted((r["begin"], r["end"]) for r in (runs and runs[0]) or ()):
                if begin > end:
                    kept.update(text[max(at, 0) : begin])
                    spans += 1
                    end = begin
                gone += max(0, stop - end)
                end = at = max(end, stop)
            kept.update(text[at:])
            out.append((doc, len(text), gone, spans, kept.hexdigest()))
        columns = list(zip(*out, strict=True)) if out else [[]] * 5
        kinds = [pa.int64()] * 4 + [pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=[c.split()[0] for c in _DONE.split(", ")])


def _marked(held, batch: pa.RecordBatch) -> np.ndarray:
    """Which rows of (doc_id, text, bit) may have a run."""
    return _is_set(held.value, batch.column(2).to_numpy()) & batch.column(0).is_valid().to_numpy(False)


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, bucket: int = BUCKET) -> DataFrame:
    """One row per document of (doc_id, text): doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    Every byte goes that a string of ``length`` bytes covers which also starts earlier: in a document with a smaller id, or in the same one.
    Strings are judged on the input. Null texts are empty; texts shorter than ``length`` stay whole, very long ones are parsed piece by
    piece. Rows with a null id have no order: they stay whole, and nothing is removed for their sake. Rows that share an id and
    a text are one document and lose the same; several texts of one id stand in the order of their hashes. Extra columns are not read. An empty table gives no rows.

    Texts without a mark are finished where they are read, by a map of ids of one size; the others meet their runs by a join. No task
    chains two functions: each would keep a Python worker of its own.
    """
    runs = cut(repeated_runs(docs, length, gram, bucket), "runs")
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    d = d.withColumn("bit", F.xxhash64("doc_id").bitwiseAND((1 << MAP_BITS) - 1))
    held = docs.sparkSession.sparkContext.broadcast(_bits(runs.select(F.xxhash64("doc_id").bitwiseAND((1 << MAP_BITS) - 1).alias("bit"))))

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _finish(pa.RecordBatch.from_arrays(b.columns[:2], names=["doc_id", "text"]).filter(pa.array(~_marked(held, b))) for b in batches)

    def with_marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            some = batch.filter(pa.array(_marked(held, batch)))
            own = np.array([xxhash.xxh3_64_intdigest(t or b"") for t in _listed(some.column(1))], np.uint64)
            yield pa.RecordBatch.from_arrays([some.column(0), some.column(1), pa.array(own.view(np.int64))], names=["doc_id", "text", "text_hash"])

    by_text = runs.groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("begin", "end")).alias("runs"))  # of one text
    marked = d.mapInArrow(with_marks, "doc_id long, text binary, text_hash long").join(by_text.hint("merge"), ["doc_id", "text_hash"], "left").select("doc_id", "text", "runs")
    return d.mapInArrow(clean, _DONE).unionByName(marked.mapInArrow(_finish, _DONE))


REPEATS_SQL = r"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
c AS (SELECT doc_id, n, 512 * k AS pos, substr(x, CAST(1024 * k + 1 AS BIGINT), 1224) AS y FROM (SELECT doc_id, x, n, unnest(range(0, (n + 511) // 512)) AS k FROM d)),
w AS (SELECT doc_id, pos + j AS s, md5(substr(y, CAST(2 * j + 1 AS BIGINT), 200)) AS g FROM (SELECT doc_id, n, pos, y, unnest(range(0, 512)) AS j FROM c) WHERE pos + j + 100 <= n),
r AS (SELECT doc_id, s FROM (SELECT doc_id, s, row_number() OVER (PARTITION BY g ORDER BY doc_id, s) AS k FROM w) WHERE k > 1),
i AS (SELECT doc_id, s, sum(CASE WHEN s <= before + 100 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY s) AS run
  FROM (SELECT doc_id, s, lag(s) OVER (PARTITION BY doc_id ORDER BY s) AS before FROM r)),
b AS (SELECT doc_id, run, min(s) AS b, max(s) + 100 AS e FROM i GROUP BY 1, 2),
k AS (SELECT doc_id, b, coalesce(lag(e) OVER (PARTITION BY doc_id ORDER BY b), 0) AS a FROM (
  SELECT doc_id, b, e FROM b UNION ALL SELECT doc_id, n, NULL FROM d)),
t AS (SELECT doc_id, count(*) AS spans, sum(e - b) AS gone FROM b GROUP BY 1),
p AS (SELECT doc_id, string_agg(substr(x, CAST(2 * a + 1 AS BIGINT), CAST(2 * (b - a) AS BIGINT)), '' ORDER BY b) AS kept FROM k JOIN d USING (doc_id) GROUP BY 1)
SELECT doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(gone, 0) AS BIGINT) AS n_removed, CAST(coalesce(spans, 0) AS BIGINT) AS n_spans, sha256(unhex(p.kept)) AS kept_sha256
FROM d JOIN p USING (doc_id) LEFT JOIN t USING (doc_id)
"""

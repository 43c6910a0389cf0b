"""WARC archives: a Python data source that writes and reads them."""

from __future__ import annotations

import base64
import hashlib
import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, In, InputPartition, IsNotNull, WriterCommitMessage,
)

from tessera.plans.lineage import cut

#: Fixed values of the format.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_TYPE = "application/http; msgtype=response"
BLANK = b"\r\n\r\n"
PAGE_URN = "urn:x-page:"

SCHEMA = (
    "record_type string, record_id string, page_id long, target_uri string, date string, refers_to long, refers_to_id string,"
    " content_type string, payload_bytes long, payload_digest string, content_length long, payload binary"
)
#: Columns that come from headers, and the header of each: predicates on these are decided before the payload is touched.
HEADER_OF = {"record_type": "warc-type", "record_id": "warc-record-id", "target_uri": "warc-target-uri"}
NEEDS_PAYLOAD = {"payload", "payload_bytes", "payload_digest"}
#: Bits of the maps by which a scan tells payloads that occur once from those that may not.
MAP_BITS = 25
#: Bytes read at a time, and compressed bytes given to the inflater at a time (headers take the first piece only).
STEP, FEED = 1 << 20, 1 << 13


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _bit(digest: str, map_bits: int, salt: int = 0) -> int:
    return (zlib.crc32(digest.encode(), salt) ^ salt) & ((1 << map_bits) - 1)


def _bit_map(bits: DataFrame, map_bits: int) -> np.ndarray:
    """2^map_bits bits, set at each (bit)."""
    rows = bits.groupBy(F.shiftright("bit", 6).alias("i")).agg(F.expr("bit_or(shiftleft(1L, cast(bit & 63 AS int)))").alias("x")).toArrow()
    out = np.zeros(1 << (map_bits - 6), np.uint64)
    out[rows.column("i").to_numpy()] = rows.column("x").to_numpy().view(np.uint64)
    return out


def _is_set(bits: np.ndarray, bit: int) -> bool:
    return bool((int(bits[bit >> 6]) >> (bit & 63)) & 1)


def to_records(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", date_col: str | None = None, least_bytes: int = 0,
    map_bits: int = MAP_BITS,
) -> DataFrame:
    """One row per page: page_id, record_type, target_uri, date, refers_to, payload_bytes, payload_digest, payload.

    Of pages with equal payloads of at least ``least_bytes`` bytes the one with the largest id becomes a response and
    the others revisits of it, which have no payload. A null html is an empty payload. Repeated ids: all rows with the
    largest id are responses. Pages with a null id are responses that nothing refers to. Without ``date_col`` (a string
    or timestamp) all records bear one date. Other columns are not read; an empty table gives no rows.

    Digests alone are grouped. Two bitmaps of one size whatever the input, over the digests that occur more than once
    and over those with their largest ids, let the scan send all other payloads straight on; only the payload that each
    group keeps goes through the join that decides it, and a page that seems to be a revisit goes without its payload.
    Bits may be shared by digests that occur once: the join tells such pages, and their payloads are read again.
    """
    date = F.lit("2000-01-01T00:00:00Z") if date_col is None else F.date_format(F.col(date_col).cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    p = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), date.alias("date"),
        F.coalesce(F.col(html_col).cast("binary"), F.lit(b"")).alias("html"))

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = batch.column(1).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([base32_sha1(x) for x in data])], names=["page_id", "digest"])

    seen = p.where((F.octet_length("html") >= least_bytes) & F.col("page_id").isNotNull()).select("page_id", "html")
    seen = seen.mapInArrow(digests, "page_id long, digest string")
    again = seen.groupBy("digest").agg(F.max("page_id").alias("latest"), F.count("*").alias("n")).where("n > 1")

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digest, latest = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            one, two = [_bit(d, map_bits) for d in digest], [_bit(d, map_bits, 1 + (i & 0x7FFFFFFF)) for d, i in zip(digest, latest, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(one, pa.int64()), pa.array(two, pa.int64())], names=["digest", "latest", "one", "two"])

    again = cut(again.select("digest", "latest").mapInArrow(bits, "digest string, latest long, one long, two long"), "again")
    maps = [_bit_map(again.select(F.col(c).alias("bit")), map_bits) for c in ("one", "two")]
    held = pages.sparkSession.sparkContext.broadcast(maps)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        some, most = held.value
        for batch in batches:
            ids, html = batch.column(0).to_pylist(), batch.column(3).to_pylist()
            digest, size, maybe, left_out = [base32_sha1(x) for x in html], [len(x) for x in html], [], []
            for k, (i, d) in enumerate(zip(ids, digest, strict=True)):
                maybe.append(i is not None and size[k] >= least_bytes and _is_set(some, _bit(d, map_bits)))
                left_out.append(maybe[-1] and not _is_set(most, _bit(d, map_bits, 1 + (i & 0x7FFFFFFF))))  # seems not to be its group's largest id
                if left_out[-1]:
                    html[k] = None
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(digest), pa.array(size, pa.int64()), pa.array(maybe), pa.array(left_out), pa.array(html, pa.binary())], names=names)

    schema = "page_id long, url string, date string, digest string, bytes long, maybe boolean, left_out boolean, html binary"
    names = [x.split()[0] for x in schema.split(", ")]
    placed = p.mapInArrow(place, schema)
    joined = placed.where("maybe").join(again.select("digest", "latest"), "digest", "left")
    lost = cut(placed.drop("html").where("left_out").join(again, "digest", "left_anti").select("digest").distinct(), "lost")
    if not lost.isEmpty():
        joined = _read_again(p, joined, lost, map_bits)
    rows = placed.where("not maybe").withColumn("latest", F.lit(None).cast("long")).unionByName(joined)
    revisit = F.coalesce(F.col("page_id") < F.col("latest"), F.lit(False))
    return rows.select(
        "page_id", F.when(revisit, "revisit").otherwise("response").alias("record_type"), F.col("url").alias("target_uri"), "date",
        F.when(revisit, F.col("latest")).alias("refers_to"), F.col("bytes").alias("payload_bytes"), F.col("digest").alias("payload_digest"),
        F.when(~revisit, F.col("html")).alias("payload"))


def _read_again(p: DataFrame, joined: DataFrame, lost: DataFrame, map_bits: int) -> DataFrame:
    """``joined`` with the payloads of the digests in ``lost``, which the scan has left out though they occur once."""

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([_bit(d, map_bits) for d in batch.column(0).to_pylist()], pa.int64())], names=["bit"])

    held = p.sparkSession.sparkContext.broadcast(_bit_map(lost.mapInArrow(bits, "bit long"), map_bits))

    def payloads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            some = [(d, x) for x in batch.column(0).to_pylist() if _is_set(held.value, _bit(d := base32_sha1(x), map_bits))]
            yield pa.RecordBatch.from_arrays([pa.array([d for d, _ in some], pa.string()), pa.array([x for _, x in some], pa.binary())], names=["digest", "found"])

    found = p.select("html").mapInArrow(payloads, "digest string, found binary").join(lost, "digest", "left_semi").dropDuplicates(["digest"])
    return joined.join(found, "digest", "left").withColumn("html", F.coalesce("html", "found")).drop("found")


def member(record: bytes, level: int = 4) -> bytes:
    """A gzip member whose extra field ``sl`` tells its compressed and plain length, so that readers can skip it."""
    deflate = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = deflate.compress(record) + deflate.flush()
    length = len(body) + 32
    tail = struct.pack("<II", zlib.crc32(record), len(record) & 0xFFFFFFFF)
    if max(length, len(record)) >> 32:
        return b"\x1f\x8b\x08\0\0\0\0\0\0\xff" + body + tail
    return b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<HccHII", 12, b"s", b"l", 8, length, len(record)) + body + tail


def record_bytes(headers: list[tuple[str, str | None]], block: bytes) -> bytes:
    """Control characters in values become spaces, so that none can start another header."""
    lines = [f"{name}: {re.sub(r'[\x00-\x1f\x7f]', ' ', value)}\r\n" for name, value in headers if value is not None]
    return f"{VERSION}\r\n{''.join(lines)}Content-Length: {len(block)}\r\n\r\n".encode("utf-8", "replace") + block + BLANK


def page_record(row: dict) -> bytes:
    urn = lambda i: f"<{PAGE_URN}{'' if i is None else i}>"
    revisit, payload = row["record_type"] == "revisit", row["payload"] or b""
    if not revisit and len(payload) != row["payload_bytes"]:
        raise ValueError(f"page {row['page_id']}: the payload has {len(payload)} bytes, not {row['payload_bytes']}")
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['payload_bytes']}\r\n\r\n".encode()
    return record_bytes([
        ("WARC-Type", row["record_type"]), ("WARC-Record-ID", urn(row["page_id"])), ("WARC-Date", row["date"]),
        ("WARC-Target-URI", row["target_uri"]), ("WARC-Payload-Digest", f"sha1:{row['payload_digest']}"),
        ("WARC-Profile", REVISIT_PROFILE if revisit else None), ("WARC-Refers-To", urn(row["refers_to"]) if revisit else None),
        ("X-Payload-Length", str(row["payload_bytes"])), ("Content-Type", HTTP_TYPE),
    ], http + payload)


@dataclass
class _Written(WriterCommitMessage):
    files: list[tuple[str, str]]


def _store(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


class WarcWriter(DataSourceArrowWriter):
    """One task writes files of about ``bytes_per_file``; they get their names when all tasks have ended."""

    def __init__(self, options: dict):
        self.path, self.bytes_per_file = options["path"], int(options.get("bytes_per_file", 256 << 20))

    def write(self, batches: Iterator[pa.RecordBatch]) -> _Written:
        store, root = _store(self.path)
        store.create_dir(f"{root}/_temporary", recursive=True)
        files, out, size = [], None, 0
        for batch in batches:
            for row in batch.to_pylist():
                if out is None or size > self.bytes_per_file:
                    if out is not None:
                        out.close()
                    name = f"{uuid.uuid4().hex}.warc.gz"
                    files.append((f"{root}/_temporary/{name}", f"{root}/{name}"))
                    out, size = store.open_output_stream(files[-1][0], compression=None), 0
                    out.write(member(record_bytes([
                        ("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", row["date"]),
                        ("WARC-Filename", name), ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n")))
                data = member(page_record(row))
                out.write(data)
                size += len(data)
        if out is not None:
            out.close()
        return _Written(files)

    def commit(self, messages: list) -> None:
        store, root = _store(self.path)
        store.create_dir(root, recursive=True)
        for m in messages:
            for source, target in m.files if m else ():
                store.move(source, target)
        self._drop(store, root)

    def abort(self, messages: list) -> None:
        self._drop(*_store(self.path))

    def _drop(self, store, root: str) -> None:
        from pyarrow import fs

        if store.get_file_info(f"{root}/_temporary").type != fs.FileType.NotFound:
            store.delete_dir(f"{root}/_temporary")


def write_warc(records: DataFrame, path: str, bytes_per_file: int = 256 << 20) -> None:
    """Write rows of :func:`to_records` as gzip archives, a member per record and a warcinfo record first.

    Files of lost or repeated tasks stay out of the folder: only those of the attempts that Spark commits are named.
    """
    records.sparkSession.dataSource.register(WarcSource)
    records.write.format("tessera_warc").option("bytes_per_file", bytes_per_file).mode("append").save(path)


class _Files(InputPartition):
    def __init__(self, paths: list[str]):
        self.paths = paths


class _Bytes:
    """What an archive holds, plain or inflated, read in order; memory holds a step of it and what is taken."""

    def __init__(self, f):
        self.f, self.raw, self.base, self.pos = f, f.read(STEP), 0, 0
        self.gzip, self.inflater, self.next_member = self.raw[:2] == b"\x1f\x8b", None, None
        self.out, self.at = b"", 0

    def _refill(self) -> bool:
        self.base += len(self.raw)
        self.raw, self.pos = self.f.read(STEP), 0
        return bool(self.raw)

    def _start_member(self) -> bool:
        while len(self.raw) - self.pos < 32:
            more = self.f.read(STEP)
            if not more:
                break
            self.base, self.raw, self.pos = self.base + self.pos, self.raw[self.pos :] + more, 0
        head = self.raw[self.pos : self.pos + 24]
        if not head.strip(b"\0"):
            return False
        if head[:2] != b"\x1f\x8b":
            raise ValueError("not a gzip member")
        self.next_member = None
        if head[3] == 4 and head[12:14] == b"sl":
            self.next_member = self.base + self.pos + struct.unpack("<I", head[16:20])[0]
        self.inflater = zlib.decompressobj(31)
        return True

    def _more(self) -> bool:
        more = b""
        while not more:
            if not self.gzip:
                if self.pos >= len(self.raw) and not self._refill():
                    return False
                more, self.pos = self.raw[self.pos :], len(self.raw)
                continue
            if self.inflater is None and not self._start_member():
                return False
            if self.inflater.unconsumed_tail:
                piece = self.inflater.unconsumed_tail
            else:
                if self.pos >= len(self.raw) and not self._refill():
                    raise ValueError("a gzip member breaks off")
                piece = self.raw[self.pos : self.pos + FEED]
                self.pos += len(piece)
            more = self.inflater.decompress(piece, STEP)
            if self.inflater.eof:
                self.pos -= len(self.inflater.unused_data)
                self.inflater = None
        self.out, self.at = self.out[self.at :] + more, 0
        return True

    def head(self) -> bytes | None:
        """Up to the next blank line, or None at the end. Line ends before a record are passed over."""
        while True:
            while self.at < len(self.out) and self.out[self.at] in b"\r\n":
                self.at += 1
            if self.at < len(self.out):
                break
            if not self._more():
                return None
        while (end := self.out.find(BLANK, self.at)) < 0:
            if not self._more():
                raise ValueError("a WARC record breaks off in its headers")
        found, self.at = self.out[self.at : end], end + 4
        return found

    def take(self, n: int) -> bytes:
        parts = []
        while n:
            if self.at >= len(self.out) and not self._more():
                raise ValueError("a WARC record breaks off in its payload")
            parts.append(self.out[self.at : self.at + n])
            self.at += len(parts[-1])
            n -= len(parts[-1])
        return b"".join(parts)

    def skip(self, n: int) -> None:
        """Step over a record's last n bytes: by a seek where the file tells how far, else inflating without keeping."""
        target = self.next_member if self.gzip else self.base + self.pos + n - (len(self.out) - self.at)
        if n > len(self.out) - self.at and target is not None:
            self.out, self.at, self.inflater = b"", 0, None
            if self.base <= target <= self.base + len(self.raw):
                self.pos = target - self.base
            else:
                self.f.seek(target)
                self.base, self.raw, self.pos = target, b"", 0
            return
        while n:
            if self.at >= len(self.out) and not self._more():
                return
            step = min(n, len(self.out) - self.at)
            self.at += step
            n -= step


class WarcReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.columns = options["path"], json.loads(options.get("columns", "[]"))
        self.bytes_per_task = int(options.get("bytes_per_task", 64 << 20))
        self.verify = options.get("verify", "false") == "true"
        self.wanted: dict[str, set] = {}

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Keep equality and membership tests on header columns; all others stay with Spark."""
        for f in filters:
            if isinstance(f, EqualTo | In) and len(f.attribute) == 1 and f.attribute[0] in HEADER_OF:
                values = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.wanted[f.attribute[0]] = self.wanted.get(f.attribute[0], values) & values
            elif not (isinstance(f, IsNotNull) and f.attribute == ("record_type",)):
                yield f

    def partitions(self) -> list[InputPartition]:
        from pyarrow import fs

        store, root = _store(self.path)
        files = store.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True))
        files = [x for x in files if x.is_file and not re.search(r"/[._]", x.path[len(root) :])]
        groups, size = [[]], 0
        for x in sorted(files, key=lambda x: x.path):
            if groups[-1] and size + x.size > self.bytes_per_task:
                groups, size = [*groups, []], 0
            groups[-1].append(x.path)
            size += x.size
        return [_Files(g) for g in groups]

    def read(self, partition: _Files) -> Iterator[tuple]:
        if any(not x for x in self.wanted.values()):
            return
        store, _ = _store(self.path)
        for path in partition.paths:
            with store.open_input_file(path) as f:
                yield from self._records(_Bytes(f))

    def _records(self, data: _Bytes) -> Iterator[tuple]:
        while (raw := data.head()) is not None:
            first, *lines = re.sub(r"\r\n[ \t]+", " ", raw.decode("utf-8", "replace")).split("\r\n")
            if not re.fullmatch(r"WARC/\d+\.\d+", first.strip()):
                raise ValueError(f"not a WARC record: {first[:60]!r}")
            head = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
            length = int(head["content-length"])
            take = all(head.get(HEADER_OF[c]) in values for c, values in self.wanted.items())
            need = take and head.get("warc-type") != "revisit" and not NEEDS_PAYLOAD.isdisjoint(self.columns)
            block = data.take(length) if need else None
            data.skip(len(BLANK) + (0 if need else length))
            if take:
                yield self._row(head, block)

    def _row(self, head: dict[str, str], block: bytes | None) -> tuple:
        def number(urn: str | None) -> int | None:
            found = re.fullmatch(rf"<?{PAGE_URN}(-?\d+)>?", urn or "")
            return int(found[1]) if found else None

        payload, digest, size = block, head.get("warc-payload-digest", "").removeprefix("sha1:") or None, head.get("x-payload-length")
        if block is not None and head.get("content-type", "").startswith("application/http"):
            payload = block.partition(BLANK)[2]
        if payload is not None:
            found = base32_sha1(payload) if digest is None or self.verify else digest
            if self.verify and (found != (digest or found) or len(payload) != int(size or len(payload))):
                raise ValueError(f"payload of {head.get('warc-record-id')} differs from its digest")
            digest, size = digest or found, len(payload)
        row = {
            "record_type": head.get("warc-type"), "record_id": head.get("warc-record-id"), "page_id": number(head.get("warc-record-id")),
            "target_uri": head.get("warc-target-uri"), "date": head.get("warc-date"), "refers_to": number(head.get("warc-refers-to")),
            "refers_to_id": head.get("warc-refers-to"), "content_type": head.get("content-type"),
            "payload_bytes": None if size is None else int(size), "payload_digest": digest,
            "content_length": int(head["content-length"]), "payload": payload,
        }
        return tuple(row[c] for c in self.columns)


class WarcSource(DataSource):
    """Options: ``path``; ``columns``, a JSON list of the columns to give; ``bytes_per_task``; ``verify``; ``bytes_per_file``."""

    @classmethod
    def name(cls) -> str:
        return "tessera_warc"

    def schema(self) -> str:
        columns = json.loads(self.options.get("columns", "[]"))
        kinds = dict(x.strip().split(" ") for x in SCHEMA.split(","))
        return ", ".join(f"{c} {kinds[c]}" for c in columns)

    def reader(self, schema) -> DataSourceReader:
        return WarcReader(self.options)

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        return WarcWriter(self.options)


def read_warc(spark: SparkSession, path: str, columns: tuple[str, ...] | None = None, verify: bool = False) -> DataFrame:
    """Read the archives below ``path``, gzip or plain, of any writer (WARC/1.0 and 1.1); whole files are dealt out to tasks.

    ``columns`` (all by default) says what is wanted: without a payload column no payload is read. Filters on
    record_type, record_id and target_uri are pushed down and decided on headers alone; a record that they drop is
    stepped over, by a seek where the member tells its length, else inflated without being kept. The payload of an HTTP
    response is what follows its HTTP header. page_id and refers_to are null for records that :func:`write_warc` has
    not written; payload_bytes and payload_digest come from the header, or from the payload. With ``verify`` payloads are
    checked against both. A file is streamed by one task, so single large archives limit how many tasks share the work.
    An empty folder gives no rows; a file that breaks off or is no archive raises an error.
    """
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    columns = columns or tuple(x.strip().split(" ")[0] for x in SCHEMA.split(","))
    return spark.read.format("tessera_warc").option("columns", json.dumps(columns)).option("verify", str(verify).lower()).load(path)


WARC_SQL = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages),
q AS (SELECT page_id, strlen(html) AS payload_bytes, hex, max(page_id) OVER (PARTITION BY hex) AS latest,
  list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    CAST((('0x' || substr(hex, CAST((i // 4) * 5 + 1 AS INT), 5))::BIGINT >> CAST(15 - 5 * (i % 4) AS INT)) & 31 AS INT) + 1, 1)),
    'string_agg', '') AS payload_digest FROM p)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
  CASE WHEN page_id < latest THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id < latest THEN latest END AS refers_to FROM q
"""

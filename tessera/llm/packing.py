"""Packing: power-of-two decomposition of documents into sequences."""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.hashes import FOLDED, blocks, byte_set, split

MAX_TOKENS = 4096
END_ID = 2
#: White space between chunks; what else the tokenizer may take for white space stays inside a chunk.
SPACES = byte_set(b" \t\n\r")
MARK = "\x01"
TAIL = byte_set(b".,;:!?%$#&*|")
LETTER = byte_set(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")
CACHE_WORDS = 1_000_000
#: Bytes of text that are encoded together.
TOGETHER = 1 << 21


def binary_pieces(n: int, limit: int = MAX_TOKENS) -> list[int]:
    """Lengths that sum to n: full pieces of ``limit`` and then the powers of two of the rest, falling."""
    return [limit] * (n // limit) + _powers(n % limit, limit)


@lru_cache(maxsize=8192)
def _powers(rest: int, limit: int) -> list[int]:
    return [1 << k for k in range(limit.bit_length(), -1, -1) if rest >> k & 1]


def _cores_and_tails(b: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cut the signs off chunks that end in an ASCII letter and signs: to the tokenizer they are a run of their own."""
    last = np.maximum.accumulate(np.where(TAIL[b], 0, np.arange(len(b))))[ends - 1] + 1
    cut = np.flatnonzero((last < ends) & (last > starts) & LETTER[b[last - 1]])
    middle = last[cut]
    return np.insert(starts, cut + 1, middle), np.insert(ends, cut, middle)


def _knows_chunks(tokenizer) -> bool:
    """Whether a tokenizer lower-cases, drops white space and splits runs of letters and of signs: then chunks between
    white space have ids of their own, whatever their case. Others encode whole texts."""
    config = json.loads(tokenizer.to_str())
    kinds = {x["type"] for x in (config["normalizer"] or {}).get("normalizers", [])}
    first = ((config["pre_tokenizer"] or {}).get("pretokenizers") or [{}])[0]
    pattern = first.get("pattern", {}).get("Regex", "")
    runs = pattern.endswith(r"|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+") and first.get("invert") and first.get("behavior") == "Removed"
    return "Lowercase" in kinds and kinds <= {"NFC", "Replace", "Lowercase"} and bool(runs)


@lru_cache(maxsize=4)
def encoder(path: str) -> WordEncoder:
    """One per Python worker, so that tasks share what it has kept."""
    return WordEncoder(path)


class WordEncoder:
    """Ids of texts in UTF-8 as little-endian unsigned 32-bit numbers.

    The tokenizer never joins characters across white space, so ids are found once per distinct chunk between white
    space and kept, up to ``CACHE_WORDS`` chunks. Chunks are told apart by 64-bit hashes.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.by_chunk = _knows_chunks(self.tokenizer)
        mark = self.tokenizer.encode(MARK, add_special_tokens=False).ids
        self.mark = mark[0] if len(mark) == 1 else -1  # else chunks are encoded one by one
        vocabulary, suffix = self.tokenizer.get_vocab(with_added_tokens=True), getattr(self.tokenizer.model, "end_of_word_suffix", None)
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_word[[i for token, i in vocabulary.items() if suffix and token.endswith(suffix)]] = True
        self._forget()

    def _forget(self) -> None:
        self.keys, self.first, self.size, self.ids = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, "<u4")

    def _learn(self, keys: np.ndarray, chunks: list[str]) -> None:
        """Keep the ids of new chunks (keys sorted)."""
        ids = self._encode_new(chunks)
        found = [ids[c] for c in chunks]
        size = np.fromiter(map(len, found), np.int64, len(found)) // 4
        at = np.searchsorted(self.keys, keys)
        self.first = np.insert(self.first, at, len(self.ids) + np.cumsum(size) - size)
        self.size, self.keys = np.insert(self.size, at, size), np.insert(self.keys, at, keys)
        self.ids = np.concatenate((self.ids, np.frombuffer(b"".join(found), "<u4")))

    def _encode(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, "<u4").tobytes() for x in found]

    def _encode_words(self, words: list[str]) -> dict[str, bytes]:
        """Chunks of letters only as one text; each is one word of the tokenizer's, whose last token says that it ends a word."""
        ids = np.frombuffer(self._encode([" ".join(words)])[0], "<u4")
        ends = np.flatnonzero(self.ends_word[ids]) + 1
        if len(ends) != len(words):  # no such tokens, or a letter's lower case may hold more than letters
            return self._encode_chunks(words)
        raw, at, out = ids.tobytes(), 0, {}
        for word, end in zip(words, ends.tolist(), strict=True):
            out[word] = raw[4 * at : 4 * end]
            at = end
        return out

    def _encode_new(self, chunks: list[str]) -> dict[str, bytes]:
        words = [c for c in chunks if c.isalpha()]
        others = [c for c in chunks if not c.isalpha()]
        return {**(self._encode_words(words) if words else {}), **(self._encode_chunks(others) if others else {})}

    def _encode_chunks(self, chunks: list[str]) -> dict[str, bytes]:
        """All chunks as one text, with MARK, a token of its own, between them."""
        odd = [c for c in chunks if MARK in c]
        plain = [c for c in chunks if MARK not in c]
        ids = np.frombuffer(self._encode([f" {MARK} ".join([*plain, ""])])[0], "<u4") if plain else np.empty(0, "<u4")
        ends = np.flatnonzero(ids == self.mark)
        if len(ends) != len(plain):
            odd, plain = chunks, []
        raw, at, out = ids.tobytes(), 0, dict(zip(odd, self._encode(odd) if odd else [], strict=True))
        for chunk, end in zip(plain, ends.tolist(), strict=False):
            out[chunk] = raw[4 * at : 4 * end]
            at = end + 1
        return out

    def __call__(self, texts: list[bytes]) -> list[np.ndarray]:
        if not self.by_chunk:
            return [np.frombuffer(x, "<u4") for x in self._encode([t.decode("utf-8", "replace") for t in texts])]
        if any(b"<|" in t for t in texts):  # special tokens have a case
            some = [b"<|" in t for t in texts]
            whole = iter(self._encode([t.decode("utf-8", "replace") for t, odd in zip(texts, some, strict=True) if odd]))
            plain = iter(self([t for t, odd in zip(texts, some, strict=True) if not odd]))
            return [np.frombuffer(next(whole), "<u4") if odd else next(plain) for odd in some]
        if not texts:
            return []
        raw, starts, ends, h, words = split(texts, SPACES, FOLDED, _cores_and_tails)
        distinct, place, which = np.unique(h, return_index=True, return_inverse=True)
        if len(self.keys) > CACHE_WORDS:
            self._forget()
        at = np.searchsorted(self.keys, distinct)
        new = np.append(self.keys, 0)[at] != distinct
        if new.any():
            chunks = [raw[a:b].decode("utf-8", "replace") for a, b in zip(starts[place[new]].tolist(), ends[place[new]].tolist(), strict=True)]
            self._learn(distinct[new], chunks)
            at = np.searchsorted(self.keys, distinct)
        first, size = self.first[at][which], self.size[at][which]
        stop = np.cumsum(size)
        ids = self.ids[np.repeat(first - stop + size, size) + np.arange(stop[-1] if len(stop) else 0)]
        return np.split(ids, np.append(0, stop)[words[:-1]])


def pack(
    docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = MAX_TOKENS,
    end_id: int = END_ID, with_ids: bool = True,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, bucket, sequence_id, offset[, ids].

    Every document becomes pieces whose lengths are powers of two (``limit`` must be one, too). A piece
    is a sequence of its own, so that no sequence crosses documents and none is padded; ``bucket`` is
    the logarithm of its length, by which :func:`write_sequences` lays equal lengths together for
    batches of ``limit`` tokens. The work is one pass over the scan, without a shuffle.

    Null and empty texts give one piece that holds ``end_id`` only. Repeated rows (or repeated or null
    ids) are packed each for itself. Very long texts give as many full pieces as needed. Columns other
    than the two named are not read. ``sequence_id`` is unique, and the same on each run over the same files.
    """
    if limit & (limit - 1):
        raise ValueError("limit must be a power of two")
    end = end_id.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer_path)
        for batch in batches:
            pieces, totals, lengths, sums, ids = [], [], [], [], []
            for raw in (ids for texts in blocks(batch.column(1).to_pylist(), TOGETHER) for ids in encode(texts)):
                raw = raw.tobytes() + end
                some, first = binary_pieces(len(raw) // 4, limit), 0
                pieces.append(len(some))
                totals.append(len(raw) // 4)
                lengths += some
                for n in some:
                    piece = raw[first : first + 4 * n]
                    sums.append(zlib.crc32(piece))
                    first += 4 * n
                    if with_ids:
                        ids.append(piece)
            pieces, totals, lengths = np.array(pieces, np.int64), np.array(totals, np.int64), np.array(lengths, np.int64)
            starts = np.cumsum(lengths) - lengths - np.repeat(np.cumsum(totals) - totals, pieces)
            columns = [
                batch.column(0).take(pa.array(np.repeat(np.arange(batch.num_rows), pieces))), pa.array(starts), pa.array(lengths), pa.array(sums, pa.int64()),
                pa.array(np.repeat(totals, pieces)), pa.array(np.log2(lengths).astype(np.int64))]
            yield pa.RecordBatch.from_arrays(columns + [pa.array(ids, pa.binary())] * with_ids, names=names)

    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, bucket long" + ", ids binary" * with_ids
    names = [x.split()[0] for x in schema.split(", ")]
    pieces = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text")).mapInArrow(run, schema)
    return pieces.withColumn("sequence_id", F.monotonically_increasing_id()).withColumn("offset", F.lit(0).cast("long"))


def write_sequences(packed: DataFrame, path: str) -> None:
    """Write sequences as Parquet, one folder per length, so that a batch holds equal lengths only."""
    packed.write.partitionBy("bucket").parquet(path)

"""Words of many texts at once, as 64-bit hashes computed over their bytes."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

#: Bytes hashed at a time: what the caches of a core hold.
CHUNK = 1 << 17
_PRIME = 0x9E3779B97F4A7C13
_C1, _C2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
#: A value for each byte; in the second table A-Z count as a-z.
LETTERS = np.random.default_rng(20).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
FOLDED = LETTERS.copy()
FOLDED[65:91] = FOLDED[97:123]


def byte_set(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


SPACE = byte_set(b" \t\n\x0b\x0c\r")


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _C1
    x = (x ^ (x >> np.uint64(27))) * _C2
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=4)
def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    def up(p: int) -> np.ndarray:
        x = np.full(n, p, np.uint64)
        x[0] = 1
        return np.cumprod(x)

    return up(_PRIME), up(pow(_PRIME, -1, 1 << 64))


def _chunk(b: np.ndarray, space: np.ndarray, letters: np.ndarray, parts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and hashes of the words of bytes that end in white space: differences of one running sum."""
    word = ~space[b]
    edge = np.flatnonzero(word[1:] != word[:-1]) + 1
    if len(word) and word[0]:
        edge = np.concatenate(([0], edge))
    starts, ends = edge[0::2], edge[1::2]
    if parts:
        starts, ends = parts(b, starts, ends)
    up, down = powers(1 << max(CHUNK.bit_length(), int(len(b)).bit_length()))
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(letters[b] * up[: len(b)])))
    h = mix((sums[ends] - sums[starts]) * down[starts])
    h[h < 2] += np.uint64(2)
    return starts, ends, h


def split(texts: list[bytes], space: np.ndarray = SPACE, letters: np.ndarray = FOLDED, parts=None) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The texts joined by line feeds, starts, ends and hashes (2 or more) of their words there, and how many words stand before each text's end.

    ``parts`` may cut words further: a function of bytes, starts and ends that gives starts and ends.
    """
    data = b"\n".join([*texts, b""])
    raw, found, at = np.frombuffer(data, np.uint8), [], 0
    while at < len(raw):
        stop = min(at + CHUNK, len(raw))
        while stop < len(raw) and not space[raw[stop - 1]]:  # up to the next white space
            more = np.flatnonzero(space[raw[stop : stop + 4096]])
            stop = stop + int(more[0]) + 1 if len(more) else min(stop + 4096, len(raw))
        starts, ends, h = _chunk(raw[at:stop], space, letters, parts)
        found.append((starts + at, ends + at, h))
        at = stop
    starts, ends, h = (np.concatenate(x) for x in zip(*found, strict=True))
    return data, starts, ends, h, np.searchsorted(starts, np.cumsum([len(t) + 1 for t in texts]))


def blocks(texts, size: int) -> Iterator[list[bytes]]:
    """Texts (null: empty) by about ``size`` bytes; a longer one is a block of its own. What Arrow has freed goes back to the system at the end."""
    out, n = [], 0
    for t in texts:
        out.append(t or b"")
        n += len(out[-1])
        if n >= size:
            yield out
            out, n = [], 0
    if out:
        yield out
    pa.default_memory_pool().release_unused()

"""Words and word shingles of a text as 64-bit hashes, computed on whole arrays.

A word is a run of bytes other than space, tab, line feed, vertical tab, form
feed and carriage return. Texts are worked through in blocks that end at a
blank, so the memory of a task follows the block and not the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
from xxhash import xxh64_digest

WORD_PATTERN = r"[^\x20\x09-\x0D]+"
SHINGLE_WORDS = 5
BLOCK_BYTES = 1 << 18
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)

_BLANK = np.zeros(256, dtype=bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True


@lru_cache(maxsize=4)
def _powers(base: int, size: int) -> np.ndarray:
    table = np.full(size, base, dtype=np.uint64)
    table[0] = 1
    return np.cumprod(table, dtype=np.uint64)


def powers(base: int, n: int) -> np.ndarray:
    """1, base, base^2, ... modulo 2^64, at least ``n`` of them."""
    return _powers(base, 1 << max(12, (n - 1).bit_length()))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values, so that all bits of the result count."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def prefix_hashes(data: np.ndarray, values: np.ndarray = np.arange(1, 257, dtype=np.uint64)) -> np.ndarray:
    """Running polynomial sums c, such that any slice's hash is (c[e] - c[s]) * INVERSE^s.

    ``values`` gives the number that each byte stands for. For slices of a few
    hundred bytes only: modulo 2^64, patterns of 1,024 bytes and more collide.
    """
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(values[data] * powers(BASE, len(data))[: len(data)], out=sums[1:])
    return sums


def slice_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return mix((sums[ends] - sums[starts]) * powers(INVERSE, len(sums))[starts])


def word_bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end offset of every word."""
    inside = np.zeros(len(data) + 2, dtype=np.int8)
    inside[1:-1] = ~_BLANK[data]
    step = np.diff(inside)
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def _blocks(data: np.ndarray) -> Iterator[np.ndarray]:
    start = 0
    while start < len(data):
        end = min(len(data), start + BLOCK_BYTES)
        while end < len(data) and not _BLANK[data[end]]:
            end += 1
        yield data[start:end]
        start = end


def _hashed(words: list[bytes]) -> np.ndarray:
    """A digest of each word by itself: no structure of a word makes it equal another's."""
    return np.frombuffer(b"".join(map(xxh64_digest, words)), dtype=">u8").astype(np.uint64)


def word_hashes(text: str | bytes | None) -> np.ndarray:
    """One hash per word, in order."""
    raw = text.encode() if isinstance(text, str) else text or b""
    # Python splits bytes at the same six blanks.
    parts = [_hashed(block.tobytes().split()) for block in _blocks(np.frombuffer(raw, dtype=np.uint8))]
    return np.concatenate(parts) if parts else np.zeros(0, dtype=np.uint64)


def shingle_hashes(words: np.ndarray, k: int = SHINGLE_WORDS) -> np.ndarray:
    """One hash per run of ``k`` words; a shorter text is one shingle, an empty one has none."""
    k = min(k, len(words))
    if not k:
        return words
    total = np.zeros(len(words) - k + 1, dtype=np.uint64)
    for i in range(k):
        total = total * np.uint64(BASE) + words[i : i + len(total)]
    return mix(total)

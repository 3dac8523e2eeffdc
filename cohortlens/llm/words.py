"""Words of a text and hashes of words, as arrays inside a task.

A word is a maximal run of bytes other than the six ASCII blanks (space, tab,
line feed, vertical tab, form feed, carriage return); ``bytes.split`` cuts at
exactly these.  ``bytes.lower`` changes exactly A-Z.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

WORD_PATTERN = r"[^\x20\x09-\x0D]+"

#: odd multipliers for combining word hashes; any fixed values do
_MIX = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").split() if text else []


def lower_words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def scramble(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def shingles(hashes: np.ndarray, width: int) -> np.ndarray:
    """Sorted distinct hashes of the windows of ``width`` words.

    A shorter sequence is one shingle; an empty one has none.
    """
    if len(hashes) == 0:
        return hashes
    n = max(1, len(hashes) - width + 1)
    out = np.zeros(n, np.uint64)
    for k in range(min(width, len(hashes))):
        out = scramble(out * _MIX + hashes[k : k + n] + np.uint64(k + 1))
    return np.unique(out)


def batches(rows: Iterator[pa.RecordBatch], *columns: str) -> Iterator[list[list]]:
    """The named columns of each non-empty batch as Python lists."""
    for b in rows:
        if b.num_rows:
            yield [b.column(c).to_pylist() for c in columns]

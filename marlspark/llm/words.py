"""Words of whole texts, for a batch of documents at a time and without a Python step per word.

A word is a run of bytes other than the six white-space bytes 0x20 and 0x09-0x0D; A-Z are lower-cased. In
UTF-8 those bytes never occur inside another character, so the bytes can be searched as they are.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SPACES = bytes([0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D])
IS_SPACE = np.zeros(256, bool)
IS_SPACE[list(SPACES)] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Odd multipliers of the hashes; any fixed odd numbers do.
BASE = np.uint64(0x9E3779B97F4A7C15)
STEP = np.uint64(0xD6E8FEB86659FD93)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the finaliser of splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _powers(n: int) -> np.ndarray:
    out = np.empty(max(n, 1), np.uint64)
    out[0] = 1
    out[1:] = BASE
    return np.multiply.accumulate(out)


def text_bytes(col: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a column of strings; a null is an empty text."""
    col = pa.concat_arrays(col.chunks) if isinstance(col, pa.ChunkedArray) else col
    col = col.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(col.buffers()[1], np.int64, len(col) + 1 + col.offset)[col.offset :]
    if not len(col):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    data = np.frombuffer(col.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


@dataclass
class Words:
    """Words of a batch in order. doc: index of the text; first, count: of each text; hash: 64 bits of the lower-cased word."""

    data: np.ndarray
    offsets: np.ndarray
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    first: np.ndarray
    count: np.ndarray
    hash: np.ndarray


def split_words(data: np.ndarray, offsets: np.ndarray, lower: bool = True) -> Words:
    n, docs = len(data), len(offsets) - 1
    word = ~IS_SPACE[data]
    fresh = np.ones(n, bool)
    fresh[1:] = ~word[:-1]
    fresh[offsets[:-1][offsets[:-1] < n]] = True
    start = np.flatnonzero(word & fresh)
    last = np.ones(n, bool)
    last[:-1] = fresh[1:] | ~word[1:]
    end = np.flatnonzero(word & last) + 1
    doc = np.searchsorted(offsets[1:], start, side="right")
    count = np.bincount(doc, minlength=docs)
    first = np.cumsum(count) - count
    size = end - start
    if len(start):
        letters = (LOWER[data] if lower else data)[word]
        at = np.cumsum(size) - size
        place = np.arange(len(letters)) - np.repeat(at, size)
        value = np.add.reduceat((letters.astype(np.uint64) + np.uint64(1)) * _powers(int(size.max()))[place], at)
    else:
        value = np.zeros(0, np.uint64)
    return Words(data, offsets, start, end, doc, first, count, mix(value + size.astype(np.uint64) * STEP))


def shingles(w: Words, k: int = 5) -> list[np.ndarray]:
    """For each text the sorted distinct hashes of its k-word shingles; with fewer words, of the whole sequence."""
    h = w.hash
    rows = [h]
    for j in range(1, k):
        prev = rows[-1]
        rows.append(mix(prev[: max(len(h) - j, 0)] * STEP + h[j:]) if len(h) > j else np.zeros(0, np.uint64))
    out = []
    for a, c in zip(w.first.tolist(), w.count.tolist(), strict=True):
        if c >= k:
            out.append(np.unique(rows[k - 1][a : a + c - k + 1]))
        else:
            out.append(mix(rows[c - 1][a : a + 1] + np.uint64(c)) if c else np.zeros(0, np.uint64))
    return out

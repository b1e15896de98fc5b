"""Words, word hashes and shingle hashes of Arrow text columns, in numpy.

A word is ``[^\\x20\\x09-\\x0D]+``. Everything works on slices of a batch whose
text is about ``SLICE_BYTES`` long, so memory does not grow with the batch. Words
are compared by 64-bit hashes of their UTF-8 bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20
ODD = 0x9E3779B97F4A7C15  # any odd number: powers of it are invertible modulo 2**64
WORD = r"[^\x20\x09-\x0D]+"


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (the finaliser of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def byte_values() -> np.ndarray:
    return mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(ODD))


def powers(n: int, base: int = ODD) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    if n:
        out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


@dataclass
class Words:
    """Words of consecutive texts: document i has words first[i] to first[i + 1]."""

    data: np.ndarray  # bytes of all texts
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    hashes: np.ndarray

    def text(self, i: int) -> bytes:
        return self.data[self.starts[i] : self.ends[i]].tobytes()


def slices(batch: pa.RecordBatch, column: str = "text", size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of whole rows with about ``size`` bytes of text each."""
    if batch.num_rows == 0:
        return
    length = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(length, dtype=np.int64) // size
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:], strict=False):
        if b > a:
            yield batch.slice(a, b - a)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in a row and their offsets; a null text is empty."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8)[offsets[0] : offsets[-1]] if raw else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def split_words(texts: pa.Array, lower: bool = False, hashed: bool = True) -> Words:
    """The words of every text; ``lower`` maps A-Z to a-z first."""
    data, offsets = text_bytes(texts)
    if lower:
        table = np.arange(256, dtype=np.uint8)
        table[65:91] += 32
        data = table[data]
    n = len(data)
    gap = np.zeros(256, dtype=bool)
    gap[[0x20, *range(0x09, 0x0E)]] = True
    inside = ~gap[data]
    edge = np.zeros(n + 1, dtype=bool)
    edge[offsets] = True
    start, end = inside.copy(), inside.copy()
    if n:
        start[1:] &= ~inside[:-1] | edge[1:n]
        end[:-1] &= ~inside[1:] | edge[1:n]
    starts, ends = np.flatnonzero(start), np.flatnonzero(end) + 1
    first = np.searchsorted(starts, offsets)
    return Words(data, starts, ends, first, _hashes(data, inside, starts, ends) if hashed else np.zeros(0, np.uint64))


def _hashes(data, inside, starts, ends) -> np.ndarray:
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    values, size = byte_values(), ends - starts
    # h = sum of value(byte) * ODD**place, taken over the bytes inside words only
    place = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    longest = int(size.max())
    terms = values[data[inside]] * powers(longest)[place]
    return mix(np.add.reduceat(terms, np.cumsum(size) - size) + size.astype(np.uint64))


def gram_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of every ``n`` consecutive words (across texts; the caller cuts)."""
    count = len(hashes) - n + 1
    if count <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = np.zeros(count, dtype=np.uint64)
    for j, p in enumerate(powers(n)):
        out += hashes[j : j + count] * p
    return mix(out)


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All indices of the ranges start .. start + size, one range after another."""
    total = int(sizes.sum())
    if not total:
        return np.zeros(0, dtype=np.int64)
    return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(total)


def shingles(words: Words, n: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of ``n`` words of all texts, and where each text's begin.

    A text with fewer words has one shingle of them all; without words none.
    """
    count = np.diff(words.first)
    sizes = np.where(count >= n, count - n + 1, (count > 0).astype(count.dtype))
    first = np.concatenate([[0], np.cumsum(sizes)])
    out = np.zeros(int(first[-1]), dtype=np.uint64)
    full = count >= n
    if full.any():
        grams = gram_hashes(words.hashes, n)
        out[ranges(first[:-1][full], sizes[full])] = grams[ranges(words.first[:-1][full], sizes[full])]
    for i in np.flatnonzero((count > 0) & ~full):
        own = words.hashes[words.first[i] : words.first[i + 1]]
        out[first[i]] = gram_hashes(own, len(own))[0]
    return out, first

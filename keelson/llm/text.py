"""Vectorised word and shingle hashing for Arrow text columns.

Words are the runs of bytes other than space and 0x09-0x0D, with A-Z
lower-cased. Each word gets a 64-bit polynomial hash over random byte
values; a shingle of ``width`` consecutive words gets a mixed combination of
its word hashes. All of it is numpy over the column's UTF-8 buffer, a few
megabytes at a time, so memory stays bounded by the slice size (or by the
longest single text).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2 << 20
_RNG = np.random.Generator(np.random.PCG64(20240607))
_BYTE_VALUE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_POSITION = _RNG.integers(1, 2**63, 64, dtype=np.uint64) | np.uint64(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE_VALUE_LOWER = _BYTE_VALUE[_LOWER]
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_NOT_ALNUM = _SPACE.copy()
_NOT_ALNUM[:128] = [not chr(i).isalnum() for i in range(128)]
_powers = np.ones(1, dtype=np.uint64)


def mix64(x: np.ndarray) -> np.ndarray:
    """Spread the bits of unsigned 64-bit values (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _base_powers(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        p = np.full(max(n, 64), _BASE, dtype=np.uint64)
        p[0] = 1
        _powers = np.multiply.accumulate(p)
    return _powers


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and the n+1 offsets of a string array; null reads as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    _, offs, data = texts.buffers()
    offsets = np.frombuffer(offs, dtype=np.int64, count=len(texts) + 1, offset=texts.offset * 8)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]] if len(texts) else raw[:0], offsets - offsets[0]


def slices(batch: pa.RecordBatch, text_col: str, max_bytes: int = SLICE_BYTES, max_rows: int = 50_000) -> Iterator[pa.RecordBatch]:
    """Consecutive slices of a batch with about ``max_bytes`` of text each."""
    if batch.num_rows == 0:
        return
    lengths = pc.fill_null(pc.binary_length(batch.column(text_col)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    before = np.cumsum(lengths) - lengths
    start = 0
    while start < batch.num_rows:
        end = int(np.searchsorted(before, before[start] + max_bytes, side="left"))
        end = min(max(end, start + 1), start + max_rows, batch.num_rows)
        yield batch.slice(start, end - start)
        start = end


def word_hashes(
    raw: np.ndarray, offsets: np.ndarray, plain: bool = False, prefix: int | None = None, fold: bool = True
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes of all words, n+1 word offsets of the texts, byte starts of the words).

    ``plain``: ASCII punctuation separates words too. ``prefix``: hash only
    that many leading bytes of each word. ``fold``: A-Z reads as a-z."""
    inside = ~(_NOT_ALNUM if plain else _SPACE)[raw]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    text_starts = offsets[:-1][offsets[:-1] < offsets[1:]]
    first[text_starts] = inside[text_starts]
    starts = np.flatnonzero(first)
    if len(starts) == 0:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64), starts
    chars = np.flatnonzero(inside)
    word_of = np.cumsum(first)[chars] - 1
    at = chars - starts[word_of]
    if prefix is not None:
        chars, at = chars[at < prefix], at[at < prefix]
    terms = (_BYTE_VALUE_LOWER if fold else _BYTE_VALUE)[raw[chars]] * _base_powers(int(at.max()) + 1)[at]
    hashes = np.add.reduceat(terms, np.flatnonzero(at == 0))
    return mix64(hashes), np.searchsorted(starts, offsets), starts


def shingle_hashes(words: np.ndarray, word_offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all shingles in order, n+1 shingle offsets of the texts).

    A text with fewer words than ``width`` has one shingle, its whole word
    sequence; a text without words has none."""
    counts = np.diff(word_offsets)
    n_sh = np.where(counts >= width, counts - width + 1, (counts > 0).astype(np.int64))
    out_offsets = np.concatenate(([0], np.cumsum(n_sh)))
    padded = np.concatenate((words, np.zeros(width, np.uint64)))
    total = int(out_offsets[-1])
    at = np.arange(total) + np.repeat(word_offsets[:-1] - out_offsets[:-1], n_sh)
    h = np.full(total, np.uint64(width), dtype=np.uint64)
    for j in range(width):
        h += padded[at + j] * _POSITION[j]
    for d in np.flatnonzero((counts > 0) & (counts < width)):
        k, s = int(counts[d]), int(word_offsets[d])
        h[out_offsets[d]] = np.uint64(k) + (words[s : s + k] * _POSITION[:k]).sum(dtype=np.uint64)
    return mix64(h), out_offsets


def shingle_sets(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct shingle hashes of each text, concatenated; n+1 offsets)."""
    raw, offsets = buffers(texts)
    words, word_offsets, _ = word_hashes(raw, offsets)
    hashes, at = shingle_hashes(words, word_offsets, width)
    sets = [np.unique(hashes[a:b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
    sizes = np.fromiter(map(len, sets), dtype=np.int64, count=len(sets))
    return (np.concatenate(sets) if sets else hashes[:0]), np.concatenate(([0], np.cumsum(sizes)))


def text_slices(texts: pa.Array, max_bytes: int = SLICE_BYTES) -> Iterator[pa.Array]:
    """As ``slices``, for a lone text array."""
    batch = pa.RecordBatch.from_arrays([texts], names=["text"])
    for part in slices(batch, "text", max_bytes):
        yield part.column("text")

"""Whole-chunk work on Arrow text columns with numpy: no Python loop over rows or characters.

Every task takes its documents in chunks of at most ``CHUNK_BYTES`` of text (a longer document
is a chunk of its own), so a worker's memory does not depend on the partition's size. Texts
are read as UTF-8 bytes; NULL counts as the empty text.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

#: Most text bytes that a task looks at together.
CHUNK_BYTES = 1 << 20

_ODD = np.uint64(0x9E3779B97F4A7C15)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _mixed(h: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values (shifts and odd multiplications)."""
    h = h ^ (h >> np.uint64(32))
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xA0761D6478BD642F)
    h ^= h >> np.uint64(32)
    return h


mix = _mixed
_BYTE_VALUES = _mixed(np.arange(1, 257, dtype=np.uint64) * _ODD)
_BASE = np.uint64(0x2545F4914F6CDD1D)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse modulo 2**64, at least n of each."""
    have = _powers.get(0)
    if have is None or len(have[0]) < n:
        size = max(n, CHUNK_BYTES + (CHUNK_BYTES >> 3))
        tables = []
        for base in (_BASE, _INVERSE):
            p = np.full(size, base, dtype=np.uint64)
            p[0] = 1
            tables.append(np.multiply.accumulate(p, dtype=np.uint64))
        have = (tables[0], tables[1])
        if size <= 4 * CHUNK_BYTES:
            _powers[0] = have
    return have


def chunks(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = CHUNK_BYTES):
    """Slices of the batches with at most ``limit`` bytes of text (or one document)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(column))), 0)
        ends = np.cumsum(lengths.to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The texts as one byte array, and where each begins (one more entry than texts)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or at[-1] == at[0]:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(column) + 1, dtype=np.int64)
    return np.frombuffer(data, dtype=np.uint8)[at[0] : at[-1]], at - at[0]


def lower(buf: np.ndarray) -> np.ndarray:
    """A-Z in lower case, all other bytes as they are."""
    return _LOWER[buf]


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each maximal run of true bytes; no run goes beyond its document."""
    n = len(inside)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    cut = np.zeros(n + 1, dtype=bool)
    cut[offsets] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | cut[1:n]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | cut[1:n]
    return np.flatnonzero(begins), np.flatnonzero(ends) + 1


def prefix_hashes(buf: np.ndarray) -> np.ndarray:
    """Running sums from which ``range_hashes`` takes the hash of any range of bytes."""
    out = np.zeros(len(buf) + 1, dtype=np.uint64)
    if len(buf):
        np.cumsum(_BYTE_VALUES[buf] * powers(len(buf) + 1)[0][: len(buf)], out=out[1:])
    return out


def range_hashes(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each range, the same wherever its bytes stand."""
    h = (sums[end] - sums[start]) * powers(len(sums))[1][start]
    return _mixed(h + (end - start).astype(np.uint64) * _ODD)


#: Ranges longer than this are hashed one by one.
LONG_WORD = 256


def word_hashes(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each range, eight bytes at a step, for texts of any make.

    ``range_hashes`` is a polynomial, whose collisions between long ranges can be written down; here every step
    scrambles all bits, so equal hashes of different ranges are left to chance.
    """
    size = end - start
    h = _mixed(size.astype(np.uint64) * _ODD + _BASE)
    padded = np.concatenate([buf, np.zeros(8, dtype=np.uint8)])
    eight = np.ndarray(len(buf) + 1, "<u8", padded, 0, (1,))  # the eight bytes from every place on
    rows = np.flatnonzero((size > 0) & (size <= LONG_WORD))
    step = 0
    while len(rows):
        left = size[rows] - step
        block = eight[start[rows] + step] << (np.uint64(8) * np.maximum(8 - left, 0).astype(np.uint64))
        h[rows] = _mixed(h[rows] * _ODD ^ block)
        rows, step = rows[left > 8], step + 8
    for k in np.flatnonzero(size > LONG_WORD).tolist():
        h[k] = xxhash.xxh3_64_intdigest(buf[start[k] : end[k]].tobytes())
    return h


def release() -> None:
    """Give tables and freed memory back at the end of a task: a worker lives on through other stages."""
    _powers.clear()
    trim()


def trim() -> None:
    """Give freed memory back."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library: its memory stays with the worker
        pass


def gram_hashes(buf: np.ndarray, size: int) -> np.ndarray:
    """``range_hashes`` of every ``size`` bytes in a row; size - 1 shorter."""
    if len(buf) < size:
        return np.zeros(0, dtype=np.uint64)
    sums = prefix_hashes(buf)
    h = sums[size:] - sums[:-size]
    h *= powers(len(sums))[1][: len(h)]
    h += np.uint64(size * int(_ODD) % (1 << 64))
    return _mixed(h)


def window_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of every n consecutive values of ``words`` (order counts); n - 1 shorter."""
    count = len(words) - n + 1
    if count <= 0:
        return np.zeros(0, dtype=np.uint64)
    h = words[:count].copy()
    for k in range(1, n):
        h *= _ODD
        h += words[k : k + count]
    return _mixed(h)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Least of every ``width`` consecutive values; width - 1 shorter."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[:-step], out[step:])
        have += step
    return out


def owners(starts: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Index of the document in which each position stands."""
    return np.searchsorted(offsets, starts, side="right") - 1


def within(firsts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """firsts[0], firsts[0] + 1, ... (counts[0] of them), firsts[1], ... as one array."""
    total = int(counts.sum())
    if not total:
        return np.zeros(0, dtype=np.int64)
    jump = np.repeat(firsts - np.concatenate(([0], np.cumsum(counts)[:-1])), counts)
    return jump + np.arange(total)


def spans_union(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted, merged spans (touching ones count as one) of spans in one row of positions."""
    if not len(start):
        return start, end
    order = np.argsort(start, kind="stable")
    start, reach = start[order], np.maximum.accumulate(end[order])
    fresh = np.concatenate(([True], start[1:] > reach[:-1]))
    last = np.concatenate((np.flatnonzero(fresh)[1:] - 1, [len(start) - 1]))
    return start[fresh], reach[last]


def code_points(buf: np.ndarray) -> np.ndarray:
    """Number of characters that begin before each byte position (one more entry than bytes)."""
    out = np.zeros(len(buf) + 1, dtype=np.int64)
    np.cumsum((buf & 0xC0) != 0x80, out=out[1:])
    return out

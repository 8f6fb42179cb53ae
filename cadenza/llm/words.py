"""Word boundaries and 64-bit word hashes of whole Arrow text columns.

The helpers work on the bytes of an Arrow string array with numpy, a bounded
block of rows at a time, so a task's memory follows the block and not the
partition.  A word never crosses a row; a null text has no words.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20
HASH_BYTES = 1 << 18

_MULT = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xD6E8FEB86659FD93)
_A, _B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _table(inside) -> np.ndarray:
    return np.array([inside(b) for b in range(256)], dtype=bool)


#: A-Z to a-z, every other byte as it is.
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], dtype=np.uint8)
#: Words ``[^\x20\x09-\x0D]+``.
NOT_SPACE = _table(lambda b: not (b == 0x20 or 0x09 <= b <= 0x0D))
#: Words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` of text whose A-Z are lower-cased.
ALNUM = _table(lambda b: b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A)


class Words(NamedTuple):
    hash: np.ndarray    # uint64 per word (empty if not asked for)
    start: np.ndarray   # byte offsets into ``buf``
    end: np.ndarray
    bounds: np.ndarray  # words of row i: bounds[i]:bounds[i + 1]
    buf: np.ndarray     # bytes of the block, lower-cased if asked for


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of each 64-bit value (a bijection)."""
    h = h ^ (h >> np.uint64(30))
    h = h * _A
    h ^= h >> np.uint64(27)
    h *= _B
    h ^= h >> np.uint64(31)
    return h


def text_blocks(column: pa.Array, max_bytes: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first row, end row, bytes, offsets)`` of runs of rows with about ``max_bytes`` of text.

    A row is never cut, so one very long text makes a block of its own.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if len(column) == 0:
        return
    column = column.fill_null("") if column.null_count else column
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, off, data = column.buffers()
    offsets = np.frombuffer(off, dtype=np.int64 if wide else np.int32)
    offsets = offsets[column.offset: column.offset + len(column) + 1].astype(np.int64)
    buf = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
    at, n = 0, len(column)
    while at < n:
        to = int(np.searchsorted(offsets, offsets[at] + max_bytes, side="right")) - 1
        to = min(n, max(to, at + 1))
        lo, hi = offsets[at], offsets[to]
        yield at, to, buf[lo:hi], offsets[at: to + 1] - lo
        at = to


def _powers(n: int, cache: list[np.ndarray] = [np.ones(1, np.uint64)]) -> np.ndarray:  # noqa: B006
    if len(cache[0]) < n:
        size = max(n, 4096)
        cache[0] = np.concatenate([[np.uint64(1)], np.cumprod(np.full(size - 1, _MULT, np.uint64), dtype=np.uint64)])
    return cache[0]


def _hash_spans(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Polynomial hash of each span's bytes, a bounded run of spans at a time."""
    out = np.empty(len(start), np.uint64)
    length = end - start
    total = np.concatenate([[0], np.cumsum(length)])
    at = 0
    while at < len(start):
        to = int(np.searchsorted(total, total[at] + HASH_BYTES, side="right")) - 1
        to = min(len(start), max(to, at + 1))
        n = length[at:to]
        first = total[at:to] - total[at]
        where = np.arange(int(n.sum()), dtype=np.int64) - np.repeat(first, n)
        value = buf[np.repeat(start[at:to], n) + where].astype(np.uint64) + np.uint64(1)
        value *= _powers(int(n.max()))[where]
        out[at:to] = np.add.reduceat(value, first)
        at = to
    return mix(out)


def words(buf: np.ndarray, offsets: np.ndarray, table: np.ndarray, lower: bool = True, hashes: bool = True) -> Words:
    """Words of the rows whose bytes are ``buf[offsets[i]:offsets[i + 1]]``."""
    if lower:
        buf = LOWER[buf]
    n = len(buf)
    inside = np.zeros(n + 2, dtype=bool)
    inside[1:-1] = table[buf]
    here = inside[1:-1]
    begins, ends = here & ~inside[:-2], here & ~inside[2:]
    cut = offsets[(offsets > 0) & (offsets < n)]
    begins[cut] = here[cut]
    ends[cut - 1] = here[cut - 1]
    start = np.flatnonzero(begins)
    end = np.flatnonzero(ends) + 1
    bounds = np.searchsorted(start, offsets)
    hashed = _hash_spans(buf, start, end) if hashes else np.empty(0, np.uint64)
    return Words(hashed, start, end, bounds, buf)


def ngrams(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` words; ``len(hashes) - k + 1`` values (none if there are fewer words)."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = hashes[:n].copy()
    for j in range(1, k):
        out *= _STEP
        out += hashes[j: j + n]
    return mix(out)


def inside_rows(bounds: np.ndarray, k: int) -> np.ndarray:
    """Of the runs of ``k`` words over all rows, those that lie in one row (a mask for ``ngrams``)."""
    total = int(bounds[-1])
    keep = np.ones(max(0, total - k + 1), dtype=bool)
    for j in range(1, k):
        at = bounds[1:-1] - j
        at = at[(at >= 0) & (at < len(keep))]
        keep[at] = False
    return keep

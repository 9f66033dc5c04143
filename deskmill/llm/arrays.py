"""Texts of an Arrow batch as flat numpy arrays: bytes, word spans, 64-bit word hashes.

Working on the UTF-8 bytes of many texts at once keeps Python out of the inner loops. All
functions take any number of rows, empty texts included; NULL is treated as empty text.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text handled at once inside a task; the arrays made from them take some 40 times that.
SLICE_BYTES = 1 << 20
#: Bytes hashed at once.
_BLOCK = 1 << 18

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_BYTE_VALUES = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64)


def lower_ascii() -> np.ndarray:
    """Byte table: A-Z to a-z, all others to themselves."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


LOWER = lower_ascii()

#: Separators of `[^\x20\x09-\x0D]+`.
BLANK = np.zeros(256, dtype=bool)
BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

#: Separators of `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`, looked up after lowering.
NOT_ALNUM = np.ones(256, dtype=bool)
NOT_ALNUM[0x30:0x3A] = NOT_ALNUM[0x61:0x7B] = NOT_ALNUM[0x80:] = False


def slices(batches: Iterable[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the texts of each piece take about ``limit`` bytes; one text stays whole."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts joined, and the offsets at which each begins (one more than rows)."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    _, where, data = texts.buffers()
    offsets = np.frombuffer(where, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if data is None or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def spans(data: np.ndarray, offsets: np.ndarray, separator: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of runs of bytes that are no separators; first[i] is row i's first run.

    A run never reaches over the end of its row. ``first`` has one entry more than rows.
    """
    inside = ~separator[data]
    before = np.empty_like(inside)
    before[:1] = False
    before[1:] = inside[:-1]
    after = np.empty_like(inside)
    after[-1:] = False
    after[:-1] = inside[1:]
    begins, ends = offsets[:-1], offsets[1:]
    filled = ends > begins
    before[begins[filled]] = False
    after[ends[filled] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    stops = np.flatnonzero(inside & ~after) + 1
    return starts, stops, np.searchsorted(starts, offsets)


def mixed(values: np.ndarray) -> np.ndarray:
    """A fixed mixing of 64-bit values that maps no two to one."""
    out = values ^ (values >> np.uint64(33))
    out *= np.uint64(0xFF51AFD7ED558CCD)
    out ^= out >> np.uint64(33)
    out *= np.uint64(0xC4CEB9FE1A85EC53)
    out ^= out >> np.uint64(33)
    return out


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up = np.full(n, _MULTIPLIER, np.uint64)
    up[:1] = 1
    down = np.full(n, pow(int(_MULTIPLIER), -1, 1 << 64), np.uint64)
    down[:1] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


_UP, _DOWN = _powers(_BLOCK + 1)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """At least ``n + 1`` powers of the multiplier and of its inverse."""
    return (_UP, _DOWN) if n <= _BLOCK else _powers(n + 1)


def span_hashes(data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span's bytes; equal bytes give equal hashes everywhere.

    It is a polynomial in random byte values, read off from running sums and then mixed.
    """
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        low = starts[i]
        j = max(i + 1, int(np.searchsorted(stops, low + _BLOCK, side="right")))
        width = int(stops[j - 1] - low)
        up, down = powers(width)
        sums = np.zeros(width + 1, np.uint64)
        np.cumsum(_BYTE_VALUES[data[low : low + width]] * up[:width], out=sums[1:])
        at = starts[i:j] - low
        out[i:j] = (sums[stops[i:j] - low] - sums[at]) * down[at]
        i = j
    return mixed(out + (stops - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """A hash of each ``n`` consecutive word hashes; the last n-1 positions have none."""
    count = max(0, len(words) - n + 1)
    out = np.full(count, n, np.uint64)
    for k in range(n):
        out = mixed(out * np.uint64(0x9FB21C651E98DF25) + words[k : k + count])
    return out


def rows_with(data: np.ndarray, offsets: np.ndarray, *needles: bytes) -> np.ndarray:
    """For each row, whether it holds one of the needles. A row is told once, and then skipped."""
    found = np.zeros(len(offsets) - 1, bool)
    text = data.tobytes()
    for needle in needles:
        at = text.find(needle)
        while at >= 0:
            row = int(np.searchsorted(offsets, at, side="right")) - 1
            if at + len(needle) <= offsets[row + 1]:
                found[row] = True
                at = text.find(needle, int(offsets[row + 1]))
            else:  # it reaches over the end of a row
                at = text.find(needle, at + 1)
    return found


def rows_with_byte(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> np.ndarray:
    """For each row, whether it holds a byte for which the table is true."""
    counts = np.zeros(len(data) + 1, np.int64)
    np.cumsum(table[data], out=counts[1:])
    return counts[offsets[1:]] > counts[offsets[:-1]]


def rows_with_run(data: np.ndarray, offsets: np.ndarray, table: np.ndarray, length: int) -> np.ndarray:
    """For each row, whether it holds that many bytes in a row for which the table is true."""
    starts, stops, first = spans(data, offsets, ~table)
    long = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(stops - starts >= length, out=long[1:])
    return long[first[1:]] > long[first[:-1]]


def byte_table(chars: str) -> np.ndarray:
    """True for these ASCII characters."""
    table = np.zeros(256, bool)
    table[list(chars.encode())] = True
    return table

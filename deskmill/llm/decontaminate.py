"""Benchmark passages in documents, found by winnowed fingerprints.

Of every ``w`` consecutive k-gram hashes the least is kept (the last of equals), for items and
documents alike. A span of ``window = w + k - 1`` equal words has the same k-grams on both
sides, so the same one is kept on both sides: no shared span of that length can be missed.
Kept hashes of the benchmark are joined to those of the documents, and each meeting is
extended word by word to the windows around it that are equal in full. An item of fewer
words than a window is one window, looked up by the hash of its whole length.

The benchmark's word hashes are sent to the tasks in parts of bounded size, each part in a
pass over the documents as they stream by; documents are never shuffled.

Defined results: NULL and empty text has no words. Items of one id are one item; an item
without an id marks words but is not named. No hit gives the hash of the empty text.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deskmill.llm import arrays

#: Words of a window, and of the k-grams that are fingerprinted.
WINDOW, GRAM = 10, 6
#: Bytes of benchmark text in one part; its hashes take about four times that in each worker.
PART_BYTES = 16 << 20

_FILTER_BITS = 22
_SEEDS = 1 << 16

_RESULT = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words (lower-cased, split at other ASCII signs) and where each text's begin."""
    data, offsets = arrays.utf8(texts)
    data = arrays.LOWER[data]
    starts, stops, first = arrays.spans(data, offsets, arrays.NOT_ALNUM)
    return arrays.span_hashes(data, starts, stops), first


def winnow(words: np.ndarray, first: np.ndarray, gram: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the k-grams that are the least in some run of ``width`` of them.

    Runs and k-grams stay within a row; ``first`` tells where rows begin.
    """
    hashes = arrays.gram_hashes(words, gram)
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    least, where = hashes[:n].copy(), np.zeros(n, np.int8)
    for step in range(1, width):
        other = hashes[step : step + n]
        lower = other <= least
        least[lower] = other[lower]
        where[lower] = step
    # Runs that reach over the end of a row do not count.
    valid = np.ones(n, bool)
    ends = first[1:]
    for back in range(1, gram + width - 1):
        at = ends - back
        valid[at[(at >= 0) & (at < n)]] = False
    kept = np.zeros(len(hashes), bool)
    kept[(np.arange(n) + where)[valid]] = True
    kept = np.flatnonzero(kept)
    return kept, hashes[kept]


class Items:
    """A part of the benchmark: word hashes, and an index from fingerprint to places."""

    def __init__(self, ids: list[int | None], texts: list[str | None], window: int = WINDOW, gram: int = GRAM):
        self.window, self.gram, self.width = window, gram, window - gram + 1
        self.words, self.first = word_hashes(pa.array(texts, pa.string()))
        self.ids = ids
        self.item = np.repeat(np.arange(len(ids)), np.diff(self.first))
        sizes = np.diff(self.first)
        where, hashes = winnow(self.words, self.first, gram, self.width)
        self.hashes, self.places = self._sorted(hashes, where)
        #: Items of fewer words than a window, by their number of words.
        self.short = {}
        for size in np.unique(sizes[(sizes > 0) & (sizes < window)]):
            at = self.first[:-1][sizes == size]
            self.short[int(size)] = self._sorted(arrays.gram_hashes(self.words, int(size))[at], at)

    @staticmethod
    def _sorted(hashes, places):
        by = np.argsort(hashes, kind="stable")
        return hashes[by], places[by]

    def meet(self, hashes: np.ndarray, table: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of an index into ``hashes`` and a place in the items with that hash."""
        if not len(table) or not len(hashes):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        mask = np.uint64((1 << _FILTER_BITS) - 1)
        may = np.zeros(1 << _FILTER_BITS, bool)
        may[table & mask] = True
        near = np.flatnonzero(may[hashes & mask])
        low, high = np.searchsorted(table, hashes[near]), np.searchsorted(table, hashes[near], side="right")
        times = high - low
        ends = np.cumsum(times)
        spots = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(low - (ends - times), times)
        return np.repeat(near, times), places[spots]

    def find(self, words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Windows that occur: their first word, their number of words, and the item."""
        found = []
        row_end = np.repeat(first[1:], np.diff(first))
        row_begin = np.repeat(first[:-1], np.diff(first))
        item_end, item_begin = self.first[1:][self.item], self.first[:-1][self.item]
        at, hashes = winnow(words, first, self.gram, self.width)
        which, places = self.meet(hashes, self.hashes, self.places)
        seeds = at[which]
        for cut in range(0, len(seeds), _SEEDS):  # extend
            p, q = seeds[cut : cut + _SEEDS], places[cut : cut + _SEEDS]
            steps = np.arange(1 - self.width, self.window)
            there, here = p[:, None] + steps, q[:, None] + steps
            inside = (there >= row_begin[p][:, None]) & (there < row_end[p][:, None])
            inside &= (here >= item_begin[q][:, None]) & (here < item_end[q][:, None])
            same = inside & (words[np.where(inside, there, 0)] == self.words[np.where(inside, here, 0)])
            for start in range(self.width):
                full = np.flatnonzero(same[:, start : start + self.window].all(axis=1))
                found.append((p[full] + steps[start], np.full(len(full), self.window), self.item[q[full]]))
        for size, (table, places) in self.short.items():
            which, spots = self.meet(arrays.gram_hashes(words, size), table, places)
            good = which + size <= row_end[which]
            which, spots = which[good], spots[good]
            for step in range(size):
                equal = words[which + step] == self.words[spots + step]
                which, spots = which[equal], spots[equal]
            found.append((which, np.full(len(which), size), self.item[spots]))
        if not found:
            return (np.zeros(0, np.int64),) * 3
        return tuple(np.concatenate(part) for part in zip(*found, strict=True))


def hits(texts: pa.Array, items: Items) -> tuple[np.ndarray, list[list[tuple[int, int]]], list[set[str]]]:
    """For each text: number of words, word ranges that are hit, and names of the items."""
    words, first = word_hashes(texts)
    begin, size, item = items.find(words, first)
    rows = np.searchsorted(first, begin, side="right") - 1
    ranges: list[list[tuple[int, int]]] = [[] for _ in range(len(texts))]
    names: list[set[str]] = [set() for _ in range(len(texts))]
    for row, start, n in np.unique(np.stack([rows, begin, size], axis=1), axis=0).tolist():
        start -= int(first[row])
        if ranges[row] and start <= ranges[row][-1][1]:
            ranges[row][-1] = (ranges[row][-1][0], max(ranges[row][-1][1], start + n))
        else:
            ranges[row].append((start, start + n))
    for row, i in np.unique(np.stack([rows, item], axis=1), axis=0).tolist():
        names[row].add("" if items.ids[i] is None else str(items.ids[i]))
    return np.diff(first), ranges, names


def _parts(benchmark: DataFrame, part_bytes: int) -> Iterator[Items]:
    """The benchmark in parts of about ``part_bytes`` of text, dealt out by a hash of the rows."""
    benchmark = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    size = benchmark.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, math.ceil(size / part_bytes))
    for k in range(n):
        rows = benchmark.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k).collect()
        yield Items([r["item_id"] for r in rows], [r["text"] for r in rows])


_SO_FAR = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))


def _pass(shared, last: bool, keep_clean: bool, so_far: tuple[str, str]):
    """One part's hits, joined to those of the parts before (columns ``so_far``: ranges and names)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrays.slices(batches, "text"):
            n_words, ranges, names = hits(batch.column("text"), shared.value)
            if so_far[0] in batch.schema.names:
                before = zip(*(batch.column(c).to_pylist() for c in so_far), strict=True)
                for i, (old, named) in enumerate(before):
                    ranges[i] += [(r["a"], r["b"]) for r in old]
                    names[i] |= set(named)
                batch = batch.drop_columns(list(so_far))
            if not last:
                ranges = [[{"a": a, "b": b} for a, b in own] for own in ranges]
                made = [pa.array(ranges, _SO_FAR), pa.array([sorted(s) for s in names], pa.list_(pa.string()))]
                yield pa.RecordBatch.from_arrays([*batch.columns, *made], [*batch.schema.names, *so_far])
            elif keep_clean:
                yield batch.filter(pa.array([not own for own in ranges], pa.bool_()))
            else:
                n_hit = [_covered(own) for own in ranges]
                named = [sorted(s - {""}) for s in names]
                made = [pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()), pa.array([len(s) for s in named], pa.int64())]
                made.append(pa.array([hashlib.sha256(",".join(s).encode()).hexdigest() for s in named], pa.string()))
                made.append(pa.array([n > 0 for n in n_hit], pa.bool_()))
                names_out = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *made], names_out)

    return run


def _covered(ranges: list[tuple[int, int]]) -> int:
    total, end = 0, 0
    for a, b in sorted(ranges):
        total += max(0, b - max(a, end))
        end = max(end, b)
    return total


def _passes(docs: DataFrame, benchmark: DataFrame, result: str, keep_clean: bool, part_bytes: int) -> DataFrame:
    parts = list(_parts_shared(docs, benchmark, part_bytes))
    fields = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    free = "_" * (1 + max(map(len, docs.columns)))  # no column has such a name
    so_far = (f"{free}ranges", f"{free}names")
    for shared in parts[:-1]:
        more = f"{so_far[0]} array<struct<a: long, b: long>>, {so_far[1]} array<string>"
        docs = docs.mapInArrow(_pass(shared, False, keep_clean, so_far), f"{fields}, {more}")
    return docs.mapInArrow(_pass(parts[-1], True, keep_clean, so_far), result or fields)


def _parts_shared(docs: DataFrame, benchmark: DataFrame, part_bytes: int):
    for items in _parts(benchmark, part_bytes):
        yield docs.sparkSession.sparkContext.broadcast(items)  # PART_BYTES bounds it


def contamination(docs: DataFrame, benchmark: DataFrame, part_bytes: int = PART_BYTES) -> DataFrame:
    """Per row of ``docs(doc_id, text)``: words, words hit by windows of ``benchmark(item_id, text)``, and items."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return _passes(docs, benchmark, _RESULT, False, part_bytes)


def without_benchmark(docs: DataFrame, benchmark: DataFrame, part_bytes: int = PART_BYTES) -> DataFrame:
    """The rows of ``docs``, all columns, whose text has no window of the benchmark."""
    return _passes(docs, benchmark, "", True, part_bytes)

"""Divergence of sources: how far the words of a source are from its language and its other sources.

Chances of terms are whole numbers of a billionth with one added to each count, and a term's
share of a divergence is ``(p - q)^2 div q``; all of it is integer arithmetic.

**Terms of a group.** That share grows with the term's count in the group and falls with its
count in the language. So if k terms have at least the count of a term in the group, at most its
count in the language, and come before it as UTF-8, they also come before it in the ranking: a
term dominated by k others is not among the first k. Each partition retains its skyband, the
terms dominated by fewer than k others; the skybands of partitions are merged in the same way,
and what is left is ranked exactly.

**Pairs of sources.** Terms are dealt out to ranges of about a thousand and sources to blocks of
64. A task has the chances of two blocks for one range as a small matrix. Terms that neither block
has are not in it: there are as many as the language has terms less those seen, and all of them
add the same.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from deskmill.llm.arrays import LOWER, slices, spans, utf8
from deskmill.llm.ordering import running
from deskmill.session import materialized

#: Documents of a language that a term must be in.
LEAST_DOCUMENTS = 3
#: Terms ranked for each group.
RANKS = 200
#: Terms of a range and sources of a block, for the pairs.
RANGE, BLOCK = 1024, 64
#: Parts in which the skybands of a group are merged.
MERGES = 8
#: Bytes of text counted at once.
_TEXT = 4 << 20
_CHUNK = 2048

#: Separators of `[^\x00-\x40\x5B-\x60\x7B-\x7F]+`, looked up after lowering.
NOT_TERM = np.ones(256, dtype=bool)
NOT_TERM[0x61:0x7B] = NOT_TERM[0x80:] = False

_COUNTS = ["lang", "source", "term", "n", "docs"]


def _strings(data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> pa.Array:
    """Spans of UTF-8 bytes as an Arrow array."""
    ends = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(stops - starts, out=ends[1:])
    at = np.arange(ends[-1]) + np.repeat(starts - ends[:-1], stops - starts)
    return pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(ends), pa.py_buffer(data[at]))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences of each term, and rows it is in, for each group of a slice of texts."""
    for batch in slices(batches, "text", _TEXT):
        data, offsets = utf8(batch.column("text"))
        data = LOWER[data]
        starts, stops, first = spans(data, offsets, NOT_TERM)
        if not len(starts):
            continue
        terms = _strings(data, starts, stops).dictionary_encode()
        langs, sources = (batch.column(c).dictionary_encode() for c in ("lang", "source"))
        size = len(terms.dictionary)
        codes = [np.asarray(a.indices, np.int64) for a in (langs, sources, terms)]
        group = codes[0] * len(sources.dictionary) + codes[1]
        rows = np.repeat(np.arange(batch.num_rows), np.diff(first))
        in_row, n = np.unique(rows * size + codes[2], return_counts=True)
        keys = group[in_row // size] * size + in_row % size
        order = np.argsort(keys, kind="stable")
        found, begin = np.unique(keys[order], return_index=True)
        of_group, term = found // size, found % size
        columns = [
            langs.dictionary.take(pa.array(of_group // len(sources.dictionary))),
            sources.dictionary.take(pa.array(of_group % len(sources.dictionary))),
            terms.dictionary.take(pa.array(term)).cast(pa.string()),
            pa.array(np.add.reduceat(n[order], begin)),
            pa.array(np.diff(begin, append=len(keys))),
        ]
        yield pa.RecordBatch.from_arrays(columns, _COUNTS)


def term_counts(texts: DataFrame, least: int = LEAST_DOCUMENTS) -> DataFrame:
    """``lang, source, term, n, lang_n, one`` of every kept term of ``texts(lang, source, text)``.

    ``n`` counts the term in the group and ``lang_n`` in the language; ``one`` is 1 in just one of
    the term's rows and 0 in the others.
    """
    found = texts.mapInArrow(_counted, "lang string, source string, term string, n long, docs long")
    counts = found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    of_term = Window.partitionBy("lang", "term")  # a row a source
    counts = counts.select(
        "lang",
        "source",
        "term",
        "n",
        (F.row_number().over(of_term.orderBy("source")) == 1).cast("int").alias("one"),
        F.sum("n").over(of_term).alias("lang_n"),
        F.sum("docs").over(of_term).alias("lang_docs"),
    )
    return counts.filter(F.col("lang_docs") >= least).drop("lang_docs")


def chance(count: Column, total: Column, terms: Column) -> Column:
    """``1 + 1000000000 * (count + 1) div (total + terms)``; 1 if there is no term."""
    wide = lambda c: c.cast("DECIMAL(20,0)")
    parts = wide(count + 1) * F.lit(1_000_000_000).cast("DECIMAL(10,0)")
    return F.coalesce(F.call_function("div", parts, wide(F.nullif(total + terms, F.lit(0)))), F.lit(0)) + 1


def share(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def _first_dominated(counts: np.ndarray, terms: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct language counts, ascending, and for each the k-th least term rank among those up to it."""
    order = np.argsort(counts, kind="stable")
    heap: list[int] = []
    bounds = np.empty(len(order), np.int64)
    for i, term in enumerate(terms[order].tolist()):
        if len(heap) < k:
            heapq.heappush(heap, -term)
        else:
            heapq.heappushpop(heap, -term)
        bounds[i] = -heap[0] if len(heap) == k else np.iinfo(np.int64).max
    values, begin = np.unique(counts[order], return_index=True)
    return values, bounds[np.append(begin[1:], len(order)) - 1]


class _Band:
    """Skyband of one group whose terms come by count descending, language count, term."""

    def __init__(self, k: int):
        self.k = k
        self.terms = pa.array([], pa.large_binary())
        self.counts = np.zeros(0, np.int64)

    def add(self, terms: pa.Array, counts: np.ndarray) -> np.ndarray:
        """Which of the terms are dominated by fewer than k of those before them.

        All that can dominate a term comes before it. One that was left out has k dominators
        that were retained, and they dominate whatever it dominates, so it need not be kept.
        """
        both = pa.concat_arrays([self.terms, terms])
        rank = np.empty(len(both), np.int64)
        rank[pc.array_sort_indices(both).to_numpy()] = np.arange(len(both))
        old, new = rank[: len(self.terms)], rank[len(self.terms) :]
        kept = np.arange(len(terms))
        if len(old) >= self.k:
            values, bounds = _first_dominated(self.counts, old, self.k)
            at = np.searchsorted(values, counts, side="right") - 1
            kept = kept[(at < 0) | (new <= bounds[at])]
        n, t = counts[kept], new[kept]
        above = np.zeros(len(kept), np.int64)
        step = max(1, (1 << 22) // (len(old) + 1))
        for i in range(0, len(kept), step):
            above[i : i + step] = ((self.counts <= n[i : i + step, None]) & (old < t[i : i + step, None])).sum(1)
        above += np.tril((n <= n[:, None]) & (t < t[:, None]), -1).sum(1)
        kept = kept[above < self.k]
        self.terms = pa.concat_arrays([self.terms, terms.take(pa.array(kept))])
        self.counts = np.concatenate([self.counts, counts[kept]])
        return kept


def _banded(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, band = None, None
        for batch in batches:
            kept = []
            names = list(zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist()))
            edges = [i for i in range(1, len(names)) if names[i] != names[i - 1]]
            for begin, end in zip([0, *edges], [*edges, len(names)]):
                if begin == end:
                    continue
                if names[begin] != group:
                    group, band = names[begin], _Band(k)
                for i in range(begin, end, _CHUNK):
                    some = batch.slice(i, min(_CHUNK, end - i))
                    terms = some.column("term").cast(pa.large_binary())
                    kept.append(i + band.add(terms, some.column("lang_n").to_numpy()))
            if kept:
                yield batch.take(pa.array(np.concatenate(kept)))

    return run


def skyband(rows: DataFrame, k: int) -> DataFrame:
    """Rows ``lang, source, term, n, lang_n, value`` dominated by fewer than ``k`` of their partition and group."""
    ordered = rows.sortWithinPartitions("lang", "source", F.desc("n"), "lang_n", "term")
    return ordered.mapInArrow(_banded(k), rows.schema)


def top_terms(kept: DataFrame, groups: DataFrame, ranks: int = RANKS) -> DataFrame:
    """``lang, source, item, value, rank``: the terms that a group has more of than its language."""
    p, q = (chance(F.col(n), F.col(total), F.col("terms")) for n, total in (("n", "group_total"), ("lang_n", "lang_total")))
    some = groups.select("lang", "source", "group_total", "lang_total", "terms")
    rows = kept.join(some, ["lang", "source"]).withColumns({"p": p, "q": q}).filter("p > q")
    rows = skyband(rows.select("lang", "source", "term", "n", "lang_n", share(F.col("p"), F.col("q")).alias("value")), ranks)
    merged = rows.repartition("lang", "source", F.pmod(F.xxhash64("term"), F.lit(MERGES)))
    return ranked(skyband(merged, ranks).withColumnRenamed("term", "item")).filter(F.col("rank") <= ranks)


def ranked(rows: DataFrame) -> DataFrame:
    """``lang, source, item, value, rank``: by value, then by item as UTF-8."""
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return rows.select("lang", "source", "item", "value", F.row_number().over(order).alias("rank"))


def _pairs(table: pa.Table) -> pa.Table:
    """Sums over the terms of a range for all ordered pairs between two blocks, or within one."""
    low, high = (table.column(c)[0].as_py() for c in ("low", "high"))
    place, p = table.column("place").to_numpy(), table.column("p").to_numpy()
    terms = table.column("term").combine_chunks()
    head = pc.is_null(terms).to_numpy(zero_copy_only=False)
    names = pc.drop_null(terms).dictionary_encode()
    members, none = place[head], p[head]
    order = np.argsort(members)
    members, none = members[order], none[order]
    dense = np.repeat(none[:, None], len(names.dictionary), axis=1)
    dense[np.searchsorted(members, place[~head]), np.asarray(names.indices, np.int64)] = p[~head]
    block = members // BLOCK
    made: list[list] = [[], [], []]
    for i, row in enumerate(dense):
        others = np.flatnonzero((block != block[i]) if low != high else (members != members[i]))
        gap = row - dense[others]
        made[0].append(np.full(len(others), members[i]))
        made[1].append(members[others])
        made[2].append((gap * gap // dense[others]).sum(1, dtype=np.int64))
    place, other, value = (np.concatenate([*m, np.zeros(0, np.int64)]).astype(np.int64) for m in made)
    seen = np.full(len(place), len(names.dictionary), np.int64)
    lang = pa.array([table.column("lang")[0].as_py()] * len(place), pa.string())
    return pa.table({"lang": lang, "place": place, "other": other, "value": value, "seen": seen})


def source_pairs(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """``lang, source, item, value, rank`` for each source and each other source of its language."""
    ranges = F.greatest(F.lit(1), F.ceil(F.col("terms") / RANGE)).cast("int")
    known = groups.select("lang", "source", "place", "sources", "group_total", "terms", ranges.alias("ranges"))
    known = known.withColumn("none", chance(F.lit(0).cast("long"), F.col("group_total"), F.col("terms")))
    found = kept.join(known, ["lang", "source"]).select(
        "lang",
        F.pmod(F.xxhash64("term"), F.col("ranges")).cast("int").alias("range"),
        "place",
        "sources",
        "term",
        chance(F.col("n"), F.col("group_total"), F.col("terms")).alias("p"),
    )
    heads = known.select(
        "lang",
        F.explode(F.sequence(F.lit(0), F.col("ranges") - 1)).alias("range"),
        "place",
        "sources",
        F.lit(None).cast("string").alias("term"),
        F.col("none").alias("p"),
    )
    mine, last = F.expr(f"place div {BLOCK}L"), F.expr(f"(sources - 1) div {BLOCK}L")
    rows = found.unionByName(heads).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    rows = rows.select("lang", F.least("other", mine).alias("low"), F.greatest("other", mine).alias("high"), "range", "place", "term", "p")
    parts = rows.groupBy("lang", "low", "high", "range").applyInArrow(_pairs, "lang string, place long, other long, value long, seen long")
    sums = parts.groupBy("lang", "place", "other").agg(F.sum("value").alias("value"), F.sum("seen").alias("seen"))
    this = known.select("lang", "place", "source", "none", "terms")
    that = known.select("lang", F.col("place").alias("other"), F.col("source").alias("item"), F.col("none").alias("other_none"))
    rest = (F.col("terms") - F.col("seen")) * share(F.col("none"), F.col("other_none"))
    named = sums.join(this, ["lang", "place"]).join(that, ["lang", "other"])
    return ranked(named.withColumn("value", F.col("value") + rest))


def divergence(docs: DataFrame, least: int = LEAST_DOCUMENTS, ranks: int = RANKS) -> DataFrame:
    """``lang, source, part, item, value, rank`` of every group of ``docs(text, lang, source)``.

    NULL in a column reads as ''. A group without terms still has its pairs; a language with one
    source has no pairs, and no terms, as its chances are those of the language; one without
    kept terms gives pairs of value 0. Repeated rows are documents of their own; an empty table
    gives no rows. Other columns are left out.
    """
    texts = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    kept = materialized(term_counts(texts, least), "terms")
    named = materialized(texts.select("lang", "source").distinct(), "groups")
    placed = running(named, ["lang"], ["source"], {"place": F.lit(1)}).withColumnRenamed("place_total", "sources")
    of_group = kept.groupBy("lang", "source").agg(F.sum("n").alias("group_total"))
    of_lang = kept.groupBy("lang").agg(F.sum("n").alias("lang_total"), F.sum("one").alias("terms"))
    groups = placed.join(of_group, ["lang", "source"], "left").join(of_lang, "lang", "left")
    groups = materialized(groups.fillna(0, ["group_total", "lang_total", "terms"]), "chances")
    parts = {"pair": source_pairs(kept, groups), "term": top_terms(kept, groups, ranks)}
    pair, term = (rows.withColumn("part", F.lit(name)) for name, rows in parts.items())
    return pair.unionByName(term).select("lang", "source", "part", "item", "value", F.col("rank").cast("int").alias("rank"))

"""Quality rules: counts that junk stands out by, and bands of n-gram perplexity per language.

Modified Kneser-Ney models over four code points are counted by Spark, one for each language
and half of the corpus (halves by a digest of the text). A document is scored by the model
of its own language from the half it is not in, so that it cannot vouch for itself, nor an exact
copy for another. Grams are told apart in full and are as many as the corpus holds: counts of
all levels, backoff weights and chances are joins of tables, and the model is a table of
64-bit gram hashes in sorted order with the losses that both halves give.

Texts of one language are packed into chunks. A chunk asks for the losses of its distinct grams
and gets them as arrays in the order of their hashes; its texts then look them up. Chunks lie
in buckets by the task that made them, a file for each task: the losses go to where the texts
are, and texts are written once and never shuffled. The bands
around the median of a language take its spread over all documents and, for short texts, the
spread that chance alone gives; a document outside them is rejected: below are texts that
repeat themselves or the corpus, above is what the language's model does not expect.

Defined results: NULL and empty text has no words and fails the base rules; rows without a
language, or with an empty one, are a language of their own; rows of equal text and language
are judged alike, whatever their id; a language of one text has its own loss as its band.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deskmill.llm import arrays
from deskmill.llm.lm_scores import added, distinct
from deskmill.session import materialized, scratch, setting

#: Base rules.
LEAST_WORDS, REPEAT_WORDS, MOST_REPEATED = 20, 8, 30
#: Band in robust deviations below and above the median.
BELOW, ABOVE = 12.0, 6.5
#: Deviations of a text's own chance spread that are allowed on top.
OWN = 1.5
#: Code points of a gram, and bits of one.
ORDER, BITS = 4, 21
#: Bytes of text of a chunk, and bytes a task sorts by language before it cuts them; one text stays whole.
CHUNK_BYTES, HELD_BYTES = 8 << 20, 48 << 20
#: Code points whose grams are handled at once, and bytes of text.
BLOCK, SLICE_BYTES = 1 << 17, 1 << 18
#: How hard a chunk's texts are compressed, which are written once.
LEVEL = 4
#: Buckets that Spark allows by default.
MOST_BUCKETS = 100_000

#: Rows that Spark hands to Python at once, which it holds on both sides.
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"

SYMBOLS = arrays.byte_table("#*$%&|<>")

_CHUNKS = (
    "part long, chunk long, lang string, ids array<long>, digests array<string>, texts binary, "
    "pre array<long>, last array<int>, n_0 array<long>, n_1 array<long>"
)
_SCORED = (
    "doc_id long, lang string, digest string, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
    "n_repeat_words long, base_failed boolean, loss double, own_spread double"
)
_COUNTED = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def base_counts(texts: pa.Array) -> dict[str, np.ndarray]:
    """Words, their characters, symbols, repeated lines and repeated words of every text."""
    data, offsets = arrays.utf8(texts)
    starts, stops, first = arrays.spans(data, offsets, arrays.BLANK)
    n_words = np.diff(first)
    leads = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=leads[1:])
    chars = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(leads[stops] - leads[starts], out=chars[1:])
    symbols = np.zeros(len(data) + 1, np.int64)
    np.cumsum(SYMBOLS[data], out=symbols[1:])
    return {
        "n_words": n_words,
        "word_chars": chars[first[1:]] - chars[first[:-1]],
        "n_symbols": symbols[offsets[1:]] - symbols[offsets[:-1]],
        "n_dup_lines": _repeated_lines(data, offsets, starts),
        "n_repeat_words": _repeated_words(arrays.span_hashes(data, starts, stops), first),
    }


_NOT_LINE = np.zeros(256, bool)
_NOT_LINE[0x0A] = True


def _repeated_lines(data: np.ndarray, offsets: np.ndarray, word_starts: np.ndarray) -> np.ndarray:
    starts, stops, first = arrays.spans(data, offsets, _NOT_LINE)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    filled = np.searchsorted(word_starts, stops) > np.searchsorted(word_starts, starts)
    starts, stops, row = starts[filled], stops[filled], row[filled]
    hashes = arrays.span_hashes(data, starts, stops)
    _, example = np.unique(arrays.mixed(hashes + row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), return_index=True)
    n = len(offsets) - 1
    return np.bincount(row, minlength=n) - np.bincount(row[example], minlength=n)


def _repeated_words(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    grams = arrays.gram_hashes(hashes, REPEAT_WORDS)
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    at = np.flatnonzero(np.arange(len(grams)) + REPEAT_WORDS <= first[1:][row[: len(grams)]])
    keys = arrays.mixed(grams[at] + row[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    ordered = np.sort(keys)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    covered = np.zeros(len(hashes) + 1, np.int64)
    if len(twice):
        spot = np.minimum(np.searchsorted(twice, keys), len(twice) - 1)
        begin = at[twice[spot] == keys]
        covered[begin] += 1
        np.add.at(covered, begin + REPEAT_WORDS, -1)
    total = np.zeros(len(hashes) + 1, np.int64)
    np.cumsum(np.cumsum(covered[:-1]) > 0, out=total[1:])
    return total[first[1:]] - total[first[:-1]]


def base_fails(counts: dict[str, np.ndarray]) -> np.ndarray:
    return (counts["n_words"] < LEAST_WORDS) | (100 * counts["n_repeat_words"] > MOST_REPEATED * counts["n_words"])


def code_points(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts joined, and the offsets at which each text's begin."""
    data, offsets = arrays.utf8(texts)
    ends = np.add.reduceat(np.append((data & 0xC0) != 0x80, False).astype(np.int32), np.minimum(offsets[:-1], len(data)))
    lengths = np.where(offsets[1:] > offsets[:-1], ends, 0)
    return np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32), np.concatenate([[0], np.cumsum(lengths)])


def gram_hashes(pre: np.ndarray, last: np.ndarray) -> np.ndarray:
    return arrays.mixed(arrays.mixed(pre.view(np.uint64)) + last.astype(np.uint64) * np.uint64(0x9FB21C651E98DF25))


def grams(points: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Of every code point, in blocks: row, the three points before it, itself, and a hash of the gram.

    Points before a text's begin are 0, so that a text has a gram for each of its points.
    """
    for a in range(0, len(points), BLOCK):
        b = min(len(points), a + BLOCK)
        row = np.repeat(np.arange(len(offsets) - 1), np.diff(np.clip(offsets, a, b)))
        place = np.arange(a, b) - offsets[row]
        pre = np.zeros(b - a, np.int64)
        for back in range(1, ORDER):
            # Code point 0 in a text is told from its begin by one more.
            known = max(0, back - a)  # none before the first text
            history = np.zeros(b - a, np.int64)
            history[known:] = points[a + known - back : b - back]
            history += 1
            history[place < back] = 0
            pre |= history << np.int64(BITS * (back - 1))
        last = points[a:b].astype(np.int32)
        yield row, pre, last, gram_hashes(pre, last)


def _in_slices(texts: pa.Array) -> Iterator[tuple[slice, pa.Array]]:
    """The texts, ``SLICE_BYTES`` or one text at a time, and which of them these are."""
    start = 0
    for batch in arrays.slices([pa.RecordBatch.from_arrays([texts], ["text"])], "text", SLICE_BYTES):
        yield slice(start, start + batch.num_rows), batch.column("text")
        start += batch.num_rows


def _distinct(points: np.ndarray, offsets: np.ndarray, half: np.ndarray) -> list[np.ndarray]:
    """Distinct grams in the order of their hashes: hash, three points, last point, counts in both halves."""
    return _merged(_counted(points, offsets, half))


def _distinct_of(texts: pa.Array, half: np.ndarray) -> list[np.ndarray]:
    """The same of texts whose code points are not held all at once."""
    return _merged(part for own, some in _in_slices(texts) for part in _counted(*code_points(some), half[own]))


def _counted(points: np.ndarray, offsets: np.ndarray, half: np.ndarray) -> Iterator[list[np.ndarray]]:
    for row, pre, last, keys in grams(points, offsets):
        own = np.unique(keys)
        where = places(own, keys)
        one = np.empty(len(own), np.int64)
        one[where] = np.arange(len(keys))
        second = np.bincount(where, half[row], len(own)).astype(np.int64)
        yield [own, pre[one], last[one], np.bincount(where, minlength=len(own)) - second, second]


def _merged(counted: Iterable[list[np.ndarray]]) -> list[np.ndarray]:
    parts = list(counted)
    if not parts:
        return [np.zeros(0, t) for t in (np.uint64, np.int64, np.int32, np.int64, np.int64)]
    keys, pre, last, n_0, n_1 = (np.concatenate(c) for c in zip(*parts, strict=True))
    own, order, starts = distinct(keys)
    one = order[starts]
    return [own, pre[one], last[one], *(added(n, order, starts) for n in (n_0, n_1))]


def places(own: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Where each key is among sorted distinct hashes that hold them all: by its first bits, then step by step."""
    bits = len(own).bit_length() + 3
    shift = np.uint64(64 - bits)
    starts = np.searchsorted(own, np.arange(1 << bits, dtype=np.uint64) << shift)
    at = starts[keys >> shift]
    wrong = np.flatnonzero(own[at] != keys)
    while len(wrong):
        at[wrong] += 1
        wrong = wrong[own[at[wrong]] != keys[wrong]]
    return at


def _second_half(digests: list[str]) -> np.ndarray:
    return np.array([int(d[-1], 16) & 1 for d in digests], np.int64)


_CHUNK_FIELDS = pa.schema(
    [("part", pa.int64()), ("chunk", pa.int64()), ("lang", pa.string()), ("ids", pa.list_(pa.int64())), ("digests", pa.list_(pa.string())), ("texts", pa.binary())]
    + [("pre", pa.list_(pa.int64())), ("last", pa.list_(pa.int32())), ("n_0", pa.list_(pa.int64())), ("n_1", pa.list_(pa.int64()))]
)


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part = TaskContext.get().partitionId()
    chunk = part << 32
    codec = pa.Codec("zstd", LEVEL)
    held: list[pa.RecordBatch] = []

    def hand_on() -> Iterator[pa.RecordBatch]:
        nonlocal chunk
        table = pa.Table.from_batches(held).sort_by("lang")
        held.clear()  # the sorted rows are a copy
        names = table.column("lang").to_pylist()
        starts = [0, *(i for i in range(1, len(names)) if names[i] != names[i - 1]), len(names)]
        for a, b in zip(starts[:-1], starts[1:], strict=True):
            for batch in arrays.slices(table.slice(a, b - a).combine_chunks().to_batches(), "text", CHUNK_BYTES):
                data, offsets = arrays.utf8(batch.column("text"))
                digests = batch.column("digest").to_pylist()
                found = _distinct_of(batch.column("text"), _second_half(digests))
                raw = np.diff(offsets).tobytes() + data.tobytes()
                raw = len(raw).to_bytes(8, "little") + codec.compress(raw, asbytes=True)
                del data, offsets
                row = [[part], [chunk], [names[a]], [batch.column("doc_id").to_pylist()], [digests], [raw], *([c] for c in found[1:])]
                yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(row, _CHUNK_FIELDS, strict=True)], schema=_CHUNK_FIELDS)
                chunk += 1

    size = 0
    for batch in arrays.slices(batches, "text", CHUNK_BYTES):
        held.append(batch)
        size += batch.nbytes
        if size > HELD_BYTES:
            yield from hand_on()
            pa.default_memory_pool().release_unused()
            size = 0
    if held:
        yield from hand_on()
    pa.default_memory_pool().release_unused()  # the worker goes on to other tasks


def _type(history: int, name: str) -> Column:
    """The points before the last one that a level takes: the ``history`` nearest ones."""
    return F.col(name).bitwiseAND(F.lit((1 << (BITS * history)) - 1))


def _discounts(level: DataFrame) -> DataFrame:
    """``lang, d_0, d_1``: what is taken off counts of 1, 2 and more, from the counts of counts."""
    of = [F.count_if(F.col(f"n_{f}") == k).cast("double").alias(f"c{k}_{f}") for f in (0, 1) for k in (1, 2, 3, 4)]
    made = []
    for f in (0, 1):
        n = [F.col(f"c{k}_{f}") for k in (1, 2, 3, 4)]
        y = F.when(n[0] > 0, n[0] / (n[0] + 2 * n[1])).otherwise(0.5)
        off = [F.when(n[k] > 0, F.greatest(F.lit(0.05), (k + 1) - (k + 2) * y * n[k + 1] / n[k])).otherwise(rest) for k, rest in enumerate((0.5, 0.75, 0.9))]
        made.append(F.array(*off).alias(f"d_{f}"))
    return level.groupBy("lang").agg(*of).select("lang", *made)


def chances(counted: DataFrame) -> DataFrame:
    """``lang, pre, last, p_0, p_1``: the chance that each half's model gives every gram of either half.

    ``counted(lang, pre, last, n_0, n_1)`` holds the counts of all grams. Modified Kneser-Ney:
    lower levels count the different points that a gram follows, three discounts a level,
    and what they take off goes to the level below; below the last, all points of a language are equal.
    """
    levels = [counted]
    for history in range(ORDER - 2, -1, -1):
        shorter = levels[-1].groupBy("lang", _type(history, "pre").alias("pre"), "last")
        levels.append(materialized(shorter.agg(*(F.count_if(F.col(f"n_{f}") > 0).alias(f"n_{f}") for f in (0, 1))), "level"))
    lower = None
    for history, level in enumerate(reversed(levels)):
        sums = [F.sum(f"n_{f}").cast("double").alias(f"total_{f}") for f in (0, 1)]
        kinds = [F.count_if(F.col(f"n_{f}") == k if k < 3 else F.col(f"n_{f}") >= 3).alias(f"k{k}_{f}") for f in (0, 1) for k in (1, 2, 3)]
        histories = level.groupBy("lang", "pre").agg(*sums, *kinds, F.count("*").alias("points"))
        # One row a language, written first: the planner sees its size.
        histories = histories.join(materialized(_discounts(level), "discounts"), "lang")
        weights = [sum(F.col(f"d_{f}")[k - 1] * F.col(f"k{k}_{f}") for k in (1, 2, 3)).alias(f"rest_{f}") for f in (0, 1)]
        histories = histories.select("lang", "pre", "points", "d_0", "d_1", "total_0", "total_1", *weights)
        joined = level.join(histories, ["lang", "pre"])
        if lower is None:
            joined = joined.select("*", *((1 / F.col("points")).alias(f"below_{f}") for f in (0, 1)))
        else:
            nearest = lower.select("lang", F.col("pre").alias("nearer"), "last", F.col("p_0").alias("below_0"), F.col("p_1").alias("below_1"))
            joined = joined.withColumn("nearer", _type(history - 1, "pre")).join(nearest, ["lang", "nearer", "last"])
        made = []
        for f in (0, 1):
            n, total = F.col(f"n_{f}"), F.col(f"total_{f}")
            off = F.when(n > 0, F.col(f"d_{f}")[F.least(n, F.lit(3)).cast("int") - 1]).otherwise(0.0)
            p = (n - off + F.col(f"rest_{f}") * F.col(f"below_{f}")) / total
            made.append(F.when(total > 0, p).otherwise(F.col(f"below_{f}")).alias(f"p_{f}"))
        lower = materialized(joined.select("lang", "pre", "last", *made), "chances")
    return lower


def _key() -> Column:
    return F.xxhash64("lang", "pre", "last").alias("key")


def _model(chunks: DataFrame) -> DataFrame:
    """``key, loss_0, loss_1`` of every gram, in ranges of the hash and in its order."""
    each = chunks.select("lang", F.inline(F.arrays_zip("pre", "last", "n_0", "n_1")))
    counted = each.groupBy("lang", "pre", "last").agg(F.sum("n_0").alias("n_0"), F.sum("n_1").alias("n_1"))
    found = chances(materialized(counted, "grams"))
    losses = [(-F.log(f"p_{f}")).cast("float").alias(f"loss_{f}") for f in (0, 1)]
    return materialized(found.select(_key(), *losses).repartitionByRange("key").sortWithinPartitions("key"), "model")


def _score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for several in batches:
        for i in range(several.num_rows):
            chunk = {name: several.column(name)[i] for name in several.schema.names}
            ids, digests = chunk["ids"].values, chunk["digests"].values
            raw = chunk["texts"].as_buffer()
            raw = pa.decompress(raw.slice(8), int.from_bytes(raw.slice(0, 8).to_pybytes(), "little"), codec="zstd")
            at = np.zeros(len(ids) + 1, np.int64)
            np.cumsum(np.frombuffer(raw, np.int64, len(ids)), out=at[1:])
            texts = pa.LargeStringArray.from_buffers(len(ids), pa.py_buffer(at.tobytes()), raw.slice(8 * len(ids)))
            asked = gram_hashes(*(chunk[name].values.to_numpy() for name in ("pre", "last")))
            mean, spread = _losses(texts, _second_half(digests.to_pylist()), asked, chunk["found"])
            for own, some in _in_slices(texts):
                counts = base_counts(some)
                made = [pa.array(counts[c], pa.int64()) for c in _COUNTED]
                made += [pa.array(base_fails(counts)), pa.array(mean[own]), pa.array(spread[own])]
                langs = pa.array([chunk["lang"].as_py()] * len(some), pa.string())
                yield pa.RecordBatch.from_arrays([ids[own], langs, digests[own], *made], ["doc_id", "lang", "digest", *_COUNTED, "base_failed", "loss", "own_spread"])
            pa.default_memory_pool().release_unused()


def _losses(texts: pa.Array, half: np.ndarray, asked: np.ndarray, found: pa.Scalar) -> tuple[np.ndarray, np.ndarray]:
    """Mean loss a code point by the other half's model, and the spread that chance gives it, for every text."""
    n, sums, squares = np.zeros(len(half), np.int64), np.zeros(len(half)), np.zeros(len(half))
    losses = np.zeros((2, len(asked)))
    if len(asked):
        answers = found.values.flatten()
        place = answers[0].to_numpy()
        losses[0, place], losses[1, place] = answers[1].to_numpy(), answers[2].to_numpy()
    for own, some in _in_slices(texts):
        points, offsets = code_points(some)
        n[own] = np.diff(offsets)
        for row, _, _, keys in grams(points, offsets):
            loss = losses[1 - half[own][row], places(asked, keys)]
            sums[own] += np.bincount(row, loss, len(some))
            squares[own] += np.bincount(row, loss * loss, len(some))
    many = np.maximum(n, 1)
    mean = sums / many
    # Rounded, so that equal texts get equal figures wherever they lie in a chunk.
    return np.round(mean, 9), np.round(np.sqrt(np.maximum(0, squares / many - mean * mean) / many), 9)


_DIGEST = "md5(cast(coalesce(cast(text AS string), '') AS binary))"
_LANG = "coalesce(cast(lang AS string), '')"


def _scored(docs: DataFrame) -> DataFrame:
    """Counts, loss and chance spread of every row, written once."""
    plain = docs.selectExpr("cast(doc_id AS long) AS doc_id", "cast(text AS string) AS text", f"{_LANG} AS lang", f"{_DIGEST} AS digest")
    with setting(docs.sparkSession, _BATCH, 1000):
        chunks, name = _bucketed(plain.mapInArrow(_pack, _CHUNKS), "part", "chunks")
    asked = chunks.select("part", "chunk", "lang", F.posexplode(F.arrays_zip("pre", "last")).alias("place", "gram"))
    asked = asked.select("part", "chunk", "place", F.xxhash64("lang", "gram.pre", "gram.last").alias("key"))
    answers = asked.join(_model(chunks), "key").groupBy("part").agg(F.collect_list(F.struct("chunk", "place", "loss_0", "loss_1")).alias("answers"))
    whole = chunks.select("part", "chunk", "lang", "ids", "digests", "texts", "pre", "last").join(answers, "part", "left")
    own = F.transform(F.filter("answers", lambda x: x["chunk"] == F.col("chunk")), lambda x: F.struct(x["place"], x["loss_0"], x["loss_1"]))
    whole = whole.select("chunk", "lang", "ids", "digests", "texts", "pre", "last", own.alias("found"))
    with setting(docs.sparkSession, _BATCH, 1):  # a chunk is megabytes
        scored = materialized(whole.mapInArrow(_score, _SCORED), "scored")
    docs.sparkSession.sql(f"DROP TABLE IF EXISTS {name}")
    return scored


def _bucketed(df: DataFrame, column: str, label: str) -> tuple[DataFrame, str]:
    """Written once to the shared folder, in as many buckets as shuffles have partitions, and the table's name."""
    spark = df.sparkSession
    n = min(MOST_BUCKETS, int(spark.conf.get("spark.sql.shuffle.partitions")))
    name = f"{label}_{uuid.uuid4().hex}"
    df.write.bucketBy(n, column).option("path", scratch(spark, label)).saveAsTable(name)
    return spark.table(name), name


def bands(scored: DataFrame, below: float = BELOW, above: float = ABOVE) -> DataFrame:
    """``lang, middle, below, above``: the median loss of each language and the half-widths of its band."""
    quarters = F.percentile_approx("loss", F.array(*map(F.lit, (0.25, 0.5, 0.75))), 10_000)
    each = scored.filter("NOT base_failed").groupBy("lang").agg(quarters.alias("q"))
    spread = F.greatest((F.col("q")[2] - F.col("q")[0]) / 1.349, F.lit(0.01))
    return each.select("lang", F.col("q")[1].alias("middle"), (spread * below).alias("below"), (spread * above).alias("above"))


def _judged(docs: DataFrame, below: float, above: float) -> DataFrame:
    scored = _scored(docs)
    whole = scored.join(materialized(bands(scored, below, above), "bands"), "lang", "left")
    allowed = OWN * F.col("own_spread")
    inside = (F.col("loss") >= F.col("middle") - F.sqrt(F.col("below") ** 2 + allowed**2)) & (
        F.col("loss") <= F.col("middle") + F.sqrt(F.col("above") ** 2 + allowed**2)
    )
    return whole.withColumn("kept", ~F.col("base_failed") & F.coalesce(inside, F.lit(True)))


def quality(docs: DataFrame, below: float = BELOW, above: float = ABOVE) -> DataFrame:
    """Base counts and the verdict for every row of ``docs(doc_id, text, lang)``.

    ``perplexity`` is that of a code point; ``kept`` is false for rows that fail the base
    rules or lie outside their language's band.
    """
    return _judged(docs, below, above).select("doc_id", *_COUNTED, "base_failed", "kept", F.exp("loss").alias("perplexity"))


def of_quality(docs: DataFrame, below: float = BELOW, above: float = ABOVE) -> DataFrame:
    """The rows of ``docs``, all columns, that the rules keep: a verdict goes by text and language."""
    rejected = _judged(docs, below, above).filter("NOT kept").select("digest", "lang").distinct()
    rejected = materialized(rejected.withColumnRenamed("lang", "language"), "rejected").alias("rejected_texts")
    same = (F.expr(_DIGEST) == F.col("rejected_texts.digest")) & (F.expr(_LANG) == F.col("rejected_texts.language"))
    return docs.join(rejected, same, "left_anti")

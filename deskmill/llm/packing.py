"""Packing documents into sequences of a fixed length by non-negative least squares.

A document longer than the window fills whole windows first; what is left, its tail, has a
length below the window. Tails of one length are alike, so packing is planned on the
histogram of lengths alone: shallow combinations of lengths that fill the window exactly are
the columns of a least-squares problem, and their repeat counts, not negative, should use up
the histogram. Counts are rounded, and what is left is packed greedily, longest first.
The plan has a bounded number of lines, whatever the number of documents: it gives ranges of
each length's tails a range of sequences. Spark numbers the tails of each length and looks
the numbers up in the plan; no document is cut but at whole windows.

Defined results: NULL and empty text have the end id alone; every row is packed, repeated
rows too; an empty table gives no pieces.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from deskmill.llm import arrays
from deskmill.llm.tokens import encoder
from deskmill.session import materialized

WINDOW = 2048
#: Lengths of a combination at most.
DEPTH = 3
#: Combinations of three lengths tried for each longest length.
TRIPLES = 24
SWEEPS = 60
_MEASURED = "doc_id long, doc_tokens long, windows array<long>, tail int, tail_crc long"


def _measure(path: str, end_id: int, window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrays.slices(batches, "text"):
            ids, ends = encoder(path).encode(batch.column("text"))
            tokens, windows, tails, crcs = [], [], [], []
            for a, b in zip(ends[:-1], ends[1:], strict=True):
                own = np.append(ids[a:b], np.uint32(end_id)).astype("<u4")
                full = len(own) // window
                tokens.append(len(own))
                windows.append([zlib.crc32(own[k * window : (k + 1) * window].tobytes()) for k in range(full)])
                tails.append(len(own) - full * window)
                crcs.append(zlib.crc32(own[full * window :].tobytes()))
            columns = [pa.array(tokens, pa.int64()), pa.array(windows, pa.list_(pa.int64())), pa.array(tails, pa.int32())]
            names = ["doc_id", "doc_tokens", "windows", "tail", "tail_crc"]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns, pa.array(crcs, pa.int64())], names)

    return run


def combinations(counts: np.ndarray) -> np.ndarray:
    """Rows of up to three lengths, zero-padded, longest first, that fill the window exactly.

    ``counts[l]`` is the number of tails of length l. Triples are spread evenly over the
    second lengths there are for a longest one.
    """
    window = len(counts)
    there = np.flatnonzero(counts)
    there = there[there > 0]
    known = np.zeros(window + 1, bool)
    known[there] = True
    rows = []
    for longest in there[::-1]:
        rest = window - longest
        if rest <= longest and known[rest]:
            rows.append((longest, rest, 0))
        second = there[(there <= min(longest, rest - 1)) & (2 * there >= rest)]
        second = second[known[rest - second]]
        if len(second):
            pick = second[np.unique(np.linspace(0, len(second) - 1, min(TRIPLES, len(second))).astype(int))]
            rows += [(longest, s, rest - s) for s in pick]
    return np.array(rows, np.int64).reshape(-1, DEPTH)


def repeat_counts(rows: np.ndarray, counts: np.ndarray, sweeps: int = SWEEPS) -> np.ndarray:
    """Non-negative least squares: how often each combination should be used.

    Minimises the squared distance between the lengths used and the histogram by projected
    gradient steps with momentum; a column has at most three entries, so a step is cheap.
    """
    if not len(rows):
        return np.zeros(0)
    target = counts.astype(float)
    used = np.zeros(len(counts))
    cells = rows.ravel()
    owner = np.repeat(np.arange(len(rows)), DEPTH)
    solid = cells > 0
    cells, owner = cells[solid], owner[solid]
    # The greatest column sum of A'A bounds its norm.
    degree = np.bincount(cells, minlength=len(counts)).astype(float)
    step = 1.0 / max(1.0, np.max(np.bincount(owner, degree[cells], minlength=len(rows))))
    x = np.zeros(len(rows))
    y, t = x.copy(), 1.0
    for _ in range(sweeps * 10):
        used = np.bincount(cells, y[owner], minlength=len(counts))
        gradient = np.bincount(owner, (used - target)[cells], minlength=len(rows))
        new = np.maximum(0.0, y - step * gradient)
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y = new + (t - 1) / t_new * (new - x)
        x, t = new, t_new
    return x


def plan(counts: np.ndarray) -> np.ndarray:
    """Lines ``length, first rank, end rank, first sequence, offset`` that pack the histogram.

    A tail of that length and rank r lies in sequence first sequence + r - first rank.
    """
    left = counts.astype(np.int64).copy()
    left[0] = 0
    taken = np.zeros(len(counts), np.int64)
    lines, sequence = [], 0

    def use(lengths: list[int], times: int) -> None:
        nonlocal sequence
        offset = 0
        for length in lengths:
            lines.append((length, taken[length], taken[length] + times, sequence, offset))
            taken[length] += times
            left[length] -= times
            offset += length
        sequence += times

    rows = combinations(left)
    exact = repeat_counts(rows, left)
    whole = np.floor(exact)
    # Whole counts first; then those that round up once more, the largest remainders first.
    by_rest = np.argsort(whole - exact, kind="stable")
    for row, wanted in [*zip(rows, whole, strict=True), *((rows[i], 1) for i in by_rest if exact[i] - whole[i] >= 0.5)]:
        lengths = [int(v) for v in row if v]
        n = min([int(wanted), *(int(left[v]) // lengths.count(v) for v in lengths)])
        if n > 0:
            # A length that comes twice takes one range of ranks after the other.
            use(lengths, n)
    window = len(counts)
    while left.any():
        longest = int(np.flatnonzero(left)[-1])
        chosen, spare = [longest], window - longest
        rest = left.copy()
        rest[longest] -= 1
        while spare:
            fits = np.flatnonzero(rest[: spare + 1])
            if not len(fits):
                break
            chosen.append(int(fits[-1]))
            rest[fits[-1]] -= 1
            spare -= int(fits[-1])
        n = min(int(left[v]) // chosen.count(v) for v in set(chosen))
        use(chosen, n)
    return np.array(sorted(lines), np.int64).reshape(-1, 5)


def _place(lines, window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = lines.value
        keys = table[:, 0] << 44 | table[:, 1]
        for batch in batches:
            length = batch.column("tail").to_numpy().astype(np.int64)
            rank = batch.column("rank").to_numpy()
            line = table[np.searchsorted(keys, length << 44 | rank, side="right") - 1]
            tokens = batch.column("doc_tokens").to_numpy()
            made = [pa.array(tokens - length), pa.array(length), batch.column("tail_crc"), batch.column("doc_tokens")]
            placed = [pa.array(line[:, 3] + rank - line[:, 1]), pa.array(line[:, 4])]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *made, *placed], _PIECE_NAMES)

    return run


_PIECE_NAMES = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def pack(docs: DataFrame, tokenizer: str, end_id: int = 1, window: int = WINDOW) -> DataFrame:
    """One row for every piece of ``docs(doc_id, text)``; sequences hold at most ``window`` ids.

    ``sequence_id`` counts the sequences of tails from 0; whole windows come after these,
    with ids that grow but leave gaps.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    measured = materialized(docs.mapInArrow(_measure(tokenizer, end_id, window), _MEASURED), "measured")
    counts = np.zeros(window, np.int64)
    for row in measured.filter("tail > 0").groupBy("tail").count().collect():  # less than a window of rows
        counts[row["tail"]] = row["count"]
    lines = plan(counts)
    shared = spark.sparkContext.broadcast(lines)  # at most DEPTH lines for each combination, and greedy ones
    n_sequences = int((lines[:, 3] + lines[:, 2] - lines[:, 1]).max()) if len(lines) else 0
    tails = measured.filter("tail > 0").select("doc_id", "doc_tokens", "tail", "tail_crc")
    pieces = numbered(tails).mapInArrow(_place(shared, window), _PIECES)
    full = measured.filter("size(windows) > 0").select("doc_id", "doc_tokens", F.posexplode("windows").alias("k", "ids_crc32"))
    full = full.select(
        "doc_id",
        (F.col("k").cast("long") * window).alias("start"),
        F.lit(window).cast("long").alias("length"),
        "ids_crc32",
        "doc_tokens",
        (F.monotonically_increasing_id() + n_sequences).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
    )
    return pieces.unionByName(full)


def numbered(tails: DataFrame) -> DataFrame:
    """Adds ``rank``, from 0 within each length.

    Each length is dealt over several times as many blocks as there are shuffle partitions
    and numbered within them, so that no length meets in one task.
    """
    blocks = 4 * int(tails.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Rows that are equal in all columns are alike to the plan, so any order among them will do.
    cut = tails.withColumn("_block", F.pmod(F.xxhash64("doc_id", "tail_crc"), F.lit(blocks)).cast("int"))
    before = Window.partitionBy("tail").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = cut.groupBy("tail", "_block").count().select("tail", "_block", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("tail", "_block").orderBy("doc_id", "tail_crc")
    ranked = cut.withColumn("_inside", F.row_number().over(inside))
    return ranked.join(starts, ["tail", "_block"]).withColumn("rank", F.col("_start") + F.col("_inside") - 1).drop("_block", "_start", "_inside")


@functools.cache
def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)

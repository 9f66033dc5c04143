"""Mixing sources to target weights that change in the course of training.

A source's schedule is a weight that runs in straight lines between knots over the progress of
training, from 0 to 1. Its mean is the weight by which the sources share all words. A source
whose share is more than it can give when repeated shares the excess out among the others. The
integral of a schedule says what part of its target a source has delivered at each moment; its
inverse says when the n-th word of a source is due. Documents follow in the order of that.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deskmill.llm.arrays import BLANK, slices, spans, utf8
from deskmill.llm.ordering import running
from deskmill.session import materialized

Knots = Sequence[tuple[float, float]]

#: Schedules that the sources take in turn: falling, steady and rising, with means 5, 2 and 1.
SCHEDULES: Sequence[Knots] = (
    ((0.0, 7.0), (0.5, 5.0), (1.0, 3.0)),
    ((0.0, 2.0), (1.0, 2.0)),
    ((0.0, 0.5), (0.5, 1.0), (1.0, 1.5)),
)
#: How often a source may be gone through.
REPEATS = 3

_EXACT = "DECIMAL(38,0)"


def _sized(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        data, offsets = utf8(batch.column("text"))
        counts = np.diff(spans(data, offsets, BLANK)[2]).astype(np.int64)
        columns = [batch.column("doc_id"), batch.column("origin"), pa.array(counts)]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "origin", "size"])


def mean(knots: Knots) -> float:
    """The integral of a schedule over all of training."""
    return sum((b - a) * (u + v) / 2 for (a, u), (b, v) in zip(knots, knots[1:]))


def targets(sources: DataFrame, schedules: Sequence[Knots], repeats: int) -> DataFrame:
    """``origin, source_size, turn, target`` from ``origin, source_size``; ``turn`` picks the schedule.

    Means of schedules are whole numbers. A source is full when its share passes ``repeats``
    times its size. Sources are taken in the order of that limit over their weight: one of them is
    full if it would be, were those before it all full. Sums along the two orders are running sums
    of a distributed sort, and exact.
    """
    weights = [mean(knots) for knots in schedules]
    if any(w != int(w) or w <= 0 for w in weights):
        raise ValueError("the mean of a schedule is a whole number above 0")
    turn = F.pmod(F.col("place"), F.lit(len(weights))).cast("int")
    placed = running(materialized(sources, "sources"), [], ["origin"], {"place": F.lit(1)})
    weighed = placed.select("origin", "source_size", turn.alias("turn")).withColumns(
        {"weight": F.element_at(F.array(*[F.lit(int(w)) for w in weights]), F.col("turn") + 1), "limit": F.col("source_size") * repeats}
    )
    ratio = (F.col("limit").cast("double") / F.col("weight")).alias("ratio")
    ordered = running(
        materialized(weighed.select("*", ratio), "weighed"),
        [],
        ["ratio", "origin"],
        {"limits": F.col("limit"), "weights": F.col("weight"), "all": F.col("source_size")},
    )
    exact = lambda name: F.col(name).cast(_EXACT)
    rest = exact("all_total") - exact("limits")
    full = exact("limit") * (exact("weights_total") - exact("weights")) < rest * exact("weight")
    judged = materialized(ordered.withColumn("full", full), "judged")
    of_rest = judged.agg(
        F.max("all_total").alias("all"),
        F.coalesce(F.sum(F.when(F.col("full"), F.col("limit"))), F.lit(0)).alias("taken"),
        F.coalesce(F.sum(F.when(~F.col("full"), F.col("weight"))), F.lit(0)).alias("free"),
    ).first()
    left, free = (of_rest["all"] or 0) - of_rest["taken"], max(1, of_rest["free"])  # three numbers
    share = (F.lit(left).cast(_EXACT) * exact("weight")).cast("double") / F.lit(free).cast("double")
    target = F.when(F.col("full"), F.col("limit").cast("double")).otherwise(share)
    return judged.select("origin", "source_size", "turn", target.alias("target"))


def due(part: Column, turn: Column, schedules: Sequence[Knots]) -> Column:
    """The progress at which a source has delivered ``part`` (0 to 1) of its target."""
    found = None
    for i, knots in enumerate(schedules):
        total, done = mean(knots), 0.0
        segments = []
        for (a, u), (b, v) in zip(knots, knots[1:]):
            area = (b - a) * (u + v) / 2 / total
            segments.append((a, b, u / total, (v - u) / (b - a) / total, done, done + area))
            done += area
        for a, b, rate, slope, begin, end in segments:
            rest = F.greatest(part - F.lit(begin), F.lit(0.0))
            root = F.sqrt(F.greatest(F.lit(rate * rate) + F.lit(2 * slope) * rest, F.lit(0.0)))
            at = F.least(F.lit(a) + F.when(rest > 0, 2 * rest / (F.lit(rate) + root)).otherwise(0.0), F.lit(b))
            here = (turn == i) if end >= segments[-1][5] else (turn == i) & (part < end)
            found = F.when(here, at) if found is None else found.when(here, at)
    return found


def sized(docs: DataFrame) -> DataFrame:
    """``doc_id, origin, size, row`` of every row, stored; ``origin`` orders sources, NULL last."""
    origin = F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit("t"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), origin.alias("origin"), F.col("text").cast("string").alias("text"))
    found = texts.mapInArrow(_sized, "doc_id long, origin string, size long")
    return materialized(found.withColumn("row", F.monotonically_increasing_id()), "sizes")


def curriculum(rows: DataFrame, schedules: Sequence[Knots] = SCHEDULES, repeats: int = REPEATS) -> DataFrame:
    """The rows of :func:`sized` in their source's sequence, with ``source_size, turn, target`` and ``before``.

    The sequence of a source is by MD5 of the id, then id and size; ``before`` counts the words
    ahead of a row. Equal rows follow one another in any order.
    """
    of_source = rows.groupBy("origin").agg(F.sum("size").alias("source_size"))
    wanted = materialized(targets(of_source, schedules, repeats), "targets")
    shuffled = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    keyed = materialized(rows.withColumn("deal", shuffled), "dealt")
    ordered = running(keyed, ["origin"], ["deal", "doc_id", "size"], {"before": F.col("size")})
    return ordered.drop("deal", "before_total").join(wanted, "origin")


def training_order(placed: DataFrame, schedules: Sequence[Knots] = SCHEDULES, repeats: int = REPEATS) -> DataFrame:
    """Pieces ``row, doc_id, origin, pass, n_words, position`` in the order of training.

    A source is gone through again and again until its target is met; the document in which that
    happens gives only its first words the last time. ``position`` is the progress at which the
    first word of a piece is due. Files follow one another by position, and rows inside a file.
    """
    passes = F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))).alias("pass")
    pieces = placed.filter("size > 0").select("*", passes)
    begin = F.col("pass") * F.col("source_size") + F.col("before")
    goal = F.floor(F.col("target"))
    pieces = pieces.withColumn("begin", begin).withColumn("n_words", F.least(F.col("size"), goal - F.col("begin"))).filter("n_words > 0")
    position = due(F.col("begin") / F.col("target"), F.col("turn"), schedules)
    pieces = pieces.select("row", "doc_id", "origin", "pass", "n_words", position.alias("position"))
    order = ["position", "origin", "row"]
    return pieces.repartitionByRange(*order).sortWithinPartitions(*order)


def mixture(docs: DataFrame, schedules: Sequence[Knots] = SCHEDULES, repeats: int = REPEATS) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` of every row of ``docs(doc_id, source, text)``.

    The order of training is written first; ``taken`` adds up what it holds of a row. NULL text
    has no words and is never taken; a NULL source is one of its own and comes last; repeated
    rows are taken as documents of their own; a table without words has targets of 0; an empty
    one gives no rows. Other columns of ``docs`` are left out.
    """
    placed = materialized(curriculum(sized(docs), schedules, repeats), "placed")
    order = materialized(training_order(placed, schedules, repeats), "order")
    taken = order.groupBy("row").agg(F.sum("n_words").alias("taken"))
    found = placed.join(taken, "row", "left")
    return found.select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken"))

"""Putting streamed text pieces together as they arrive.

A message is complete when its last piece is there and no number is missing. What is known
after batch N lies in the folder ``batch_id=N`` of the target, as rows of three kinds: ``done``,
the messages that were completed in it, each whole and once; ``open``, the pieces of messages that
still wait; and ``lost``, messages given up since no piece came for ``patience`` batches. A batch
reads the open pieces of the one before it and writes its own folder in one job, all of it in the
JVM; a batch that runs again after a failure finds the same state and overwrites its own folder.

So the state holds no more than the pieces of messages that may still be completed. Pieces that
come again after the end are told by the messages done in the last ``patience`` batches; after
that they would wait as a message of their own and be given up. Rows without a conversation, turn
or number from 0 are no pieces. Of several texts for one number the one that came first counts, then
the lesser one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from deskmill.operators.messages import fold_deltas

KEYS = ["conv_id", "turn"]
#: Batches without a piece after which a message is given up.
PATIENCE = 1000

_STATE = "conv_id long, turn long, seq long, piece string, is_last boolean, seen long, text string, n_pieces long, kind string, batch_id long"


def _states(spark: SparkSession, target: str, kind: str) -> DataFrame:
    held = spark.read.schema(_STATE).option("basePath", target).parquet(f"{target}/batch_id=*")
    return held.filter(F.col("kind") == kind)


def _first_of_each(pieces: DataFrame) -> DataFrame:
    """One row for each number of a message."""
    text = F.min(F.struct("seen", "piece")).alias("first")
    found = pieces.groupBy(*KEYS, "seq").agg(text, F.max("is_last").alias("is_last"), F.max("seen").alias("last_seen"))
    return found.select(*KEYS, "seq", "first.piece", "is_last", F.col("first.seen").alias("seen"), "last_seen")


def fold_batch(batch: DataFrame, batch_id: int, target: str, patience: int = PATIENCE) -> None:
    """Take the pieces ``(conv_id, turn, seq, piece, is_last)`` of one batch in."""
    spark = batch.sparkSession
    pieces = batch.select(*KEYS, "seq", "piece", F.coalesce("is_last", F.lit(False)).alias("is_last"), F.lit(batch_id).cast("long").alias("seen"))
    pieces = pieces.filter("conv_id IS NOT NULL AND turn IS NOT NULL AND seq >= 0")
    if batch_id > 0:
        recent = F.col("batch_id").between(batch_id - patience, batch_id - 1)
        pieces = pieces.join(_states(spark, target, "done").filter(recent).select(*KEYS), KEYS, "left_anti")
        before = spark.read.schema(_STATE).option("basePath", target).parquet(f"{target}/batch_id={batch_id - 1}")
        pieces = before.filter("kind = 'open'").select(*pieces.columns).unionByName(pieces)
    known = _first_of_each(pieces)
    of_message = known.groupBy(*KEYS).agg(
        F.max("last_seen").alias("latest"),
        F.count(F.lit(1)).alias("n_pieces"),
        (F.bool_or("is_last") & (F.count(F.lit(1)) == F.max("seq") + 1)).alias("whole"),  # numbers are distinct
    )
    gone = ~F.col("whole") & (F.col("latest") <= batch_id - patience)
    rows = known.join(of_message.filter(~gone), KEYS)
    kinds = {
        "done": fold_deltas(rows.filter("whole"), KEYS, "seq", "piece").withColumnRenamed("piece", "text"),
        "open": rows.filter("NOT whole").select(*KEYS, "seq", "piece", "is_last", F.col("last_seen").alias("seen")),
        "lost": of_message.filter(gone).select(*KEYS, "n_pieces"),
    }
    state = None
    for kind, rows in kinds.items():
        rows = rows.withColumn("kind", F.lit(kind))
        state = rows if state is None else state.unionByName(rows, allowMissingColumns=True)
    state.write.mode("overwrite").partitionBy("kind").parquet(f"{target}/batch_id={batch_id}")
    if batch_id > 1:  # a replay needs the batch before; older open pieces are of no use
        _forget(spark, f"{target}/batch_id={batch_id - 2}/kind=open")


def _forget(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def run_fold(pieces: DataFrame, target: str, checkpoint: str, patience: int = PATIENCE, every: str | None = None) -> StreamingQuery:
    """Fold what is there and stop, or go on ``every`` interval."""

    def fold(batch: DataFrame, batch_id: int) -> None:
        fold_batch(batch, batch_id, target, patience)

    writer = pieces.writeStream.foreachBatch(fold).option("checkpointLocation", checkpoint)
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.trigger(**trigger).start()


def folded(spark: SparkSession, target: str) -> DataFrame:
    """``conv_id, turn, text`` of every message that is complete."""
    return _states(spark, target, "done").select(*KEYS, "text")


def given_up(spark: SparkSession, target: str) -> DataFrame:
    """``conv_id, turn, n_pieces, batch_id`` of every message that was given up."""
    return _states(spark, target, "lost").select(*KEYS, "n_pieces", "batch_id")


def waiting(spark: SparkSession, target: str) -> DataFrame:
    """The pieces that the newest state holds."""
    held = _states(spark, target, "open")
    newest = spark.read.schema(_STATE).option("basePath", target).parquet(f"{target}/batch_id=*").agg(F.max("batch_id"))
    return held.join(newest, F.col("batch_id") == F.col("max(batch_id)")).select(*KEYS, "seq", "piece", "is_last", "seen")

"""Keeping a vector index up to date from a stream of texts.

The index is a folder of batches. Each micro-batch writes the vectors of its own rows to
``batch_id=N`` and touches nothing else, so a batch costs what its own rows cost. A batch
that runs again after a failure overwrites its own folder, so no row can appear twice. A batch moves no
data between machines. A row without a text is a tombstone: it takes its key out.

Readers take the newest vector per key, as of the last batch or of an earlier one. Batches that
pile up are merged step by step: whenever ``FANOUT`` neighbouring runs have come to one size
they become one run, so that a row is rewritten a few times only, however long the stream goes
on. A merged run keeps the newest row of each key, and tombstones unless it is the oldest. The
folder ``runs`` says, in a file for each step, which runs there are; a step that runs again writes
the same. Batches that are in a run are no longer read, and may be deleted after a while.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.types import StructType

from deskmill.operators.vectors import build_index

VERSION = "version"
#: Runs of one size that become one.
FANOUT = 4


def read_stream(
    spark: SparkSession, folder: str, schema: StructType, pattern: str, files_per_batch: int | None = None
) -> DataFrame:
    """Parquet files of a folder as a stream; ``version`` tells newer files from older."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder).withColumn(VERSION, F.col("_metadata.file_modification_time"))


def changes_to_rows(feed: DataFrame, text: str) -> DataFrame:
    """Rows for the stream from a change feed: the new state of each key, or a tombstone."""
    gone = F.col("change_type") == "delete"
    rows = feed.filter("change_type <> 'update_preimage'")
    return rows.withColumn(text, F.when(~gone, F.col(text))).drop("change_type")


def refresh_index(
    stream: DataFrame, keys: list[str], text: str, target: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Start the refresh: once over what is new, or ``every`` interval until stopped."""

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        index = build_index(batch, [*keys, VERSION], text)
        index.write.mode("overwrite").parquet(f"{target}/batch_id={batch_id}")

    writer = stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.trigger(**trigger).start()


# -- runs -----------------------------------------------------------------------------------

Run = tuple[int, int]  # first and last batch


def _written(spark: SparkSession, pattern: str) -> list[int]:
    """Numbers of the folders ``name=number`` that were written whole."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{pattern}/_SUCCESS")
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return sorted(int(status.getPath().getParent().getName().split("=")[1]) for status in found or [])


def runs(spark: SparkSession, target: str) -> tuple[list[Run], list[int]]:
    """The merged runs, oldest first, and the batches that came after them."""
    steps = _written(spark, f"{target}/runs/step=*")
    held: list[Run] = []
    if steps:
        rows = spark.read.schema("first long, last long").parquet(f"{target}/runs/step={steps[-1]}").collect()
        held = sorted((r["first"], r["last"]) for r in rows)
    done = held[-1][1] if held else -math.inf
    return held, [n for n in _written(spark, f"{target}/batch_id=*") if n > done]


def _run_path(target: str, run: Run) -> str:
    return f"{target}/merged/run={run[0]}_{run[1]}"


def _rows(spark: SparkSession, target: str, merged: list[Run], batches: list[int]) -> DataFrame:
    """``keys, version, content_hash, vector, batch_id`` of some runs and batches."""
    parts = []
    if merged:
        parts.append(spark.read.parquet(*[_run_path(target, run) for run in merged]))
    if batches:
        read = spark.read.option("basePath", target).parquet(*[f"{target}/batch_id={n}" for n in batches])
        parts.append(read.withColumn("batch_id", F.col("batch_id").cast("long")))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def _newest(rows: DataFrame, keys: list[str]) -> DataFrame:
    last = F.max_by(F.struct("content_hash", "vector", VERSION, "batch_id"), F.struct("batch_id", VERSION, "content_hash"))
    return rows.groupBy(*keys).agg(last.alias("r")).select(*keys, "r.*")


def merge_runs(spark: SparkSession, target: str, keys: list[str], fanout: int = FANOUT) -> int:
    """Merge neighbouring runs of one size until there are fewer than ``fanout`` of each; how often.

    The size of a run is the number of batches in it, to the nearest power of ``fanout`` below. It
    is called between refreshes, not while a batch is written.
    """
    merged = 0
    while True:
        held, batches = runs(spark, target)
        line: list[Run] = [*held, *((n, n) for n in batches)]
        size = [int(math.log(last - first + 1, fanout) + 1e-9) for first, last in line]
        at = next((i for i in range(len(line) - fanout + 1) if len(set(size[i : i + fanout])) == 1), None)
        if at is None:
            return merged
        some = line[at : at + fanout]
        rows = _newest(_rows(spark, target, [r for r in some if r in held], [r[0] for r in some if r not in held]), keys)
        if at == 0:
            rows = rows.filter("content_hash IS NOT NULL")  # there is nothing older that a tombstone could hide
        new = (some[0][0], some[-1][1])
        rows.write.mode("overwrite").parquet(_run_path(target, new))
        # Batches are the youngest, and the oldest of one size are merged: what is left of them are runs.
        left = [*line[:at], new, *(r for r in line[at + fanout :] if r in held)]
        step = max(_written(spark, f"{target}/runs/step=*"), default=-1) + 1
        spark.createDataFrame(left, "first long, last long").coalesce(1).write.mode("overwrite").parquet(f"{target}/runs/step={step}")
        merged += 1


def current_index(spark: SparkSession, target: str, keys: list[str], as_of: int | None = None) -> DataFrame:
    """The newest vector of every key, by default as of the last batch.

    A state inside a merged run is gone: asking for one is an error.
    """
    held, batches = runs(spark, target)
    if as_of is not None:
        inside = [run for run in held if run[0] <= as_of < run[1]]
        if inside:
            raise ValueError(f"batch {as_of} was merged into the run of batches {inside[0][0]} to {inside[0][1]}")
        held, batches = [run for run in held if run[1] <= as_of], [n for n in batches if n <= as_of]
    if not held and not batches:
        raise ValueError(f"no batch has been written to {target} by then")
    newest = _newest(_rows(spark, target, held, batches), keys)
    return newest.filter("content_hash IS NOT NULL").select(*keys, "content_hash", "vector")


def compact(spark: SparkSession, target: str, keys: list[str], compacted: str) -> None:
    """Write the current index as one batch of a new folder.

    Streams number their batches from 0, so a refresh of the new folder, under whatever
    checkpoint, adds to batch -1 and never overwrites it.
    """
    held, batches = runs(spark, target)
    rows = _newest(_rows(spark, target, held, batches), keys).filter("content_hash IS NOT NULL").drop("batch_id")
    rows.write.mode("overwrite").parquet(f"{compacted}/batch_id=-1")

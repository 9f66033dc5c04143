"""Quoted multi-line CSV: scan, write, idempotent load, overwrite load."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StringType, StructField, StructType

# Fields may hold newlines, and a quote inside a field is doubled.
READ_OPTIONS = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "multiLine": "true",
}
WRITE_OPTIONS = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}
# A multi-line file is read by one task, so files must stay small enough for one task.
ROWS_PER_FILE = 100_000

SOURCE_FILE = "source_file"


def scan_csv(spark: SparkSession, path: str | list[str], schema: StructType | None = None) -> DataFrame:
    """Read CSV. Without a schema Spark infers one, which costs a pass over the data."""
    reader = spark.read.options(**READ_OPTIONS)
    reader = reader.option("inferSchema", "true") if schema is None else reader.schema(schema)
    return reader.csv(path)


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write CSV that :func:`scan_csv` reads back unchanged."""
    df.write.options(**WRITE_OPTIONS).option("maxRecordsPerFile", ROWS_PER_FILE).mode(mode).csv(path)


def list_files(spark: SparkSession, folder: str, pattern: str = "*.csv") -> DataFrame:
    """One row per file. Only names and sizes are read, never the content."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    return files.select("path", F.substring_index("path", "/", -1).alias(SOURCE_FILE), F.col("length").alias("size"))


# -- loading with a ledger ------------------------------------------------------------------

_BAD, _PATH, _SIZE, _HEADER, _FAULT = "_bad_record", "_path", "_size", "_is_header", "_fault"
_LEDGER = f"path string, size long, status string, rows long, fault string, {SOURCE_FILE} string, batch_id long"


def _by_header(names: list[str]):
    """Columns put in the order of ``names`` by each file's first record, which stays as a marker.

    A multi-line file is read by one task from its start, so its records follow one another.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, order, fault = None, None, None
        for batch in batches:
            paths = batch.column(_PATH).to_pylist()
            edges = [i for i in range(len(paths)) if i == 0 or paths[i] != paths[i - 1]]
            for begin, end in zip(edges, [*edges[1:], len(paths)]):
                part = batch.slice(begin, end - begin)
                first = paths[begin] != path
                if first:
                    path = paths[begin]
                    header = [part.column(i)[0].as_py() for i in range(len(names))]
                    header = [(name or "").lstrip("\ufeff").strip() for name in header]
                    same = sorted(header) == sorted(names) and part.column(_BAD)[0].as_py() is None
                    fault = None if same else "the header does not name the columns"
                    order = [header.index(name) for name in names] if same else list(range(len(names)))
                marks = np.zeros(part.num_rows, bool)
                marks[0] = first
                columns = [part.column(i) for i in order] + [part.column(c) for c in (_BAD, _PATH, _SIZE)]
                columns += [pa.array(marks), pa.array([fault] * part.num_rows, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, [*names, _BAD, _PATH, _SIZE, _HEADER, _FAULT])

    return run


def _load_batch(batch: DataFrame, batch_id: int, target: str, schema: StructType) -> None:
    """Write the rows of a batch's files, and then the ledger that says which of them count."""
    names = schema.names
    text = ", ".join(f"`{c}` string" for c in [*names, _BAD, _PATH]) + f", {_SIZE} long, {_HEADER} boolean, {_FAULT} string"
    named = batch.mapInArrow(_by_header(names), text)
    values, misfits = [], []
    for field in schema.fields:
        value = F.col(field.name) if field.dataType == StringType() else F.col(field.name).try_cast(field.dataType)
        values.append(value.alias(field.name))
        misfits.append(F.when(F.col(field.name).isNotNull() & value.isNull(), f"{field.name} does not fit its type"))
    record = F.when(F.col(_BAD).isNotNull(), "a record has too few or too many fields")
    fault = F.coalesce(_FAULT, F.when(~F.col(_HEADER), F.coalesce(record, *misfits)))
    rows = named.select(*values, F.col(_PATH).alias("path"), F.col(_SIZE).alias("size"), F.col(_HEADER).alias("is_header"), fault.alias("fault"))
    rows.write.mode("overwrite").parquet(f"{target}/rows/batch_id={batch_id}")
    written = batch.sparkSession.read.schema(rows.schema).parquet(f"{target}/rows/batch_id={batch_id}")
    files = written.groupBy("path").agg(
        F.max("size").alias("size"),
        F.when(F.max("fault").isNull(), "loaded").otherwise("failed").alias("status"),
        F.when(F.max("fault").isNull(), F.count_if(~F.col("is_header"))).otherwise(F.lit(0)).alias("rows"),
        F.max("fault").alias("fault"),
        F.substring_index(F.max("path"), "/", -1).alias(SOURCE_FILE),
    )
    files.write.mode("overwrite").parquet(f"{target}/ledger/batch_id={batch_id}")


def ledger(spark: SparkSession, target: str) -> DataFrame:
    """``path, size, status, rows, fault, source_file, batch_id`` of every file that was read."""
    try:
        return spark.read.schema(_LEDGER).option("basePath", f"{target}/ledger").parquet(f"{target}/ledger/batch_id=*")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _LEDGER)


def loaded_rows(spark: SparkSession, target: str, schema: StructType) -> DataFrame:
    """The rows of all files that the ledger holds as loaded, with ``source_file``."""
    stored = StructType([*schema.fields, StructField("path", StringType()), StructField("is_header", BooleanType()), StructField("batch_id", LongType())])
    entries = ledger(spark, target).filter("status = 'loaded'")
    if entries.isEmpty():
        return spark.createDataFrame([], StructType([*schema.fields, StructField(SOURCE_FILE, StringType())]))
    rows = spark.read.schema(stored).option("basePath", f"{target}/rows").parquet(f"{target}/rows/batch_id=*")
    kept = rows.filter("NOT is_header").join(entries.select("path", "batch_id", SOURCE_FILE), ["path", "batch_id"])
    return kept.select(*schema.names, SOURCE_FILE)


def load_new_files(
    spark: SparkSession, folder: str, target: str, schema: StructType, pattern: str = "*.csv", files_per_batch: int = 1000
) -> DataFrame:
    """Load the files of a folder that were not read before, and report on every file.

    A stream lists the folder, remembers what it has read, and stops when nothing is new. Each of
    its batches writes rows and, after them, a ledger with an entry for each file; rows count only
    if their file's entry says ``loaded``. So a batch that runs again replaces what it wrote, a row
    never moves to another machine, and no list of files is made on the driver.

    Columns go by the names in a file's first record, in any order. A file whose header does not
    name exactly the columns of the schema, or with a record that does not fit, is ``failed``,
    with the ``fault`` in the ledger, and nothing of it counts; it is read again under a new name
    only. A file with nothing but a header is loaded with no rows.

    The report has ``source_file, status, size, rows, path``. The status of a file is ``loaded``,
    ``failed``, ``skipped`` if an earlier call loaded it, or ``empty`` if it holds no record. Files
    of no bytes are left out by Spark's readers, and so by the report.
    """
    last = ledger(spark, target).agg(F.coalesce(F.max("batch_id"), F.lit(-1))).first()[0]
    text = StructType([StructField(name, StringType()) for name in [*schema.names, _BAD]])
    options = READ_OPTIONS | {"header": "false", "columnNameOfCorruptRecord": _BAD, "ignoreMissingFiles": "true"}
    stream = spark.readStream.options(**options).option("pathGlobFilter", pattern).option("maxFilesPerTrigger", files_per_batch)
    stream = stream.schema(text).csv(folder).select("*", F.col("_metadata.file_path").alias(_PATH), F.col("_metadata.file_size").alias(_SIZE))

    def load(batch: DataFrame, batch_id: int) -> None:
        _load_batch(batch, batch_id, target, schema)

    writer = stream.writeStream.foreachBatch(load).option("checkpointLocation", f"{target}/checkpoint")
    writer.trigger(availableNow=True).start().awaitTermination()
    return load_report(spark, folder, target, pattern, last)


def load_report(spark: SparkSession, folder: str, target: str, pattern: str = "*.csv", before: int = -1) -> DataFrame:
    """What the ledger says of each file of a folder; batches up to ``before`` were earlier calls."""
    known = ledger(spark, target).select("path", "status", "rows", "batch_id")
    files = list_files(spark, folder, pattern)
    # Two sources may write one path in two ways (file:/a and file:///a, and escapes).
    plain = lambda path: F.regexp_replace(F.try_url_decode(F.regexp_replace(path, r"\+", "%2B")), "^([a-z0-9]+):/+", "$1:/")
    met = files.withColumn("_at", F.coalesce(plain(F.col("path")), "path")).join(
        known.withColumn("_at", F.coalesce(plain(F.col("path")), "path")).drop("path"), "_at", "left"
    )
    skipped = (F.col("status") == "loaded") & (F.col("batch_id") <= before)
    status = F.when(F.col("status").isNull(), "empty").when(skipped, "skipped").otherwise(F.col("status"))
    return met.select(SOURCE_FILE, status.alias("status"), "size", F.coalesce("rows", F.lit(0)).alias("rows"), "path")


def overwrite_table(df: DataFrame, name: str, path: str) -> None:
    """Replace a table, its schema included, by the rows of ``df``."""
    df.write.mode("overwrite").option("path", path).saveAsTable(name)

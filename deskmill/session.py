"""Session settings, input tables and shared scratch folders."""

from __future__ import annotations

import contextlib
import functools
import re
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()

#: Splits up to which a table is dealt out over the cores; one is 128 MB by default.
FEW_SPLITS = 8

SCRATCH_KEY = "spark.checkpoint.dir"


def build_session(master: str = "local[8]", app: str = "deskmill", **conf: str) -> SparkSession:
    """A session for tests and the bench; on a cluster the platform brings its own."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.shuffle.partitions": "8",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
        "spark.driver.bindAddress": "127.0.0.1",
        "spark.driver.host": "127.0.0.1",
    }
    settings.update(conf)
    builder = SparkSession.builder.master(master).appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fingerprint(spark: SparkSession, path: str) -> tuple:
    """Names, sizes and times of the files of a table; another one once it is written anew."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = place.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(place)
    return tuple(sorted((f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in found))


def spread_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table for work that is heavy per row, read with every core.

    A small file is one split and would keep one core busy. An input of more than a few
    splits, and so of more than ``FEW_SPLITS`` times a split's size at most, is left as it is,
    however many cores there are: it would pay for a shuffle.
    """
    scan = table(spark, sf_dir, name)
    few = min(FEW_SPLITS, spark.sparkContext.defaultParallelism)
    return scan if scan.rdd.getNumPartitions() > few else scan.repartition(spark.sparkContext.defaultParallelism)


def materialized(df: DataFrame, label: str) -> DataFrame:
    """Write a small intermediate result to the shared folder and go on from there.

    It is computed once however often it is used, survives lost executors, and its size is
    known to the planner, which broadcasts it only if it is small.
    """
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def setting(spark: SparkSession, key: str, value: object) -> Iterator[None]:
    """A setting of the session for what is run inside, and then as it was."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, str(value))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def view(spark: SparkSession, sf_dir: str, name: str) -> str:
    """Register a table as a temporary view and return the view's name.

    The name carries the folder, so two scale factors can live in one session.
    """
    view_name = "v_" + re.sub(r"\W+", "_", f"{sf_dir.rstrip('/').rsplit('/', 1)[-1]}_{name}")
    table(spark, sf_dir, name).createOrReplaceTempView(view_name)
    return view_name


@functools.cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="deskmill-")


def scratch_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session that names none gets a temporary folder of its own: on a
    cluster such a folder would be visible to one machine only.
    """
    root = spark.conf.get(SCRATCH_KEY, None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {SCRATCH_KEY} to a folder that every executor can reach")
    return _local_root()


def scratch(spark: SparkSession, label: str) -> str:
    """A new folder path for one run; nothing is created until Spark writes to it."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex[:12]}"

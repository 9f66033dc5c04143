"""Counts and readiness checks over tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _all(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def table_profile(tables: dict[str, DataFrame]) -> DataFrame:
    """``(table_name, row_count, column_count)`` per table."""
    return _all(
        [
            df.agg(F.count(F.lit(1)).alias("row_count")).select(
                F.lit(name).alias("table_name"),
                "row_count",
                F.lit(len(df.columns)).cast("bigint").alias("column_count"),
            )
            for name, df in tables.items()
        ]
    )


def readiness(checks: dict[str, tuple[DataFrame, list[str], list[str]]]) -> DataFrame:
    """Per table: has rows, key unique, required columns filled, and all three.

    ``checks`` maps a name to ``(table, key columns, required columns)``. Rows are counted
    per key in one shuffle, combined on the map side, so even a key that a third of the
    rows share sends one row per task. The row ``*`` tells whether all tables are ready.
    """
    parts = []
    for name, (df, key, required) in checks.items():
        missing = reduce(
            lambda a, b: a | b, [F.col(c).isNull() for c in dict.fromkeys([*key, *required])]
        )
        per_key = df.groupBy(*key).agg(
            F.count(F.lit(1)).alias("n"), F.count_if(missing).alias("missing")
        )
        parts.append(
            per_key.agg(
                F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
                F.coalesce(F.max("n"), F.lit(0)).alias("most"),
                F.coalesce(F.sum("missing"), F.lit(0)).alias("missing"),
            ).select(
                F.lit(name).alias("table_name"),
                (F.col("n") > 0).alias("has_rows"),
                (F.col("most") <= 1).alias("key_unique"),
                (F.col("missing") == 0).alias("required_filled"),
            )
        )
    flags = ["has_rows", "key_unique", "required_filled"]
    both = _all(parts).rollup("table_name").agg(*[F.bool_and(f).alias(f) for f in flags])
    return both.select(
        F.coalesce("table_name", F.lit("*")).alias("table_name"),
        *flags,
        (F.col("has_rows") & F.col("key_unique") & F.col("required_filled")).alias("ready"),
    )

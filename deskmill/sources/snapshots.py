"""The row changes between two snapshots of a keyed table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deskmill.operators.skew import join_null_safe
from deskmill.session import materialized


# Without these formats times would be written to the millisecond.
JSON_OPTIONS = {
    "ignoreNullFields": "true",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def row_hash(df: DataFrame, columns: list[str]):
    """SHA-256 over all columns; NULL differs from the empty text, and every microsecond counts."""
    return F.sha2(F.to_json(F.struct(*columns), JSON_OPTIONS), 256)


def changed_keys(before: DataFrame, after: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """``(key, change)`` with ``insert``, ``update`` or ``delete``; unchanged keys are left out.

    Only keys and hashes meet in the full outer join, whatever the rows weigh. Both sides
    shuffle by the key, which is unique, so no task is hot. NULL is a key like any other.
    """
    old = before.select(F.col(key).alias("_old_key"), row_hash(before, columns).alias("_old"))
    new = after.select(F.col(key).alias("_new_key"), row_hash(after, columns).alias("_new"))
    change = (
        F.when(F.col("_old").isNull(), "insert")
        .when(F.col("_new").isNull(), "delete")
        .when(F.col("_old") != F.col("_new"), "update")
    )
    met = old.join(new, F.col("_old_key").eqNullSafe(F.col("_new_key")), "full_outer")
    of_row = F.when(F.col("_old").isNull(), F.col("_new_key")).otherwise(F.col("_old_key"))
    return met.select(of_row.alias(key), change.alias("change")).filter("change is not null")


def change_feed(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """The changed rows with a ``change_type``; an update gives the row before and after.

    The keys that changed are found first, from hashes, and only their rows are fetched.
    """
    columns = [c for c in after.columns if c != key]
    changes = materialized(changed_keys(before, after, key, columns), "changes")
    old = join_null_safe(before, changes.filter("change <> 'insert'"), [key]).withColumn(
        "change_type", F.when(F.col("change") == "update", "update_preimage").otherwise(F.col("change"))
    )
    new = join_null_safe(after, changes.filter("change <> 'delete'"), [key]).withColumn(
        "change_type", F.when(F.col("change") == "update", "update_postimage").otherwise(F.col("change"))
    )
    return old.drop("change").unionByName(new.drop("change")).select(key, "change_type", *columns)

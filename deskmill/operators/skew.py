"""Helpers that keep one hot key from ending in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 4096


def unnest(df: DataFrame, *keep: str, array: Column, value: str, position: str = "_pos") -> DataFrame:
    """One row per element of an array, with its position unless that goes unnamed.

    A plain ``explode`` makes Spark test the array's size beforehand, and so compute the
    array twice: costly where it is made from a whole text or in Python. The outer form
    has no such test; the rows it adds for empty arrays are dropped by their position.
    """
    rows = df.select(*keep, F.posexplode_outer(array).alias(position, value)).filter(
        F.col(position).isNotNull()
    )
    return rows.drop("_pos")


def top_per_key(
    df: DataFrame,
    keys: list[str],
    order: list[Column],
    k: int,
    salts: int = 1,
    salt_on: tuple[str, ...] = (),
) -> DataFrame:
    """The first ``k`` rows of every key, with ``rank`` from 1.

    ``row_number() <= k`` lets Spark drop all but ``k`` rows per key and task before it
    shuffles. With ``salts`` the rows of a key meet in that many tasks first. The salt is
    a hash of the row's own columns, so a task that runs again deals the same rows out.
    """
    if salts > 1:
        first = Window.partitionBy(*keys, "_salt").orderBy(*order)
        df = (
            df.withColumn("_salt", F.pmod(F.xxhash64(*salt_on), F.lit(salts)))
            .withColumn("_first", F.row_number().over(first))
            .filter(F.col("_first") <= k)
            .drop("_salt", "_first")
        )
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(window)).filter(F.col("rank") <= k)


def join_null_safe(df: DataFrame, other: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join by keys of which NULL equals NULL; the keys come once, from the left side."""
    renamed = other.withColumnsRenamed({key: f"_other_{key}" for key in keys})
    same = F.lit(True)
    for key in keys:
        same = same & F.col(key).eqNullSafe(F.col(f"_other_{key}"))
    return df.join(renamed, same, how).drop(*[f"_other_{key}" for key in keys])


def with_next(df: DataFrame, keys: list[str], position: str, order: list[str], value: Column, name: str, block: int = BLOCK) -> DataFrame:
    """The ``value`` of the row that follows within its keys, by ``position`` and then ``order``.

    As :func:`number_rows`, it works in blocks of ``position``, so that no key is sorted in
    one task: the last row of a block is followed by the first of the next block there is.
    """
    blocks = df.withColumns({"_block": F.floor(F.col(position) / block), "_value": value})
    cut = [*keys, "_block"]
    heads = blocks.groupBy(*cut).agg(F.min_by("_value", F.struct(position, *order)).alias("_head"))
    after = F.lead("_head").over(Window.partitionBy(*keys).orderBy("_block"))
    heads = heads.withColumn("_after", after).drop("_head")
    inside = Window.partitionBy(*cut).orderBy(position, *order)
    found = join_null_safe(blocks.withColumn("_follows", F.lead("_value").over(inside)), heads, cut)
    return found.withColumn(name, F.coalesce("_follows", "_after")).drop("_block", "_value", "_follows", "_after")


def number_rows(
    df: DataFrame, keys: list[str], position: str, order: list[str], name: str, block: int = BLOCK
) -> DataFrame:
    """Consecutive numbers from 0 per key, ordered by ``position`` and then ``order``.

    ``position`` is a running number, such as that of a turn; several rows may share one.
    A window over the key alone would sort a hot key in one task. Here the key is cut into
    blocks of the integer column ``position``; rows are numbered within a block, and a
    block starts where the counts of the blocks before it end. Only those counts, one row
    per block, meet per key.
    """
    blocks = df.withColumn("_block", F.floor(F.col(position) / block))
    cut = [*keys, "_block"]
    before = Window.partitionBy(*keys).orderBy("_block").rowsBetween(
        Window.unboundedPreceding, -1
    )
    starts = (
        blocks.groupBy(*cut)
        .count()
        .withColumn("_start", F.coalesce(F.sum("count").over(before), F.lit(0)))
        .drop("count")
    )
    inside = Window.partitionBy(*cut).orderBy(position, *order)
    numbered = join_null_safe(blocks.withColumn("_inside", F.row_number().over(inside)), starts, cut)
    return numbered.withColumn(name, F.col("_start") + F.col("_inside") - 1).drop("_block", "_start", "_inside")


def joined_in_order(seq: str, text: Column) -> Column:
    """Aggregate: the texts of a group put together by ``seq``; NULL texts are skipped."""
    kept = F.collect_list(F.when(text.isNotNull(), F.struct(F.col(seq), text.alias("_t"))))
    return F.array_join(F.transform(F.array_sort(kept), lambda s: s["_t"]), "")

"""Running sums along an order, without sorting a key in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from deskmill.session import materialized


def running(df: DataFrame, keys: list[str], order: list[str], sums: dict[str, Column]) -> DataFrame:
    """Adds, for each name, the sum over the rows before a row in its key, and ``<name>_total`` of the key.

    ``df`` is a stored table, so that a task that runs again sees the same rows. Keys are not
    NULL; ``order`` is ascending, NULL first; rows that are equal in it follow one another in
    any order. The rows are cut into ranges of (keys, order), of about one size however often a
    key or a row is repeated, and stored. Sums are then made inside a range; only one row for
    each range and key is needed to say where a range begins.
    """
    held = df.withColumns({f"_v_{name}": value.cast("long") for name, value in sums.items()})
    held = held.withColumn("_uid", F.monotonically_increasing_id())
    ranged = held.repartitionByRange(*keys, *order, "_uid").withColumn("_part", F.spark_partition_id())
    placed = materialized(ranged, "ranges")
    cut = ["_part", *keys]
    parts = placed.groupBy(*cut).agg(*[F.sum(f"_v_{name}").alias(f"_p_{name}") for name in sums])
    of_key = Window.partitionBy(*keys)
    before = of_key.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select(
        *cut,
        *[F.coalesce(F.sum(f"_p_{name}").over(before), F.lit(0)).alias(f"_s_{name}") for name in sums],
        *[F.sum(f"_p_{name}").over(of_key).alias(f"{name}_total") for name in sums],
    )
    inside = Window.partitionBy(*cut).orderBy(*order, "_uid").rowsBetween(Window.unboundedPreceding, -1)
    summed = placed.withColumns({f"_i_{name}": F.coalesce(F.sum(f"_v_{name}").over(inside), F.lit(0)) for name in sums})
    found = summed.join(starts, cut).withColumns({name: F.col(f"_s_{name}") + F.col(f"_i_{name}") for name in sums})
    made = [f"_{kind}_{name}" for name in sums for kind in "vis"]
    return found.drop("_uid", "_part", *made)

"""Dotted key/value settings per owner: ``(owner, seq, key, value)``, one row per assignment.

``seq`` orders an owner's assignments. All jobs work for all owners at once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deskmill.functions.text import flat_key
from deskmill.operators.skew import unnest
from deskmill.session import materialized


def current_values(assignments: DataFrame) -> DataFrame:
    """The last value of every key; a last value of NULL counts."""
    last = F.max_by(F.struct("value"), "seq")
    return (
        assignments.groupBy("owner", "key")
        .agg(F.max("seq").alias("seq"), last.alias("r"))
        .select("owner", "key", "seq", "r.value")
    )


def settings_map(assignments: DataFrame) -> DataFrame:
    """One ``MAP<STRING, STRING>`` per owner, dots in keys turned to underscores.

    Two keys may become one by the renaming; the later assignment wins. Values are reduced
    to one per key before they are gathered, so what is gathered is the map itself.
    """
    renamed = assignments.withColumn("key", flat_key(F.col("key")))
    entries = F.collect_list(F.struct("key", "value"))
    return current_values(renamed).groupBy("owner").agg(F.map_from_entries(entries).alias("settings"))


def catalog_and_schema(assignments: DataFrame) -> DataFrame:
    """Catalog and schema name per owner; a schema counts only together with a catalog."""

    def last(key: str):
        seq = F.when(F.col("key") == key, F.col("seq"))
        return F.max_by(F.struct("value"), seq)["value"]

    named = assignments.filter(F.col("key").isin("catalog_name", "schema_name"))
    return (
        named.groupBy("owner")
        .agg(last("catalog_name").alias("catalog_name"), last("schema_name").alias("schema_name"))
        .select("owner", "catalog_name", F.when(F.col("catalog_name").isNotNull(), F.col("schema_name")).alias("schema_name"))
    )


def under_prefix(assignments: DataFrame, prefix: str) -> DataFrame:
    """Current keys below ``prefix``, given without it."""
    dotted = f"{prefix}."
    below = assignments.filter(F.col("key").startswith(dotted))
    return current_values(below).withColumn("key", F.substring("key", len(dotted) + 1, 2**31 - 1))


def apply_assignments(assignments: DataFrame) -> DataFrame:
    """The settings left when each assignment to ``k`` also removes every ``k.*`` before it.

    A key goes when one of its ancestors was assigned later than the key itself. In dotted
    order a key comes right before all that is below it, so one sweep over sorted ranges of
    keys, of any owners, meets every ancestor that lies in the same range. Ancestors from
    earlier ranges are those of a range's first key, a few rows for each range. Ranges hold
    distinct keys: none grows with the children of one ancestor or the keys of one owner.
    A NULL owner or key has no ancestors.
    """
    current = current_values(assignments)
    path = F.split("key", r"\.", -1)
    ordered = current.withColumn("path", path).repartitionByRange("owner", "path").sortWithinPartitions("owner", "path")
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in current.schema.fields)
    swept = materialized(ordered.mapInArrow(_sweep, f"{fields}, head boolean, block int"), "swept")
    levels = F.sequence(F.lit(1), F.size(F.split("key", r"\.", -1)) - 1)
    ancestors = F.transform(levels, lambda n: F.call_function("substring_index", F.col("key"), F.lit("."), n))
    heads = swept.filter("head AND contains(key, '.')").select("owner", "block", ancestors.alias("ancestors"))
    heads = unnest(heads, "owner", "block", array=F.col("ancestors"), value="key")
    above = heads.join(swept.select("owner", "key", "seq"), ["owner", "key"])
    above = above.groupBy("block").agg(F.max("owner").alias("of"), F.collect_list(F.struct(F.concat("key", F.lit(".")).alias("below"), "seq")).alias("above"))
    later = F.exists("above", lambda a: (a["seq"] > F.col("seq")) & F.startswith(F.col("key"), a["below"]))
    gone = (F.col("owner") == F.col("of")) & later
    return swept.join(materialized(above, "above"), "block", "left").filter(~F.coalesce(gone, F.lit(False))).select(*current.columns)


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of sorted rows those that no ancestor among them removes; the first one is marked."""
    block = TaskContext.get().partitionId()
    owner_now, open_keys, first = None, [], True  # (path, latest assignment down to it)
    for batch in batches:
        if not batch.num_rows:
            continue
        stays = np.ones(batch.num_rows, bool)
        for i, (owner, path, seq) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("owner", "path", "seq")), strict=True)):
            if owner is None or path is None:
                continue
            if owner != owner_now:
                owner_now, open_keys = owner, []
            while open_keys and path[: len(open_keys[-1][0])] != open_keys[-1][0]:
                open_keys.pop()
            latest = open_keys[-1][1] if open_keys else None
            if seq is not None and latest is not None and latest > seq:
                stays[i] = False
            known = [s for s in (latest, seq) if s is not None]
            open_keys.append((path, max(known) if known else None))
        head = np.zeros(batch.num_rows, bool)
        head[0], first = first, False
        blocks = pa.array(np.full(batch.num_rows, block, np.int32))
        rest = batch.drop_columns(["path"])
        made = pa.RecordBatch.from_arrays([*rest.columns, pa.array(head), blocks], [*rest.schema.names, "head", "block"])
        yield made.filter(pa.array(stays))

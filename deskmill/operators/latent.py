"""Vectors of meaning: a randomised truncated SVD of hashed tf-idf, trained in Spark.

Tokens fall into ``FEATURES`` buckets by their hash. A text's row is its tf-idf, of length 1;
the vectors are its coordinates along the leading right singular vectors of the matrix of
all rows. Each pass over the rows multiplies blocks of them by a matrix of fixed size and
adds up, for each feature, what the tasks give: rows stay where they are, and only
features times directions go to the driver, whatever the number of texts.

Signs are definite: the largest part of a direction is positive. Sums of many tasks come in any
order, so figures agree between runs up to rounding. NULL and empty text has a vector of zeros.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deskmill.functions.text import tokens
from deskmill.session import materialized

FEATURES, DIMENSIONS = 2048, 32
#: Directions beyond those wanted, and passes that sharpen them.
EXTRA, PASSES = 8, 3
#: Tokens of texts counted at once; one text stays whole. The arrays made from them take some 60 bytes for each.
TOKENS = 1 << 19
#: Rows multiplied at once: a block takes ``FEATURES`` * 8 bytes for each.
BLOCK = 256
SEED = 20240611


@dataclass(frozen=True)
class Model:
    """Weights of the features, directions as columns, and their singular values."""

    weights: np.ndarray
    directions: np.ndarray
    strengths: np.ndarray


def featured(texts: DataFrame, keys: list[str], text: str, features: int = FEATURES) -> DataFrame:
    """``keys, feature, times``: the features of each text and how often they occur, written once."""
    hashed = F.transform(tokens(F.col(text)), lambda t: F.pmod(F.xxhash64(t), F.lit(features)).cast("int"))
    counted = texts.select(*keys, hashed.alias("feature"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in counted.schema.fields)
    return materialized(counted.mapInArrow(_count(features), f"{fields}, times array<int>"), "features")


def _count(features: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in _pieces(whole, "feature")):
            at = batch.schema.get_field_index("feature")
            row, found = _flat(batch.column("feature"))
            cells, times = np.unique(row * features + found, return_counts=True)
            offsets = pa.array(np.searchsorted(cells, np.arange(batch.num_rows + 1) * features), pa.int32())
            lists = [pa.ListArray.from_arrays(offsets, pa.array(v, pa.int32())) for v in (cells % features, times)]
            columns = [c for i, c in enumerate(batch.columns) if i != at]
            names = [n for n in batch.schema.names if n != "feature"]
            yield pa.RecordBatch.from_arrays([*columns, *lists], [*names, "feature", "times"])

    return run


def _pieces(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """Rows of a batch whose lists hold about ``TOKENS`` values."""
    ends = np.cumsum(batch.column(column).value_lengths().fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + TOKENS, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def _flat(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    lengths = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    return np.repeat(np.arange(len(lists)), lengths), lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)


def _blocks(batch: pa.RecordBatch, weights: np.ndarray) -> Iterator[np.ndarray]:
    """Rows of tf-idf, of length 1 or all zero, some at a time."""
    for start in range(0, batch.num_rows, BLOCK):
        part = batch.slice(start, BLOCK)
        row, feature = _flat(part.column("feature"))
        _, times = _flat(part.column("times"))
        dense = np.zeros((part.num_rows, len(weights)))
        dense[row, feature] = (1 + np.log(times)) * weights[feature]
        length = np.linalg.norm(dense, axis=1, keepdims=True)
        yield dense / np.where(length > 0, length, 1)


def feature_weights(rows: DataFrame, features: int = FEATURES) -> np.ndarray:
    """Inverse document frequency of every feature, from all texts."""
    seen = rows.select(F.explode("feature").alias("feature")).groupBy("feature").agg(F.count("*").alias("n")).collect()  # ``features`` rows
    df = np.zeros(features)
    df[[r["feature"] for r in seen]] = [r["n"] for r in seen]
    return np.log((1 + rows.count()) / (1 + df)) + 1


def _multiplied(rows: DataFrame, weights: np.ndarray, by: np.ndarray) -> np.ndarray:
    """The matrix of all rows, transposed, times itself, times ``by``."""
    shared = rows.sparkSession.sparkContext.broadcast((weights, by))  # of fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, by = shared.value
        total = np.zeros_like(by)
        for batch in batches:
            for dense in _blocks(batch, weights):
                total += dense.T @ (dense @ by)
        offsets = pa.array(np.arange(0, total.size + 1, total.shape[1]), pa.int32())
        lists = pa.ListArray.from_arrays(offsets, pa.array(total.ravel()))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total)), pa.int32()), lists], ["feature", "parts"])

    parts = rows.select("feature", "times").mapInArrow(run, "feature int, parts array<double>")
    sums = parts.groupBy("feature").agg(*(F.sum(F.col("parts")[j]).alias(f"p{j}") for j in range(by.shape[1])))
    out = np.zeros_like(by)
    for r in sums.collect():  # a row for each feature
        out[r["feature"]] = r[1:]
    return out


def fit(rows: DataFrame, features: int = FEATURES, dimensions: int = DIMENSIONS, passes: int = PASSES) -> Model:
    """The leading directions of all ``rows(feature, times)``."""
    weights = feature_weights(rows, features)
    wide = min(features, dimensions + EXTRA)
    basis = np.linalg.qr(np.random.default_rng(SEED).standard_normal((features, wide)))[0]
    for _ in range(passes):
        basis = np.linalg.qr(_multiplied(rows, weights, basis))[0]
    inner = basis.T @ _multiplied(rows, weights, basis)
    values, turned = np.linalg.eigh((inner + inner.T) / 2)
    best = np.argsort(-values, kind="stable")[:dimensions]
    directions = basis @ turned[:, best]
    largest = directions[np.abs(directions).argmax(axis=0), np.arange(len(best))]
    return Model(weights, directions * np.where(largest < 0, -1.0, 1.0), np.sqrt(np.maximum(values[best], 0)))


def latent_vectors(rows: DataFrame, keys: list[str], model: Model) -> DataFrame:
    """``keys, vector``: the coordinates of every row along the model's directions, of length 1 or all zero."""
    shared = rows.sparkSession.sparkContext.broadcast(model)  # of fixed size
    kept = rows.select(*keys, "feature", "times")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*keys).schema.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        width = model.directions.shape[1]
        for batch in batches:
            found = [dense @ model.directions for dense in _blocks(batch, model.weights)]
            found = np.concatenate(found) if found else np.zeros((0, width))
            length = np.linalg.norm(found, axis=1, keepdims=True)
            found /= np.where(length > 1e-12, length, 1)
            offsets = pa.array(np.arange(0, found.size + 1, width), pa.int32())
            lists = pa.ListArray.from_arrays(offsets, pa.array(found.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keys)], lists], [*keys, "vector"])

    return kept.mapInArrow(run, f"{fields}, vector array<double>")


def likeness(vectors: DataFrame, group: str, dimensions: int, vector: str = "vector") -> DataFrame:
    """``group, texts, within, chance``: the mean cosine of two texts of a group, and of two of all.

    ``vectors(group, vector)`` are scaled to length 1; zero vectors do not count. The mean cosine
    of all pairs is the square of the mean vector, so that one sum for each group is enough.
    """
    squares = F.aggregate(vector, F.lit(0.0), lambda s, x: s + x * x)
    rows = vectors.select(F.col(group), F.col(vector).cast("array<double>").alias("_v"), F.sqrt(squares).alias("_n")).filter("_n > 0")
    sums = [F.sum(F.col("_v")[j] / F.col("_n")) for j in range(dimensions)]
    each = materialized(rows.groupBy(group).agg(F.count("*").alias("texts"), F.array(*sums).alias("_sum")), "likeness")
    square = lambda c: F.aggregate(c, F.lit(0.0), lambda s, x: s + x * x)
    whole = each.agg(F.sum("texts").alias("n"), F.array(*(F.sum(F.col("_sum")[j]) for j in range(dimensions))).alias("s"))
    whole = whole.select((square(F.col("s")) / F.col("n") ** 2).alias("c")).first()["c"]  # one row
    return each.select(group, "texts", (square(F.col("_sum")) / F.col("texts") ** 2).alias("within"), F.lit(whole).cast("double").alias("chance"))

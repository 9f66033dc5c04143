"""Text to vector.

Every token falls into one of 64 buckets by its MD5 hash and the vector holds the token
counts. It stands in for a learned embedding model and has no notion of meaning.

Tokenising and hashing run in the JVM; only bucket numbers, one byte per token, reach
Python, where ``bincount`` counts them for many rows at once. The vector is a column of the
row it was made from, so building an index moves no data between machines. (Exploding
the tokens and grouping them again was slower and shuffled up to 64 rows per text.)
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import ArrayType, IntegerType

from deskmill.functions.text import let, tokens

DIMENSIONS = 64
TOKENS_AT_ONCE = 500_000


def bucket(token: Column) -> Column:
    """The first 32 bits of the MD5 modulo 64 depend on its fourth byte only."""
    fourth = F.substring(F.md5(token.cast("binary")), 7, 2)
    return (F.conv(fourth, 16, 10).cast("int") % DIMENSIONS).cast("byte")


def bucket_counts(lengths: np.ndarray, buckets: np.ndarray, at_once: int = TOKENS_AT_ONCE) -> np.ndarray:
    """Counts per row and bucket, where row ``i`` holds the next ``lengths[i]`` buckets.

    About ``at_once`` tokens are counted in one go, which bounds the memory of a batch.
    """
    counts = np.zeros((len(lengths), DIMENSIONS), dtype=np.int32)
    ends = np.cumsum(lengths)
    row, token = 0, 0
    while row < len(lengths):
        stop = max(row + 1, int(np.searchsorted(ends, token + at_once, side="right")))
        own = np.repeat(np.arange(stop - row) * DIMENSIONS, lengths[row:stop])
        own += buckets[token : ends[stop - 1]]
        counts[row:stop] = np.bincount(own, minlength=counts[row:stop].size).reshape(-1, DIMENSIONS)
        row, token = stop, ends[stop - 1]
    return counts


@arrow_udf(ArrayType(IntegerType()))
def _count_buckets(buckets: pa.Array) -> pa.Array:
    lengths = buckets.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    counts = bucket_counts(lengths, buckets.flatten().to_numpy(zero_copy_only=False))
    offsets = np.arange(0, counts.size + 1, DIMENSIONS, dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(counts.ravel()))


def embed(text: Column) -> Column:
    """Token counts per bucket; an empty text gives the zero vector."""
    return _count_buckets(F.transform(tokens(text), bucket))


def unit(vector: Column) -> Column:
    """The vector divided by its length; the zero vector stays as it is."""
    square = F.aggregate(vector, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x)
    return let(
        F.sqrt(square),
        lambda norm: F.transform(vector, lambda x: F.when(norm > 0, x / norm).otherwise(F.lit(0.0))),
    )

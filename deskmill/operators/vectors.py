"""Vector index: build, incremental sync, exact and approximate search.

An index is a table ``(id, content_hash, vector)``; a vector is an array of numbers of one
length. Similarity is the cosine, rounded to six digits, and 0 where a vector is all
zeros. Results are ordered by similarity, then by id, so every result is unique. Rows
without a vector, or with one of another length than most queries have, are left out of a search.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from deskmill.functions.embedding import embed
from deskmill.operators.skew import top_per_key, unnest
from deskmill.session import materialized

DIGITS = 6
BROADCAST_BYTES = 16 << 20  # of query vectors in doubles; with copies a task takes twice that
BLOCK_BYTES = 64 << 20  # of the vectors of a block
BLOCK_ROWS = 4096  # a block is not made smaller than this to keep more cores busy
MERGE_SALTS = 8
CELLS = 4_000_000  # cosines held at once by one task, 16 MB
ROWS = 8192  # vectors that all queries meet before the best so far are ranked anew
PAIRS = 50_000


# -- index ----------------------------------------------------------------------------------


def build_index(source: DataFrame, keys: list[str], text: str) -> DataFrame:
    """One vector per key. A narrow job: rows stay where they were read."""
    return source.select(*keys, F.sha2(text, 256).alias("content_hash"), embed(F.col(text)).alias("vector"))


def long_form(index: DataFrame, keys: list[str]) -> DataFrame:
    """``(keys, bucket, n)`` for every bucket that is not empty."""
    return (
        unnest(index, *keys, array=F.col("vector"), value="n", position="bucket")
        .filter("n <> 0")
        .select(*keys, F.col("bucket").cast("bigint").alias("bucket"), F.col("n").cast("bigint").alias("n"))
    )


def sync_index(index: DataFrame, after: DataFrame, key: str, text: str) -> DataFrame:
    """The index of ``after``, made from the index of an earlier state.

    The index holds the hash of each text it was made from, so the old texts are not read.
    Only new and changed texts are embedded; rows of changed and deleted keys leave.
    """
    old = index.select(key, F.col("content_hash").alias("_old"), F.lit(True).alias("_was"))
    new = after.select(key, F.sha2(text, 256).alias("_new"), F.lit(True).alias("_is"))
    change = (
        F.when(F.col("_was").isNull(), "insert")
        .when(F.col("_is").isNull(), "delete")
        .when(~F.col("_old").eqNullSafe(F.col("_new")), "update")
    )
    met = old.join(new, key, "full_outer").select(key, change.alias("change"))
    changes = materialized(met.filter("change is not null"), "changes")
    kept = index.join(changes, key, "left_anti")
    fresh = after.join(changes.filter("change <> 'delete'"), key, "left_semi")
    return kept.unionByName(build_index(fresh, [key], text))


# -- exact search ---------------------------------------------------------------------------


def _matrix(vectors: pa.Array) -> np.ndarray:
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    lengths = pc.unique(pc.list_value_length(vectors)).to_pylist()
    if len(lengths) > 1 or None in lengths:
        raise ValueError(f"vectors of one length are wanted, not of lengths {lengths}")
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(vectors), -1) if len(vectors) else flat.reshape(0, 0)


def _norms(matrix: np.ndarray) -> np.ndarray:
    return np.sqrt((matrix * matrix).sum(axis=1))


def _ranked(table: pa.Table, k: int) -> pa.Table:
    """The first ``k`` rows of every query, by similarity and then id."""
    table = table.sort_by([("q", "ascending"), ("similarity", "descending"), ("id", "ascending")])
    q = table["q"].to_numpy()
    first = np.searchsorted(q, q, side="left")
    return table.filter(pa.array(np.arange(len(q)) - first < k))


def _units(matrix: np.ndarray, norms: np.ndarray) -> np.ndarray:
    return (matrix / np.where(norms > 0, norms, 1.0)[:, None]).astype(np.float32)


def _cosines(
    queries: np.ndarray, q_norms: np.ndarray, vectors: np.ndarray, q: np.ndarray, d: np.ndarray, d_norms: np.ndarray | None = None
) -> np.ndarray:
    """Rounded cosines of the pairs ``(q[i], d[i])``, computed in double."""
    d_norms = _norms(vectors) if d_norms is None else d_norms
    out = np.zeros(len(q))
    for at in range(0, len(q), PAIRS):
        i, j = q[at : at + PAIRS], d[at : at + PAIRS]
        dots = np.einsum("ij,ij->i", queries[i], vectors[j])
        scale = q_norms[i] * d_norms[j]
        np.divide(dots, scale, out=out[at : at + PAIRS], where=scale > 0)
    return np.round(out, DIGITS) + 0.0  # a negative zero would print differently


def _first_k(q: np.ndarray, cosine: np.ndarray, d: np.ndarray, k: int) -> np.ndarray:
    """Where the first ``k`` pairs of every query are, by cosine and then position ``d``."""
    order = np.lexsort((d, -cosine, q))
    q = q[order]
    return order[np.arange(len(q)) - np.searchsorted(q, q, side="left") < k]


def _near(units: np.ndarray, vectors: np.ndarray, floor: np.ndarray, margin: float, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a query and a vector, both as units, that may be among the query's best ``k``."""
    about = units @ vectors.T
    near = about >= (floor - margin).astype(np.float32)[:, None]
    if len(vectors) > k and np.count_nonzero(near) > 8 * k * len(units):
        kth = np.partition(about, -k, axis=1)[:, -k]
        near &= about >= (kth - 2 * margin)[:, None]
    return np.divmod(np.flatnonzero(near), len(vectors))


def _scan(queries: np.ndarray, batches: Iterable[pa.RecordBatch | pa.Table], k: int) -> pa.Table | None:
    """The best ``k`` ids per query row over a stream of ``(id, vector)`` batches.

    Cosines in single precision tell which vectors may reach a query's current best ``k``.
    The margin is wider than their error and that of rounding, so none is missed; those
    that may are computed in double. ``ROWS`` vectors meet all queries, some queries at a
    time, before the best of those queries that found any are ranked anew: ranking grows with
    the queries and with the vectors, not with their product. Memory holds ``CELLS``
    cosines, ``k`` finds per query and the best so far, whatever the stream's length.
    """
    norms = _norms(queries)
    units = _units(queries, norms)
    margin = (queries.shape[1] + 8) * 2.0**-23 + 10.0**-DIGITS
    best: pa.Table | None = None
    floor = np.full(len(queries), -np.inf)
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            piece = batch.slice(at, ROWS)
            piece = piece.take(pc.sort_indices(piece.column("id")))  # among equals the lower position comes first
            vectors = _matrix(piece.column("vector"))
            d_norms = _norms(vectors)
            held = _units(vectors, d_norms)
            tile = max(1, CELLS // piece.num_rows)
            finds = []
            for first in range(0, len(queries), tile):
                some = slice(first, first + tile)
                q, d = _near(units[some], held, floor[some], margin, k)
                cosine = _cosines(queries[some], norms[some], vectors, q, d, d_norms)
                good = np.flatnonzero(cosine >= floor[some][q])
                good = good[_first_k(q[good], cosine[good], d[good], k)]
                finds.append((q[good] + first, d[good], cosine[good]))
            q, d, cosine = (np.concatenate(x) for x in zip(*finds, strict=True))
            if not len(q):
                continue
            found = pa.table(
                {
                    "q": pa.array(q.astype(np.int32)),
                    "id": piece.column("id").take(pa.array(d)),
                    "similarity": pa.array(cosine),
                }
            )
            kept = None
            if best is not None:
                moved = np.zeros(len(queries), bool)
                moved[q] = True
                moved = moved[best["q"].to_numpy()]
                kept = best.filter(pa.array(~moved))
                found = pa.concat_tables([best.filter(pa.array(moved)), found])
            found = _ranked(found, k)
            rows = found["q"].to_numpy()
            last = np.flatnonzero(np.append(rows[1:] != rows[:-1], True))
            full = np.bincount(rows, minlength=len(queries))[rows[last]] >= k
            floor[rows[last][full]] = found["similarity"].to_numpy()[last][full]
            best = found if kept is None else pa.concat_tables([kept, found]).combine_chunks()
    return best


def _named(best: pa.Table, query_ids: pa.Array) -> pa.Table:
    return pa.table(
        {
            "query_id": pc.take(query_ids, best["q"]),
            "id": best["id"],
            "similarity": best["similarity"],
        }
    )


def _result_schema(queries: DataFrame, corpus: DataFrame) -> StructType:
    return StructType(
        [
            StructField("query_id", queries.schema["query_id"].dataType),
            StructField("id", corpus.schema["id"].dataType),
            StructField("similarity", DoubleType()),
        ]
    )


def _order():
    return [F.desc("similarity"), F.asc("id")]


def _search_by_broadcast(corpus: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """Send the queries to every task; each task returns its own best ``k`` per query."""
    schema = _result_schema(queries, corpus)
    asked = queries.select("query_id", "vector").toArrow()
    ids = asked["query_id"].combine_chunks()
    shared = queries.sparkSession.sparkContext.broadcast((ids, _matrix(asked["vector"])))

    def best_of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query_ids, matrix = shared.value
        best = _scan(matrix, batches, k) if len(matrix) else None
        if best is not None:
            yield from _named(best, query_ids).to_batches()

    return corpus.select("id", "vector").mapInArrow(best_of_task, schema)


def _blocks(n_queries: int, n_vectors: int, block: int, tasks: int) -> tuple[int, int]:
    """Into how many blocks queries and vectors are cut: of ``block`` rows at most, and enough for ``tasks`` if rows suffice."""
    q_blocks, d_blocks = max(1, math.ceil(n_queries / block)), max(1, math.ceil(n_vectors / block))
    while q_blocks * d_blocks < tasks and max(n_queries / q_blocks, n_vectors / d_blocks) >= 2 * BLOCK_ROWS:
        if n_queries / q_blocks >= n_vectors / d_blocks:
            q_blocks += 1
        else:
            d_blocks += 1
    return q_blocks, d_blocks


def _search_by_blocks(corpus: DataFrame, queries: DataFrame, k: int, n_queries: int, n_vectors: int, block: int) -> DataFrame:
    """Meet blocks of queries and blocks of vectors in tasks of a fixed size.

    Every task holds ``block`` queries and as many vectors at most and returns ``k`` rows per
    query; no pair of a query and a vector leaves a task. Blocks are cut by a hash of the
    id, so copies of one vector are dealt out evenly.
    """
    schema = _result_schema(queries, corpus)
    tasks = 2 * queries.sparkSession.sparkContext.defaultParallelism
    q_blocks, d_blocks = _blocks(n_queries, n_vectors, block, tasks)

    def cut(df: DataFrame, key: str, own: str, n_own: int, other: str, n_other: int) -> DataFrame:
        numbered = df.withColumn(own, F.pmod(F.xxhash64(key), F.lit(n_own)))
        every = F.sequence(F.lit(0).cast("bigint"), F.lit(n_other - 1).cast("bigint"))
        return numbered.withColumn(other, F.explode(every))

    left = cut(_side(queries, "query_id", "asked"), "query_id", "qb", q_blocks, "db", d_blocks)
    right = cut(_side(corpus, "id", "held"), "id", "db", d_blocks, "qb", q_blocks)
    return _best_of_groups(left, right, ["qb", "db"], k, schema)


def _side(df: DataFrame, key: str, vector: str) -> DataFrame:
    """One side of a cogroup under names of its own: both may come from the same table."""
    return df.select(key, F.col("vector").alias(vector))


def _best_of_groups(left: DataFrame, right: DataFrame, keys: list[str], k: int, schema: StructType) -> DataFrame:
    nothing = pa.table(
        {
            "query_id": left.select("query_id").limit(0).toArrow()["query_id"],
            "id": right.select("id").limit(0).toArrow()["id"],
            "similarity": pa.array([], pa.float64()),
        }
    )

    def best_of_group(queries: pa.Table, vectors: pa.Table) -> pa.Table:
        if not queries.num_rows or not vectors.num_rows:
            return nothing
        held = vectors.select(["id", "held"]).rename_columns(["id", "vector"]).combine_chunks()
        best = _scan(_matrix(queries["asked"]), [held], k)
        return nothing if best is None else _named(best, queries["query_id"].combine_chunks())

    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(best_of_group, schema)


def _merged(found: DataFrame, k: int, without_self: bool) -> DataFrame:
    """The best of all tasks, each of which found ``k`` per query.

    With few queries and very many tasks a query's rows meet in ``MERGE_SALTS`` tasks
    first, so that merging is not left to as many tasks as there are queries.
    """
    if without_self:
        found = found.filter("query_id <> id")
    return top_per_key(found, ["query_id"], _order(), k, salts=MERGE_SALTS, salt_on=("id",))


def search(
    corpus: DataFrame,
    queries: DataFrame,
    k: int,
    without_self: bool = False,
    broadcast_bytes: int = BROADCAST_BYTES,
    block: int | None = None,
) -> DataFrame:
    """Exact best ``k``: ``corpus(id, vector)``, ``queries(query_id, vector)``.

    Returns ``(query_id, id, similarity, rank)``, on request without the query's own id. Up
    to ``broadcast_bytes`` of query vectors go to every task and the corpus is read once and
    never shuffled. Beyond that both sides are cut into blocks. The work is queries times vectors
    either way; where that is too much, :func:`search_approximately` trades recall for it.
    """
    queries = queries.filter("vector IS NOT NULL")
    n_queries, width = queries.agg(F.count(F.lit(1)), F.mode(F.size("vector"), True)).first()
    width = max(1, width or 1)
    corpus, queries = (df.filter(F.size("vector") == width) for df in (corpus, queries))
    block = block or max(1, BLOCK_BYTES // (8 * width))
    wanted = k + 1 if without_self else k
    if 8 * width * n_queries <= broadcast_bytes:
        found = _search_by_broadcast(corpus, queries, wanted)
    else:
        found = _search_by_blocks(corpus, queries, wanted, n_queries, corpus.count(), block)
    return _merged(found, k, without_self)


def search_self(index: DataFrame, key: str, k: int, **how) -> DataFrame:
    """The best ``k`` others of every row of an index."""
    corpus = index.select(F.col(key).alias("id"), "vector")
    queries = index.select(F.col(key).alias("query_id"), "vector")
    return search(corpus, queries, k, without_self=True, **how)


# -- approximate search ---------------------------------------------------------------------


def search_approximately(
    corpus: DataFrame,
    queries: DataFrame,
    k: int,
    without_self: bool = False,
    bucket_length: float = 0.25,
    tables: int = 8,
    width: int = 2,
    seed: int = 7,
    block: int | None = None,
) -> DataFrame:
    """Best ``k`` among the vectors that share a bucket with the query in any table.

    A bucket is made of ``width`` random projections: more of them make smaller buckets,
    more tables find more. A bucket of more than ``block`` vectors or queries, by default of
    more than ``BLOCK_BYTES``, is cut into blocks of that size. Within a block a task returns ``k`` rows per query, never the
    pairs of a bucket.
    """
    from pyspark.ml.feature import BucketedRandomProjectionLSH
    from pyspark.ml.functions import array_to_vector, vector_to_array

    from deskmill.functions.embedding import unit

    schema = _result_schema(queries, corpus)
    corpus, queries = corpus.filter("vector IS NOT NULL"), queries.filter("vector IS NOT NULL")
    if block is None:
        length = queries.select(F.size("vector")).first()
        block = max(1, BLOCK_BYTES // (8 * max(1, length[0] if length else 1)))

    def dense(df: DataFrame, key: str, vector: str) -> DataFrame:
        features = array_to_vector(unit(F.col(vector)))
        return _side(df, key, vector).withColumn("features", features)

    held, asked = dense(corpus, "id", "held"), dense(queries, "query_id", "asked")
    lsh = BucketedRandomProjectionLSH(
        inputCol="features",
        outputCol="hashes",
        bucketLength=bucket_length,
        numHashTables=tables * width,
        seed=seed,
    )
    model = lsh.fit(held)

    def hashed(df: DataFrame, key: str, vector: str) -> DataFrame:
        cells = [vector_to_array(F.col("hashes")[i])[0] for i in range(tables * width)]
        buckets = F.array(*[F.xxhash64(*cells[i : i + width]) for i in range(0, len(cells), width)])
        return unnest(model.transform(df), key, vector, array=buckets, value="bucket", position="tab")

    right, left = hashed(held, "id", "held"), hashed(asked, "query_id", "asked")
    # One row per bucket: how many blocks its vectors and its queries need.
    sizes = (
        right.groupBy("tab", "bucket")
        .agg(F.ceil(F.count(F.lit(1)) / block).alias("nd"))
        .join(left.groupBy("tab", "bucket").agg(F.ceil(F.count(F.lit(1)) / block).alias("nq")), ["tab", "bucket"])
    )

    def cut(df: DataFrame, key: str, own: str, n_own: str, other: str, n_other: str) -> DataFrame:
        every = F.sequence(F.lit(0).cast("bigint"), F.col(n_other) - 1)
        return (
            df.join(sizes, ["tab", "bucket"])
            .withColumn(own, F.pmod(F.xxhash64(key), F.col(n_own)))
            .withColumn(other, F.explode(every))
            .drop("nd", "nq")
        )

    found = _best_of_groups(
        cut(left, "query_id", "qb", "nq", "db", "nd"),
        cut(right, "id", "db", "nd", "qb", "nq"),
        ["tab", "bucket", "qb", "db"],
        k + 1 if without_self else k,
        schema,
    )
    once = found.groupBy("query_id", "id").agg(F.max("similarity").alias("similarity"))
    return _merged(once, k, without_self)


def recall(approximate: DataFrame, exact: DataFrame) -> DataFrame:
    """The share of the exact results that the approximate search found."""
    hit = approximate.select("query_id", "id", F.lit(1).alias("hit"))
    return (
        exact.join(hit, ["query_id", "id"], "left")
        .agg(
            F.countDistinct("query_id").alias("n_queries"),
            F.count(F.lit(1)).alias("expected"),
            F.count("hit").alias("found"),
        )
        .withColumn("recall", F.round(F.col("found") / F.col("expected"), 6))
    )


# -- retrieval over several sources ---------------------------------------------------------


def retrieve(indexes: dict[str, DataFrame], questions: DataFrame, k: int, **how) -> DataFrame:
    """One ranked list per question over several indexes ``(uri, vector)``.

    Every hit says which source it is from and cites its URI. A URI is the id here, so the
    indexes are searched as one, in one pass.
    """
    corpus = None
    for df in indexes.values():
        part = df.select(F.col("uri").alias("id"), "vector")
        corpus = part if corpus is None else corpus.unionByName(part)
    hits = search(corpus, questions, k, **how)
    source = F.lit(None)
    for name in indexes:
        source = F.when(F.col("id").startswith(f"{name}://"), F.lit(name)).otherwise(source)
    return hits.select("query_id", "rank", source.alias("source"), F.col("id").alias("uri"), "similarity")

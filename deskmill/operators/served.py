"""A served vector index: stored cells, compressed vectors, searches that read few cells, changes.

The index is a folder. ``model`` holds the centres of the cells and the code words; ``vectors``
holds the rows, one folder for each generation and cell, each with its id, its vector and a code
of a few bytes; ``versions`` says which generation of each cell is current. A search takes the
cells whose centres are nearest to each query, reads the codes of just these cells, keeps a
shortlist for each query, and fetches the vectors of the shortlist alone for the exact cosine. A
change writes only the cells that it touches anew and then a new version: a reader sees one
version or the other, and a job that runs again overwrites its own generation.

Centres come from spherical k-means in Spark, the code words from k-means over parts of what is
left of a vector beside its centre. Both learn from a sample of bounded size, chosen by a hash of
the id; every row is indexed. Rows without a vector, and vectors of another length than the
index's, are not held; :func:`odd_rows` counts them. Ids are unique.
"""

from __future__ import annotations

import dataclasses
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StructField, StructType

from deskmill.operators.skew import top_per_key
from deskmill.operators.vectors import (
    BLOCK_BYTES,
    BROADCAST_BYTES,
    CELLS,
    DIGITS,
    MERGE_SALTS,
    _blocks,
    _cosines,
    _first_k,
    _matrix,
    _merged,
    _norms,
    _ranked,
    _result_schema,
)
from deskmill.operators.vectors import search as exact_search
from deskmill.session import materialized

#: Most cells of an index: their centres go to every task.
MOST_CELLS = 16_384
#: Rows that centres learn from, for each cell, and rows that code words learn from.
ROWS_PER_CELL, CODE_ROWS = 256, 65_536
ROUNDS, CODE_ROUNDS = 3, 8
#: Bytes of a code, at most, and words that a byte tells apart.
CODE_BYTES, WORDS = 16, 256
#: Rows of a file: a cell that holds more, such as copies of one vector, is cut.
FILE_ROWS = 500_000
#: Ids of a shortlist that are given to the reader as a filter.
FEW_IDS = 1000

#: Bytes of a row of a shortlist, and rows that wait before they are ranked.
SHORT_BYTES, RANKED = 32, 100_000

#: Changes that bring a row; the others only take rows out.
PUT = ("insert", "update_postimage")


@dataclasses.dataclass
class Model:
    centres: np.ndarray  # cells x length
    words: np.ndarray  # parts x words x (length / parts)

    @property
    def length(self) -> int:
        return self.centres.shape[1]


@dataclasses.dataclass
class Served:
    """One version of a stored index."""

    spark: SparkSession
    folder: str
    version: int
    model: Model
    cells: dict[int, tuple[int, int]]  # cell: generation, rows; at most MOST_CELLS

    def rows(self, cells: list[int] | None = None) -> DataFrame:
        """``cell, id, codes, vector`` of some cells, or of all; others are not read."""
        wanted: dict[int, list[int]] = {}
        for cell in self.cells if cells is None else cells:
            if cell in self.cells:
                wanted.setdefault(self.cells[cell][0], []).append(cell)
        held = self.spark.read.parquet(f"{self.folder}/vectors")
        current = F.lit(False)
        for generation, some in sorted(wanted.items()):
            current = current | ((F.col("generation") == generation) & F.col("cell").isin(sorted(some)))
        return held.filter(current).drop("generation")


# -- learning -------------------------------------------------------------------------------


def _unit_rows(matrix: np.ndarray) -> np.ndarray:
    norms = _norms(matrix)
    return matrix / np.where(norms > 0, norms, 1.0)[:, None]


def _cells_of(units: np.ndarray, centres: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` nearest centres of each row, the nearest first; equal ones by number."""
    out = np.empty((len(units), n), np.int32)
    step = max(1, CELLS // len(centres))
    for at in range(0, len(units), step):
        about = units[at : at + step] @ centres.T
        out[at : at + step] = np.argsort(-about, axis=1, kind="stable")[:, :n] if n > 1 else about.argmax(1)[:, None]
    return out


def _sampled(vectors: DataFrame, n: int, wanted: int) -> DataFrame:
    """About ``wanted`` of ``n`` rows, by a hash of the id; all if there are no more."""
    if n <= wanted:
        return vectors
    return vectors.filter(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < int(wanted / n * (1 << 30)))


def _centres(sample: DataFrame, cells: int, rounds: int) -> np.ndarray:
    """Spherical k-means; it begins with the vectors whose ids have the least MD5."""
    order = [F.md5(F.col("id").cast("string")), F.col("id")]
    first = sample.orderBy(*order).limit(cells).select("vector").toArrow()  # at most MOST_CELLS
    centres = _unit_rows(_matrix(first["vector"]))
    spark = sample.sparkSession
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(centres)

        def add_up(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            held = shared.value
            sums, seen = np.zeros_like(held), np.zeros(len(held), bool)
            for batch in batches:
                units = _unit_rows(_matrix(batch.column("vector")))
                cell = _cells_of(units, held, 1)[:, 0]
                np.add.at(sums, cell, units)
                seen[cell] = True
            cell = np.flatnonzero(seen).astype(np.int32)
            if len(cell):
                yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(list(sums[cell]), pa.list_(pa.float64()))], ["cell", "sums"])

        parts = sample.select("vector").mapInArrow(add_up, "cell int, sums array<double>")
        each = parts.select("cell", F.posexplode("sums").alias("at", "x")).groupBy("cell", "at").agg(F.sum("x").alias("x")).toArrow()
        sums = np.zeros_like(centres)
        sums[each["cell"].to_numpy(), each["at"].to_numpy()] = each["x"].to_numpy()
        moved = _norms(sums) > 0  # an empty cell keeps its centre
        centres = np.where(moved[:, None], _unit_rows(sums), centres)
        shared.destroy()
    return centres


def _lloyd(points: np.ndarray, k: int, rounds: int) -> np.ndarray:
    words = points[:k].copy()
    for _ in range(rounds):
        near = _nearest_words(points, words)
        counts = np.bincount(near, minlength=len(words))
        sums = np.zeros_like(words)
        np.add.at(sums, near, points)
        words = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], words)
    return words


def _nearest_words(points: np.ndarray, words: np.ndarray) -> np.ndarray:
    half = (words * words).sum(1) / 2
    out = np.empty(len(points), np.uint8)
    for at in range(0, len(points), CELLS // WORDS):
        out[at : at + CELLS // WORDS] = (points[at : at + CELLS // WORDS] @ words.T - half).argmax(1)
    return out


def _words(sample: DataFrame, centres: np.ndarray, parts: int) -> np.ndarray:
    """Code words of each part of the vectors' differences from their centres, a task a part."""
    shared = sample.sparkSession.sparkContext.broadcast(centres)
    width = centres.shape[1] // parts

    def differences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units = _unit_rows(_matrix(batch.column("vector")))
            rest = (units - shared.value[_cells_of(units, shared.value, 1)[:, 0]]).reshape(-1, width)
            part = np.tile(np.arange(parts, dtype=np.int32), batch.num_rows)
            deal = np.repeat(batch.column("deal").to_numpy(), parts)
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(deal), pa.array(list(rest), pa.list_(pa.float64()))], ["part", "deal", "rest"])

    def learn(table: pa.Table) -> pa.Table:
        table = table.sort_by("deal")
        words = _lloyd(_matrix(table["rest"]), WORDS, CODE_ROUNDS)
        number = pa.array(np.arange(len(words), dtype=np.int32))
        part = pa.array(np.full(len(words), table["part"][0].as_py(), np.int32))
        return pa.table({"part": part, "word": number, "value": pa.array(list(words), pa.list_(pa.float64()))})

    rows = sample.select(F.xxhash64("id").alias("deal"), "vector").mapInArrow(differences, "part int, deal long, rest array<double>")
    found = rows.groupBy("part").applyInArrow(learn, "part int, word int, value array<double>").toArrow()
    found = found.sort_by([("part", "ascending"), ("word", "ascending")])
    return _matrix(found["value"]).reshape(parts, -1, width)


def cells_for(n: int) -> int:
    """Cells of an index of ``n`` vectors."""
    return min(MOST_CELLS, max(1, math.ceil(math.sqrt(n))))


def _learned(vectors: DataFrame, n: int, cells: int | None, rounds: int) -> Model:
    cells = min(MOST_CELLS, n, cells or cells_for(n))
    wanted = max(cells * ROWS_PER_CELL, CODE_ROWS)
    sample = vectors if n <= wanted else materialized(_sampled(vectors, n, wanted), "sample")
    centres = _centres(sample, cells, rounds)
    length = centres.shape[1]
    parts = max(p for p in range(1, CODE_BYTES + 1) if length % p == 0)
    return Model(centres, _words(_sampled(sample, min(n, wanted), CODE_ROWS), centres, parts))


# -- writing --------------------------------------------------------------------------------


def _encoded(vectors: DataFrame, model: Model) -> DataFrame:
    """``cell, id, codes, vector``; nothing is shuffled."""
    shared = vectors.sparkSession.sparkContext.broadcast(model)
    parts, _, width = model.words.shape

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres, words = shared.value.centres, shared.value.words
        for batch in batches:
            units = _unit_rows(_matrix(batch.column("vector")))
            cell = _cells_of(units, centres, 1)[:, 0]
            rest = (units - centres[cell]).reshape(-1, parts, width)
            codes = np.stack([_nearest_words(rest[:, p], words[p]) for p in range(parts)], axis=1) if len(units) else np.zeros((0, parts), np.uint8)
            flat = pa.FixedSizeBinaryArray.from_buffers(pa.binary(parts), len(units), [None, pa.py_buffer(codes.tobytes())])
            yield pa.RecordBatch.from_arrays([pa.array(cell), batch.column("id"), flat.cast(pa.binary()), batch.column("vector")], ["cell", "id", "codes", "vector"])

    schema = StructType([StructField("cell", IntegerType()), vectors.schema["id"]])
    schema = schema.add("codes", "binary").add(vectors.schema["vector"])
    return vectors.select("id", "vector").mapInArrow(encode, schema)


def _fit(vectors: DataFrame, length: int) -> DataFrame:
    return vectors.select("id", "vector").filter(F.col("id").isNotNull() & (F.size("vector") == length))


def _write_generation(rows: DataFrame, folder: str, generation: int, file_rows: int) -> dict[int, tuple[int, int]]:
    """Write whole cells; a cell of many rows is cut by a hash of the id. Gives the cells written."""
    sizes = {r["cell"]: r["count"] for r in rows.groupBy("cell").count().collect()}  # at most MOST_CELLS
    large = [(cell, math.ceil(n / file_rows)) for cell, n in sizes.items() if n > file_rows]
    files = rows.sparkSession.createDataFrame(_columns(large, ["cell", "_files"], [pa.int32(), pa.int64()]))
    cut = F.pmod(F.xxhash64("id"), F.coalesce("_files", F.lit(1)))
    dealt = rows.join(files, "cell", "left").repartition("cell", cut).drop("_files")
    path = f"{folder}/vectors/generation={generation}"
    dealt = dealt.sortWithinPartitions("cell", "id")
    dealt.write.mode("overwrite").option("maxRecordsPerFile", file_rows).partitionBy("cell").parquet(path)
    return {cell: (generation, n) for cell, n in sizes.items()}


def _columns(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.Table:
    return pa.table({name: pa.array([r[i] for r in rows], kind) for i, (name, kind) in enumerate(zip(names, kinds))})


def _write_version(spark: SparkSession, folder: str, version: int, cells: dict[int, tuple[int, int]]) -> None:
    rows = [(cell, generation, n) for cell, (generation, n) in sorted(cells.items())]
    named = spark.createDataFrame(_columns(rows, ["cell", "generation", "n"], [pa.int32(), pa.int32(), pa.int64()]))
    named.coalesce(1).write.mode("overwrite").parquet(f"{folder}/versions/version={version}")


def create(vectors: DataFrame, folder: str, cells: int | None = None, rounds: int = ROUNDS, file_rows: int = FILE_ROWS) -> Served:
    """Learn a model from ``vectors(id, vector)`` and write all of them as version 0.

    There are as many cells as the root of the number of vectors, up to ``MOST_CELLS``. The
    length of the index is the one that most vectors have.
    """
    spark = vectors.sparkSession
    lengths = vectors.filter("id IS NOT NULL AND vector IS NOT NULL AND size(vector) > 0").groupBy(F.size("vector").alias("length")).count()
    most = lengths.orderBy(F.desc("count"), "length").first()
    if most is None:
        raise ValueError("an index is learned from vectors, and there are none")
    fitting = _fit(vectors, most["length"])
    model = _learned(fitting, most["count"], cells, rounds)
    # Centres are part -1.
    rows = [(-1, i, row) for i, row in enumerate(model.centres)]
    rows += [(p, w, row) for p, part in enumerate(model.words) for w, row in enumerate(part)]
    table = _columns(rows, ["part", "number", "value"], [pa.int32(), pa.int32(), pa.list_(pa.float64())])
    spark.createDataFrame(table).coalesce(1).write.parquet(f"{folder}/model")
    written = _write_generation(materialized(_encoded(fitting, model), "encoded"), folder, 0, file_rows)
    _write_version(spark, folder, 0, written)
    return Served(spark, folder, 0, model, written)


def opened(spark: SparkSession, folder: str, version: int | None = None) -> Served:
    """An index as it was at a version, by default the newest that was written whole."""
    held = spark.read.parquet(f"{folder}/versions")
    if version is None:
        version = held.agg(F.max("version")).first()[0]
    cells = {r["cell"]: (r["generation"], r["n"]) for r in held.filter(F.col("version") == version).collect()}
    rows = spark.read.parquet(f"{folder}/model").toArrow().sort_by([("part", "ascending"), ("number", "ascending")])
    part = rows["part"].to_numpy()
    value = _matrix(rows["value"].filter(pa.array(part >= 0)))
    words = value.reshape(part.max() + 1, -1, value.shape[1])
    return Served(spark, folder, version, Model(_matrix(rows["value"].filter(pa.array(part < 0))), words), cells)


def apply_changes(index: Served, changes: DataFrame, file_rows: int = FILE_ROWS) -> Served:
    """The next version of an index, from a change feed ``(id, change_type, vector)``.

    Deleted keys and the old vectors of updated ones leave; inserted keys and new vectors come,
    in place of what an id had, so that a feed applied twice changes nothing more. Only the cells
    that lose or gain a row are read in full and written.
    """
    spark = index.spark
    changes = materialized(changes.select("id", "change_type", "vector"), "changes")
    ids = changes.select("id").distinct()
    fresh = materialized(_encoded(_fit(changes.filter(F.col("change_type").isin(*PUT)), index.model.length), index.model), "fresh")
    lost = index.rows().select("cell", "id").join(ids, "id", "left_semi").select("cell")
    touched = [r["cell"] for r in lost.unionByName(fresh.select("cell")).distinct().collect()]  # at most MOST_CELLS
    kept = index.rows(touched).join(ids, "id", "left_anti").select("cell", "id", "codes", "vector")
    version = index.version + 1
    written = _write_generation(kept.unionByName(fresh), index.folder, version, file_rows) if touched else {}
    cells = {c: held for c, held in index.cells.items() if c not in set(touched)} | written
    _write_version(spark, index.folder, version, cells)
    return Served(spark, index.folder, version, index.model, cells)


def odd_rows(index: Served, vectors: DataFrame) -> DataFrame:
    """``n_rows, n_without, n_other_length``: what of ``vectors(id, vector)`` an index does not hold."""
    without = F.col("id").isNull() | F.col("vector").isNull()
    other = ~without & (F.size("vector") != index.model.length)
    return vectors.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(without).alias("n_without"), F.count_if(other).alias("n_other_length"))


def probes_for(index: Served, vectors: DataFrame, k: int, recall: float, queries: int = 256) -> int:
    """The fewest probes with which a search finds that share of the exact best ``k``.

    Measured on ``queries`` of ``vectors(id, vector)``, those of least MD5 of the id, each against
    all vectors: a neighbour is found if its cell is among those probed.
    """
    some = vectors.filter(F.size("vector") == index.model.length).orderBy(F.md5(F.col("id").cast("string")), "id").limit(queries)
    asked = materialized(some.select(F.col("id").alias("query_id"), "vector"), "asked")
    exact = exact_search(vectors, asked, k, without_self=True)
    cells = index.rows().select("id", "cell")
    near = exact.join(cells, "id").groupBy("query_id").agg(F.collect_list("cell").alias("cells"))  # k a query
    table = near.join(asked, "query_id").select("cells", "vector").toArrow()  # as many rows as queries
    if not table.num_rows:
        return 1
    order = _cells_of(_unit_rows(_matrix(table["vector"])), index.model.centres, len(index.model.centres))
    place = np.argsort(order, axis=1)
    at = np.sort(np.concatenate([place[i, found] for i, found in enumerate(table["cells"].to_pylist())]))
    return int(at[max(0, math.ceil(recall * len(at)) - 1)]) + 1


# -- searching ------------------------------------------------------------------------------


class _Best:
    """The best ``k`` ids of each query so far, by about what the codes say."""

    def __init__(self, units: np.ndarray, model: Model, k: int):
        self.units, self.model, self.k = units.astype(np.float32), model, k
        self.floor = np.full(len(units), -np.inf, np.float32)
        self.table: pa.Table | None = None
        self.waiting: list[pa.Table] = []

    def add(self, cell: int, asked: np.ndarray, rows: pa.RecordBatch | pa.Table) -> None:
        """Rows ``id, codes`` of one cell, for the queries ``asked``."""
        parts, _, width = self.model.words.shape
        step = max(1, CELLS // max(1, len(asked)))
        for at in range(0, rows.num_rows, step):
            some = rows.slice(at, step)
            codes = np.frombuffer(b"".join(some.column("codes").to_pylist()), np.uint8).reshape(-1, parts)
            about = np.concatenate([self.model.words[p][codes[:, p]] for p in range(parts)], axis=1) + self.model.centres[cell]
            score = self.units[asked] @ about.T.astype(np.float32)
            near = score >= self.floor[asked][:, None]
            if score.shape[1] > self.k:
                near &= score >= np.partition(score, -self.k, axis=1)[:, -self.k][:, None]
            q, d = np.nonzero(near)
            if not len(q):
                continue
            found = pa.table(
                {
                    "q": pa.array(asked[q].astype(np.int32)),
                    "cell": pa.array(np.full(len(q), cell, np.int32)),
                    "id": some.column("id").take(pa.array(d)),
                    "similarity": pa.array(score[q, d].astype(np.float64)),
                }
            )
            self.waiting.append(found)
            # Ranked anew once as many wait as are held, not for every cell.
            if sum(t.num_rows for t in self.waiting) > max(RANKED, 0 if self.table is None else self.table.num_rows):
                self.settle()

    def settle(self) -> None:
        """Ranks what waits among the best so far."""
        if not self.waiting:
            return
        best = self.table = _ranked(pa.concat_tables([*([] if self.table is None else [self.table]), *self.waiting]), self.k)
        self.waiting = []
        held = best["q"].to_numpy()
        last = np.flatnonzero(np.append(held[1:] != held[:-1], True))
        full = np.bincount(held, minlength=len(self.floor))[held[last]] >= self.k
        self.floor[held[last][full]] = best["similarity"].to_numpy()[last][full]


def _found(best: _Best, query_ids: pa.Array) -> pa.Table:
    table = best.table
    return pa.table({"query_id": query_ids.take(table["q"].combine_chunks()), "cell": table["cell"], "id": table["id"], "similarity": table["similarity"]})


def _about_schema(queries: DataFrame, held: DataFrame) -> StructType:
    return StructType([queries.schema["query_id"], StructField("cell", IntegerType()), held.schema["id"]]).add("similarity", "double")


def _probed_by_broadcast(index: Served, queries: DataFrame, probes: int, shortlist: int) -> tuple[DataFrame, list[int]]:
    """The queries go to every task; the codes of their cells are read once and not shuffled."""
    asked = queries.toArrow()  # its size was checked
    ids = asked["query_id"].combine_chunks()
    units = _unit_rows(_matrix(asked["asked"])) if len(ids) else np.zeros((0, index.model.length))
    cells = _cells_of(units, index.model.centres, probes)
    by_cell = {int(c): np.flatnonzero((cells == c).any(1)) for c in np.unique(cells)}
    shared = index.spark.sparkContext.broadcast((ids, units, by_cell, index.model))

    def best_of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query_ids, matrix, wanted, model = shared.value
        best = _Best(matrix, model, shortlist)
        for batch in batches:
            cell = batch.column("cell").to_numpy()
            edges = np.flatnonzero(np.append(True, cell[1:] != cell[:-1])) if len(cell) else []
            for begin, end in zip(edges, [*edges[1:], len(cell)]):
                best.add(int(cell[begin]), wanted[int(cell[begin])], batch.slice(begin, end - begin))
        best.settle()
        if best.table is not None:
            yield from _found(best, query_ids).to_batches()

    held = index.rows(list(by_cell)).select("cell", "id", "codes")
    return held.mapInArrow(best_of_task, _about_schema(queries, held)), list(by_cell)


def _groups(cells: dict[int, int], n_centres: int, size: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Neighbouring cells put into groups of about ``size`` rows; a larger cell is cut over several groups of its own.

    For each cell its first group (-1: not held) and into how many groups it is cut, and how many groups there are.
    """
    first, pieces = np.full(n_centres, -1, np.int64), np.ones(n_centres, np.int64)
    group, room = -1, 0
    for cell, n in sorted(cells.items()):
        if n > size:
            first[cell], pieces[cell] = group + 1, math.ceil(n / size)
            group, room = group + pieces[cell], 0
            continue
        if n > room:
            group, room = group + 1, size
        first[cell], room = group, room - n
    return first, pieces, int(group) + 1


def _probed(index: Served, queries: DataFrame, probes: int) -> list[int]:
    """The held cells that any of the queries probes."""
    if probes >= len(index.model.centres):
        return sorted(index.cells)
    shared = index.spark.sparkContext.broadcast(index.model.centres)

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell = np.unique(_cells_of(_unit_rows(_matrix(batch.column("asked"))), shared.value, probes))
            yield pa.RecordBatch.from_arrays([pa.array(cell)], ["cell"])

    found = queries.select("asked").mapInArrow(near, "cell int").distinct().collect()  # at most MOST_CELLS
    return sorted(r["cell"] for r in found if r["cell"] in index.cells)


def _probed_by_blocks(index: Served, queries: DataFrame, n_queries: int, k: int, probes: int, shortlist: int, block: int) -> DataFrame:
    """Blocks of queries meet groups of the cells that they probe, in tasks of a fixed size.

    Codes travel with their vectors here: nearly every vector is in some query's shortlist. A task makes a
    shortlist for each query by the codes, takes exact cosines, and returns ``k`` rows a query, the best of the
    probed cells; no shortlist leaves it. Which cells of a group a query probes is a bit for each cell.
    """
    spark, centres = index.spark, index.model.centres
    cells = _probed(index, queries, probes)
    if not cells:
        return spark.createDataFrame([], _result_schema(queries, index.rows()))
    sizes = {cell: index.cells[cell][1] for cell in cells}
    tasks = 2 * spark.sparkContext.defaultParallelism
    q_blocks, d_blocks = _blocks(n_queries, sum(sizes.values()), block, tasks)
    first, pieces, n_groups = _groups(sizes, len(centres), min(block, math.ceil(sum(sizes.values()) / d_blocks)))
    # Cells of a group: from ``begin[group]`` up to ``end[group]``, all held ones of them.
    held_cells = np.flatnonzero(first >= 0)
    begin, end = np.full(n_groups, len(centres), np.int64), np.zeros(n_groups, np.int64)
    for cell in held_cells:
        some = slice(first[cell], first[cell] + pieces[cell])
        begin[some], end[some] = np.minimum(begin[some], cell), cell + 1
    shared = spark.sparkContext.broadcast((index.model, begin, end))

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, begins, ends = shared.value
        step = max(1, CELLS // len(model.centres))
        for whole in batches:
            for at in range(0, whole.num_rows, step):
                batch = whole.slice(at, step)
                near = _cells_of(_unit_rows(_matrix(batch.column("asked"))), model.centres, probes)
                member = np.zeros((batch.num_rows, len(model.centres)), bool)
                np.put_along_axis(member, near.astype(np.int64), True, axis=1)
                groups, at_rows, bits = [], [], []
                for group, (low, high) in enumerate(zip(begins, ends, strict=True)):
                    some = member[:, low:high]
                    hit = np.flatnonzero(some.any(1))
                    groups.append(np.full(len(hit), group))
                    at_rows.append(hit)
                    bits += [row.tobytes() for row in np.packbits(some[hit], axis=1)]
                row = pa.array(np.concatenate(at_rows))
                columns = [pa.array(np.concatenate(groups)), pa.array(bits, pa.binary()), *batch.select(["query_id", "asked"]).take(row).columns]
                yield pa.RecordBatch.from_arrays(columns, ["db", "cells", "query_id", "asked"])

    schema = StructType([StructField("db", LongType()), StructField("cells", BinaryType()), queries.schema["query_id"], queries.schema["asked"]])
    left = queries.select("query_id", "asked").mapInArrow(probe, schema).withColumn("qb", F.pmod(F.xxhash64("query_id"), F.lit(q_blocks)))
    placed = [(int(c), int(first[c]), int(pieces[c])) for c in held_cells]  # at most MOST_CELLS
    places = materialized(spark.createDataFrame(_columns(placed, ["cell", "first", "pieces"], [pa.int32(), pa.int64(), pa.int64()])), "places")
    every = F.sequence(F.lit(0).cast("bigint"), F.lit(q_blocks - 1).cast("bigint"))
    right = (
        index.rows(cells).join(places, "cell").withColumn("db", F.col("first") + F.pmod(F.xxhash64("id"), F.col("pieces")))
        .select("db", "cell", "id", "codes", "vector").withColumn("qb", F.explode(every))
    )
    out = _result_schema(queries, right)
    empty = pa.table({"query_id": queries.select("query_id").limit(0).toArrow()["query_id"], "id": right.select("id").limit(0).toArrow()["id"], "similarity": pa.array([], pa.float64())})

    def best_of_group(some: pa.Table, rows: pa.Table) -> pa.Table:
        if not some.num_rows or not rows.num_rows:
            return empty
        model, begins, ends = shared.value
        group = some["db"][0].as_py()
        asked = _matrix(some["asked"])
        packed = np.frombuffer(b"".join(some["cells"].to_pylist()), np.uint8).reshape(len(asked), -1)
        member = np.unpackbits(packed, axis=1, count=int(ends[group] - begins[group])).astype(bool)
        rows = rows.sort_by([("cell", "ascending"), ("id", "ascending")]).combine_chunks()
        q, d, cosine = _best_of_block(model, asked, member, rows, int(begins[group]), k, shortlist)
        return pa.table({"query_id": some["query_id"].combine_chunks().take(pa.array(q)), "id": rows["id"].take(pa.array(d)), "similarity": pa.array(cosine)})

    return left.groupBy("qb", "db").cogroup(right.groupBy("qb", "db")).applyInArrow(best_of_group, out)


def _best_of_block(
    model: Model, asked: np.ndarray, member: np.ndarray, rows: pa.Table, begin: int, k: int, shortlist: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The best ``k`` of ``rows``, sorted by cell, for each query: the query's row, the row and the exact cosine.

    ``member`` says which cells, from ``begin`` on, a query probes. Queries of near cells come together, a few at
    a time, and meet the cells that any of them probes. The ``k``-th best of the shortlist is a floor: rows that
    the codes put too low, but whose cosine in single precision may reach it, are taken in, so that none is missed.
    """
    held, ids = _matrix(rows["vector"]), rows["id"].combine_chunks()
    cell = rows["cell"].to_numpy() - begin
    by_id = np.empty(len(held), np.int64)
    by_id[pc.sort_indices(ids).to_numpy()] = np.arange(len(held))
    codes = np.frombuffer(b"".join(rows["codes"].to_pylist()), np.uint8).reshape(len(held), -1)
    about = np.concatenate([model.words[p].astype(np.float32)[codes[:, p]] for p in range(codes.shape[1])], axis=1)
    about += model.centres.astype(np.float32)[cell + begin]
    norms, held_norms = _norms(asked), _norms(held)
    units, held_units = _unit_rows(asked).astype(np.float32), _unit_rows(held).astype(np.float32)
    margin = (held.shape[1] + 8) * 2.0**-23 + 10.0**-DIGITS
    # Queries whose first probed cells agree probe much the same cells.
    order = np.lexsort(np.packbits(member, axis=1).T[::-1]) if not member.all() else np.arange(len(asked))
    tile = max(1, CELLS // len(held))
    found = []
    for at in range(0, len(asked), tile):
        some = order[at : at + tile]
        probed = member[some]
        place = slice(None) if probed.all() else np.flatnonzero(probed.any(0)[cell])
        out = None if probed.all() else ~probed[:, cell[place]]
        at_id, at_row = by_id[place], np.arange(len(held))[place]
        score = _scores(units[some], about[place], out)
        q, d = _shortlisted(score, at_id, shortlist)
        cosine = _cosines(asked, norms, held, some[q], at_row[d], held_norms)
        best = _first_k(q, cosine, at_id[d], k)
        floor = np.full(len(some), np.inf)
        np.minimum.at(floor, q[best], cosine[best])
        floor[np.bincount(q[best], minlength=len(some)) < k] = -np.inf
        q, d = _reaching(_scores(units[some], held_units[place], out), floor - margin)
        cosine = _cosines(asked, norms, held, some[q], at_row[d], held_norms)
        best = _first_k(q, cosine, at_id[d], k)
        found.append((some[q[best]], at_row[d[best]], cosine[best]))
    q, d, cosine = (np.concatenate(x) for x in zip(*found, strict=True))
    return q, d, cosine


def _scores(units: np.ndarray, rows: np.ndarray, out: np.ndarray | None) -> np.ndarray:
    score = units @ rows.T
    if out is not None:
        score[out] = -np.inf
    return score


def _reaching(score: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where scores are at least ``low`` of their row; minus infinity is none."""
    low = np.maximum(low, np.finfo(np.float32).min).astype(np.float32)
    return np.divmod(np.flatnonzero(score >= low[:, None]), score.shape[1])


def _shortlisted(score: np.ndarray, by_id: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Where the ``n`` greatest scores of each row are, scores rounded to six digits, equal ones by id; minus infinity is none."""
    low = np.full(len(score), -np.inf, np.float32)
    if score.shape[1] > n:
        # The least score that counts, guessed from every eighth one; where fewer than n reach it, from all.
        part = score[:, ::8]
        guess = math.ceil(n / 8 * 1.5) + 8
        if part.shape[1] > guess:
            low = np.partition(part, -guess, axis=1)[:, -guess]
        few = np.flatnonzero(np.count_nonzero(score >= low[:, None], axis=1) < n)
        low[few] = np.partition(score[few], -n, axis=1)[:, -n]
    q, d = _reaching(score, low - 2e-6)
    best = _first_k(q, np.round(score[q, d], DIGITS), by_id[d], n)
    return q[best], d[best]


def _exactly(index: Served, short: DataFrame, cells: list[int], queries: DataFrame) -> DataFrame:
    """The cosines of a shortlist, from the vectors themselves.

    Files are sorted by id: for few ids the reader skips the pages that hold none of them.
    """
    vectors = index.rows(cells).select("cell", "id", "vector")
    few = short.select("id").distinct().limit(FEW_IDS + 1).collect()
    if len(few) <= FEW_IDS:
        vectors = vectors.filter(F.col("id").isin([r["id"] for r in few]))
    pairs = vectors.join(short.select("query_id", "cell", "id"), ["cell", "id"]).join(queries, "query_id")
    schema = _result_schema(queries.withColumnRenamed("asked", "vector"), vectors)

    def cosines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            asked, held = _matrix(batch.column("asked")), _matrix(batch.column("vector"))
            row = np.arange(batch.num_rows)
            exact = _cosines(asked, _norms(asked), held, row, row)
            yield pa.RecordBatch.from_arrays([batch.column("query_id"), batch.column("id"), pa.array(exact)], ["query_id", "id", "similarity"])

    return pairs.select("query_id", "id", "asked", "vector").mapInArrow(cosines, schema)


def search(
    index: Served,
    queries: DataFrame,
    k: int,
    probes: int = 8,
    shortlist: int | None = None,
    without_self: bool = False,
    broadcast_bytes: int = BROADCAST_BYTES,
    block: int | None = None,
) -> DataFrame:
    """``(query_id, id, similarity, rank)``: the best ``k`` that the nearest ``probes`` cells hold.

    The codes choose ``shortlist`` rows a query, 20 times ``k`` by default; similarities are exact
    cosines, rounded to six digits. Only the probed cells are read. Queries without a vector, or
    with one of another length, find nothing. Up to ``broadcast_bytes`` of queries and shortlists go
    to every task; more than that meet the cells in blocks, each of which keeps shortlists of its own.
    """
    length = index.model.length
    queries = queries.filter(F.size("vector") == length).select("query_id", F.col("vector").alias("asked"))
    wanted = k + 1 if without_self else k
    shortlist = shortlist or 20 * wanted
    probes = min(probes, len(index.model.centres))
    n_queries = queries.count()
    if n_queries * (8 * length + SHORT_BYTES * shortlist) > broadcast_bytes:
        found = _probed_by_blocks(index, queries, n_queries, wanted, probes, shortlist, block or max(1, BLOCK_BYTES // (8 * length)))
        return _merged(found, k, without_self)
    about, cells = _probed_by_broadcast(index, queries, probes, shortlist)
    order = [F.desc("similarity"), F.asc("id")]
    short = materialized(top_per_key(about, ["query_id"], order, shortlist, salts=MERGE_SALTS, salt_on=("id",)), "shortlist")
    return _merged(_exactly(index, short, cells, queries), k, without_self)

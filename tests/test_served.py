"""The served vector index: searches, changes, versions, hot cells, odd rows."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from conftest import plan

from deskmill.operators import served, vectors
from deskmill.sources.snapshots import change_feed

LENGTH = 12


def clustered(n, seed=1, groups=12):
    rng = np.random.default_rng(seed)
    middles = rng.normal(size=(groups, LENGTH)) * 3
    return [(i, (middles[i % groups] + rng.normal(size=LENGTH)).round(4).tolist()) for i in range(n)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "id long, vector array<double>")


def asked(df):
    return df.withColumnRenamed("id", "query_id")


def plain(rows, queries, k, without_self=False):
    ids = np.array([i for i, _ in rows])
    matrix = np.array([v for _, v in rows])
    norms = np.sqrt((matrix * matrix).sum(1))
    out = set()
    for q, v in queries:
        scale = norms * np.sqrt(np.dot(v, v))
        cosine = np.round(np.divide(matrix @ np.array(v), scale, out=np.zeros(len(rows)), where=scale > 0), 6) + 0.0
        order = [j for j in np.lexsort((ids, -cosine)) if not (without_self and ids[j] == q)][:k]
        out |= {(q, int(ids[j]), float(cosine[j]), r) for r, j in enumerate(order, 1)}
    return out


def found(df):
    return {(r["query_id"], r["id"], r["similarity"], r["rank"]) for r in df.collect()}


@pytest.fixture(scope="module")
def rows():
    return clustered(900)


@pytest.fixture(scope="module")
def index(spark, rows, tmp_path_factory):
    return served.create(frame(spark, rows).repartition(5), str(tmp_path_factory.mktemp("served") / "index"))


@pytest.mark.parametrize("how", [{}, {"broadcast_bytes": 0, "block": 40}])
def test_probing_all_cells_is_exact(spark, index, rows, how):
    some = rows[::30]
    got = served.search(index, asked(frame(spark, some)), 5, probes=1000, **how)
    assert found(got) == plain(rows, some, 5)


def test_both_ways_of_meeting_agree(spark, index, rows):
    queries = asked(frame(spark, rows))
    small, large = (found(served.search(index, queries, 6, 3, without_self=True, **how)) for how in ({}, {"broadcast_bytes": 0, "block": 64}))
    assert small == large


def test_few_probes_find_most_where_vectors_cluster(spark, index, rows):
    queries = asked(frame(spark, rows))
    near = served.search(index, queries, 10, 4, without_self=True)
    got = vectors.recall(near, vectors.search(frame(spark, rows), queries, 10, without_self=True)).first()
    assert got["expected"] == 9000 and got["recall"] >= 0.9
    assert 4 < len(index.cells) / 4


def test_probes_for_a_recall_reach_it(spark, index, rows):
    held = frame(spark, rows)
    few, many = (served.probes_for(index, held, 10, recall) for recall in (0.5, 0.97))
    assert 1 <= few <= many <= len(index.model.centres)
    near = served.search(index, asked(held), 10, many, without_self=True)
    exact = vectors.search(held, asked(held), 10, without_self=True)
    assert vectors.recall(near, exact).first()["recall"] >= 0.95


def test_a_search_reads_only_the_cells_it_probes(spark, index, rows):
    query = asked(frame(spark, rows[:1]))
    about, cells = served._probed_by_broadcast(index, query.select("query_id", F.col("vector").alias("asked")), 2, 20)
    assert len(cells) == 2
    files = index.rows(cells).inputFiles()
    everything = index.rows().inputFiles()
    assert {f.split("cell=")[1].split("/")[0] for f in files} >= {str(c) for c in cells}
    text = plan(about)
    scan = text[text.index("PartitionFilters") :].split("\n")[0]
    assert all(str(c) in scan for c in cells) and "generation" in scan
    assert "ReadSchema: struct<id:bigint,codes:binary>" in text  # vectors are not read, nothing is shuffled
    assert "Exchange" not in text
    assert len(everything) >= len(index.cells)


def test_changes_give_the_index_of_the_later_state(spark, index, rows):
    rng = random.Random(2)
    before = frame(spark, rows)
    state = dict(rows)
    for i in range(0, 900, 7):
        del state[i]
    for i in range(1, 900, 50):
        if i in state:
            state[i] = [rng.gauss(0, 3) for _ in range(LENGTH)]
    state |= dict((i + 5000, v) for i, v in clustered(60, seed=9))
    after = sorted(state.items())
    feed = change_feed(before, frame(spark, after), "id")
    later = served.apply_changes(index, feed)
    assert later.version == 1 and sum(n for _, n in later.cells.values()) == len(after)
    again = served.apply_changes(later, feed)  # the same feed once more changes nothing
    some = after[::25]
    for held in (later, again, served.opened(spark, index.folder)):
        assert found(served.search(held, asked(frame(spark, some)), 4, 1000)) == plain(after, some, 4)
        assert {tuple(r) for r in held.rows().select("id").collect()} == {(i,) for i, _ in after}
    # The earlier version is as it was.
    old = served.opened(spark, index.folder, 0)
    assert found(served.search(old, asked(frame(spark, rows[::90])), 4, 1000)) == plain(rows, rows[::90], 4)


def test_a_change_writes_only_the_cells_it_touches(spark, index, rows):
    start = served.opened(spark, index.folder, 0)
    change = spark.createDataFrame([(3, "delete", None)], "id long, change_type string, vector array<double>")
    later = served.apply_changes(start, change)
    assert sum(generation == 1 for generation, _ in later.cells.values()) == 1
    assert sum(n for _, n in later.cells.values()) == 899
    nothing = served.apply_changes(later, change.limit(0))
    assert nothing.cells == later.cells


def test_copies_of_one_vector_are_cut_over_files(spark, tmp_path):
    rows = [(i, [1.0, 2.0, 3.0, 4.0]) for i in range(3000)] + [(i, np.random.default_rng(i).normal(size=4).tolist()) for i in range(3000, 4000)]
    held = served.create(frame(spark, rows), str(tmp_path / "copies"), file_rows=250)
    sizes = [r["count"] for r in held.rows().select("cell", F.input_file_name().alias("f")).groupBy("f").count().collect()]
    assert sum(sizes) == 4000 and max(sizes) <= 500
    got = served.search(held, asked(frame(spark, rows[5:6])), 3, broadcast_bytes=0, block=100)
    assert found(got) == {(5, i, 1.0, i + 1) for i in range(3)}


def test_odd_rows_are_left_out_and_counted(spark, tmp_path):
    rows = clustered(60)
    odd = [(None, rows[0][1]), (100, None), (101, [1.0]), (102, []), (103, [0.0] * LENGTH)]
    held = served.create(frame(spark, rows + odd), str(tmp_path / "odd"))
    assert tuple(served.odd_rows(held, frame(spark, rows + odd)).first()) == (65, 2, 2)
    queries = asked(frame(spark, [(1, rows[1][1]), (2, None), (3, [1.0]), (4, [0.0] * LENGTH)]))
    got = found(served.search(held, queries, 2, 1000))
    good = rows + [(103, [0.0] * LENGTH)]
    assert got == plain(good, [(1, rows[1][1]), (4, [0.0] * LENGTH)], 2)


def test_an_exact_search_leaves_out_other_lengths(spark):
    rows = clustered(30)
    odd = frame(spark, rows + [(100, [1.0]), (101, None), (102, [])])
    assert found(vectors.search(odd, asked(odd), 3)) == plain(rows, rows, 3)


def test_one_vector_and_none(spark, tmp_path):
    held = served.create(frame(spark, [(7, [3.0, 4.0])]), str(tmp_path / "one"))
    assert found(served.search(held, asked(frame(spark, [(1, [4.0, 3.0])])), 5)) == {(1, 7, 0.96, 1)}
    assert served.search(held, asked(frame(spark, [])), 5).collect() == []
    with pytest.raises(ValueError, match="none"):
        served.create(frame(spark, []), str(tmp_path / "none"))
    gone = spark.createDataFrame([(7, "delete", None)], "id long, change_type string, vector array<double>")
    empty = served.apply_changes(held, gone)
    assert empty.cells == {} and served.search(empty, asked(frame(spark, [(1, [4.0, 3.0])])), 5).collect() == []


@pytest.mark.parametrize("probes", [3, 1000])
def test_many_queries_miss_no_row_of_the_probed_cells(spark, tmp_path, probes):
    rng = np.random.default_rng(8)
    rows = [(i, rng.normal(size=32).tolist()) for i in range(1, 1201)]
    held = served.create(frame(spark, rows), str(tmp_path / "loose"), cells=12)
    units = served._unit_rows(np.array([v for _, v in rows]))
    near = served._cells_of(units, held.model.centres, min(probes, 12))
    cosine = np.round(units @ units.T, 6)
    np.fill_diagonal(cosine, -9)
    cosine[~(near[:, :, None] == near[:, 0]).any(1)] = -9
    ids = np.arange(1, 1201)
    best = [np.lexsort((ids, -c))[:5] for c in cosine]
    # A shortlist of 6 of 1,200 rows that do not cluster: the codes alone miss many.
    got = served.search(held, asked(frame(spark, rows)), 5, probes, shortlist=6, without_self=True, broadcast_bytes=0, block=500)
    assert {(r.query_id, r.id, r.rank) for r in got.collect()} == {(i + 1, ids[j], n) for i, b in enumerate(best) for n, j in enumerate(b, 1)}


def test_a_hot_cell_is_cut_into_groups():
    first, pieces, n = served._groups({0: 30, 1: 30, 3: 250, 4: 90, 5: 20}, 7, 100)
    assert first.tolist() == [0, 0, -1, 1, 4, 5, -1] and pieces.tolist() == [1, 1, 1, 3, 1, 1, 1] and n == 6


def test_ranking_waits_for_more_than_one_cell(monkeypatch):
    rng = np.random.default_rng(2)
    model = served.Model(rng.normal(size=(40, 4)), rng.normal(size=(2, 256, 2)))
    calls, ranked = [], served._ranked
    monkeypatch.setattr(served, "_ranked", lambda table, k: calls.append(table.num_rows) or ranked(table, k))
    best = served._Best(served._unit_rows(rng.normal(size=(50, 4))), model, 5)
    for cell in range(40):
        codes = [bytes(rng.integers(0, 256, 2, np.uint8)) for _ in range(20)]
        best.add(cell, np.arange(50), pa.table({"id": [cell * 20 + i for i in range(20)], "codes": pa.array(codes, pa.binary())}))
    best.settle()
    assert len(calls) == 1 and best.table.num_rows == 250

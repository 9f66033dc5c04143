import os
import time

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from deskmill.operators import vectors
from deskmill.streaming import chunk_fold, index_refresh


def land(df, folder, name):
    """One more parquet file in a folder."""
    df.coalesce(1).write.parquet(f"{folder}/_{name}")
    [part] = [f for f in os.listdir(f"{folder}/_{name}") if f.endswith(".parquet")]
    os.link(f"{folder}/_{name}/{part}", f"{folder}/{name}.parquet")


def refresh(spark, inbox, target, checkpoint, schema):
    stream = index_refresh.read_stream(spark, inbox, schema, "*.parquet", 1)
    index_refresh.refresh_index(stream, ["id"], "text", target, checkpoint).awaitTermination()
    return index_refresh.current_index(spark, target, ["id"])


def test_two_runs_equal_one_batch(spark, folder):
    inbox, target, checkpoint = (f"{folder}/{n}" for n in ("in", "index", "checkpoint"))
    os.mkdir(inbox)
    first = spark.createDataFrame([(1, "a b"), (2, "c")], "id long, text string")
    second = spark.createDataFrame([(2, "c d"), (3, "e")], "id long, text string")
    land(first, inbox, "one")
    refresh(spark, inbox, target, checkpoint, first.schema)
    time.sleep(0.01)
    land(second, inbox, "two")
    index = refresh(spark, inbox, target, checkpoint, first.schema)
    final = spark.createDataFrame([(1, "a b"), (2, "c d"), (3, "e")], "id long, text string")
    want = rows(vectors.build_index(final, ["id"], "text"))
    assert rows(index) == want
    again = refresh(spark, inbox, target, checkpoint, first.schema)  # nothing is new
    assert rows(again) == want
    index_refresh.compact(spark, target, ["id"], f"{folder}/compact")
    assert rows(index_refresh.current_index(spark, f"{folder}/compact", ["id"])) == want


def test_continuous_refresh_takes_files_as_they_come(spark, folder):
    inbox, target, checkpoint = (f"{folder}/{n}" for n in ("in", "index", "checkpoint"))
    os.mkdir(inbox)
    schema = "conv_id long, turn long, text string"
    land(spark.createDataFrame([(1, 0, "a")], schema), inbox, "one")
    stream = index_refresh.read_stream(spark, inbox, spark.createDataFrame([], schema).schema, "*.parquet")
    refresh = index_refresh.refresh_index(stream, ["conv_id", "turn"], "text", target, checkpoint, every="100 milliseconds")
    try:
        refresh.processAllAvailable()
        land(spark.createDataFrame([(1, 1, "b"), (1, 0, "c")], schema), inbox, "two")
        refresh.processAllAvailable()
    finally:
        refresh.stop()
    index = index_refresh.current_index(spark, target, ["conv_id", "turn"])
    final = spark.createDataFrame([(1, 0, "c"), (1, 1, "b")], schema)
    assert rows(index) == rows(vectors.build_index(final, ["conv_id", "turn"], "text"))


def test_replayed_batch_adds_nothing(spark, folder):
    """A batch written before its commit was lost is written again, over itself."""
    inbox, target, checkpoint = (f"{folder}/{n}" for n in ("in", "index", "checkpoint"))
    os.mkdir(inbox)
    data = spark.createDataFrame([(1, "a b"), (2, "c")], "id long, text string")
    land(data, inbox, "one")
    first = rows(refresh(spark, inbox, target, checkpoint, data.schema))
    again = refresh(spark, inbox, target, f"{folder}/fresh", data.schema)
    assert rows(again) == first
    assert spark.read.parquet(target).count() == 2


def batches_of(spark, folder, batches):
    """Write each batch as a refresh does; a text of None is a tombstone."""
    for n, batch in enumerate(batches):
        rows_ = spark.createDataFrame(batch, "id long, text string").withColumn("version", F.lit(n).cast("timestamp"))
        vectors.build_index(rows_, ["id", "version"], "text").write.mode("overwrite").parquet(f"{folder}/batch_id={n}")


def states(batches):
    """The texts after each batch."""
    state, out = {}, []
    for batch in batches:
        state = {k: v for k, v in (state | dict(batch)).items() if v is not None}
        out.append(sorted(state.items()))
    return out


BATCHES = [[(1, "a"), (2, "b")], [(2, None), (3, "c")], [(1, "a a")], [(2, "d"), (3, None)], [(4, "e")], [(1, None)], [(5, "f"), (4, "g")]]


def index_of(spark, texts):
    return rows(vectors.build_index(spark.createDataFrame(texts, "id long, text string"), ["id"], "text"))


def test_index_as_of_each_batch(spark, folder):
    batches_of(spark, folder, BATCHES)
    for n, state in enumerate(states(BATCHES)):
        assert rows(index_refresh.current_index(spark, folder, ["id"], as_of=n)) == index_of(spark, state)
    with pytest.raises(ValueError, match="no batch"):
        index_refresh.current_index(spark, folder, ["id"], as_of=-1)


def test_merged_runs_give_the_same_index(spark, folder):
    batches_of(spark, folder, BATCHES)
    want = [index_of(spark, state) for state in states(BATCHES)]
    assert index_refresh.merge_runs(spark, folder, ["id"], fanout=2) > 2
    held, left = index_refresh.runs(spark, folder)
    assert (held, left) == ([(0, 3), (4, 5)], [6])
    assert rows(index_refresh.current_index(spark, folder, ["id"])) == want[-1]
    for n in (3, 5):
        assert rows(index_refresh.current_index(spark, folder, ["id"], as_of=n)) == want[n]
    with pytest.raises(ValueError, match="merged into the run of batches 0 to 3"):
        index_refresh.current_index(spark, folder, ["id"], as_of=2)
    # A tombstone stays in a run that has older ones, and goes from the oldest.
    assert spark.read.parquet(f"{folder}/merged/run=4_5").filter("content_hash IS NULL").count() == 1
    assert spark.read.parquet(f"{folder}/merged/run=0_3").filter("content_hash IS NULL").count() == 0
    assert index_refresh.merge_runs(spark, folder, ["id"], fanout=2) == 0
    index_refresh.compact(spark, folder, ["id"], f"{folder}/compact")
    assert rows(index_refresh.current_index(spark, f"{folder}/compact", ["id"])) == want[-1]


def test_a_merge_that_broke_off_is_done_again(spark, folder):
    batches_of(spark, folder, BATCHES)
    index_refresh.merge_runs(spark, folder, ["id"], fanout=7)
    os.unlink(f"{folder}/runs/step=0/_SUCCESS")  # the run was written, but not noted
    assert index_refresh.runs(spark, folder) == ([], list(range(7)))
    assert index_refresh.merge_runs(spark, folder, ["id"], fanout=7) == 1
    assert index_refresh.runs(spark, folder) == ([(0, 6)], [])
    assert rows(index_refresh.current_index(spark, folder, ["id"])) == index_of(spark, states(BATCHES)[-1])


def test_rows_of_a_change_feed(spark):
    feed = spark.createDataFrame([(1, "insert", "a"), (2, "update_preimage", "b"), (2, "update_postimage", "c"), (3, "delete", "d")], "id long, change_type string, text string")
    assert rows(index_refresh.changes_to_rows(feed, "text")) == [(1, "a"), (2, "c"), (3, None)]


PIECES = "conv_id long, turn long, seq long, piece string, is_last boolean"


@pytest.mark.parametrize("order", [[0, 1, 2, 3], [3, 2, 1, 0], [2, 0, 3, 1]])
def test_pieces_in_any_order_over_runs(spark, folder, order):
    inbox, target, checkpoint = (f"{folder}/{n}" for n in ("in", "out", "checkpoint"))
    os.mkdir(inbox)
    pieces = [(1, 0, i, f"<{i}>", i == 3) for i in range(4)]
    for run, i in enumerate(order):
        extra = [(2, 0, 0, "whole", True)] if run == 0 else [(3, 0, run, "unfinished", False)]
        land(spark.createDataFrame([pieces[i], *extra], PIECES), inbox, f"f{run}")
        stream = spark.readStream.schema(PIECES).option("pathGlobFilter", "*.parquet").parquet(inbox)
        chunk_fold.run_fold(stream, target, checkpoint).awaitTermination()
        done = rows(chunk_fold.folded(spark, target))
        whole = [(1, 0, "<0><1><2><3>")] if run == 3 else []
        assert done == [*whole, (2, 0, "whole")]


def test_one_file_with_a_long_message(spark, folder):
    n = 30_000
    df = spark.range(n).select(
        F.lit(1).cast("long").alias("conv_id"), F.lit(0).cast("long").alias("turn"), F.col("id").alias("seq"),
        F.concat("id", F.lit(";")).alias("piece"), (F.col("id") == n - 1).alias("is_last"),
    )
    os.mkdir(f"{folder}/in")
    land(df.orderBy(F.hash("seq")), f"{folder}/in", "all")
    stream = spark.readStream.schema(df.schema).option("pathGlobFilter", "*.parquet").parquet(f"{folder}/in")
    chunk_fold.run_fold(stream, f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
    [row] = chunk_fold.folded(spark, f"{folder}/out").collect()
    assert row.text == "".join(f"{i};" for i in range(n))


def test_repeated_pieces_change_nothing(spark, folder):
    inbox, target, checkpoint = (f"{folder}/{n}" for n in ("in", "out", "checkpoint"))
    os.mkdir(inbox)
    first, last = (1, 0, 0, "a", False), (1, 0, 1, "b", True)
    for run, found in enumerate([[first, first], [first, last], [last], [first, last]]):
        land(spark.createDataFrame(found, PIECES), inbox, f"f{run}")
        stream = spark.readStream.schema(PIECES).option("pathGlobFilter", "*.parquet").parquet(inbox)
        chunk_fold.run_fold(stream, target, checkpoint).awaitTermination()
    assert rows(chunk_fold.folded(spark, target)) == [(1, 0, "ab")]


def fold_all(spark, batches, target, patience=chunk_fold.PATIENCE):
    for n, batch in enumerate(batches):
        chunk_fold.fold_batch(spark.createDataFrame(batch, PIECES), n, target, patience)


def test_state_holds_only_what_may_still_be_completed(spark, folder):
    fold_all(spark, [[(1, 0, 0, "a", False), (2, 0, 0, "x", True)], [(1, 0, 1, "b", False), (3, 0, 1, "z", True)], [(1, 0, 2, None, True)]], folder)
    assert rows(chunk_fold.waiting(spark, folder)) == [(3, 0, 1, "z", True, 1)]
    assert rows(chunk_fold.folded(spark, folder)) == [(1, 0, "ab"), (2, 0, "x")]
    assert not os.path.exists(f"{folder}/batch_id=0/kind=open") and os.path.exists(f"{folder}/batch_id=1/kind=open")


def test_a_message_is_given_up_after_batches_without_a_piece(spark, folder):
    quiet = [(9, 9, 0, "other", True)]
    batches = [[(1, 0, 0, "a", False), (2, 0, 0, "b", False)], quiet, [(2, 0, 1, "c", False)], quiet, [(1, 0, 1, "late", True)], [(2, 0, 2, "d", True)]]
    fold_all(spark, batches, folder, patience=3)
    assert rows(chunk_fold.given_up(spark, folder)) == [(1, 0, 1, 3)]
    assert rows(chunk_fold.folded(spark, folder))[:1] == [(2, 0, "bcd")]
    assert rows(chunk_fold.waiting(spark, folder)) == [(1, 0, 1, "late", True, 4)]


def test_a_replayed_batch_gives_the_same_state(spark, folder):
    batches = [[(1, 0, 0, "a", False), (2, 0, 1, "y", True)], [(1, 0, 1, "b", True), (3, 0, 0, "q", False)], [(2, 0, 0, "x", False)]]
    for n, batch in enumerate(batches):
        chunk_fold.fold_batch(spark.createDataFrame(batch, PIECES), n, folder)
        once = rows(spark.read.parquet(f"{folder}/batch_id={n}"))
        # The work of the batch was done, but not noted.
        chunk_fold.fold_batch(spark.createDataFrame(batch, PIECES), n, folder)
        assert rows(spark.read.parquet(f"{folder}/batch_id={n}")) == once
    assert rows(chunk_fold.folded(spark, folder)) == [(1, 0, "ab"), (2, 0, "xy")]


def test_odd_pieces(spark, folder):
    odd = [(None, 0, 0, "x", True), (1, None, 0, "x", True), (1, 0, None, "x", True), (1, 0, 0, "b", None), (1, 0, 0, "a", False), (1, 0, -1, "n", False), (1, 0, 2, "d", True), (1, 0, 1, "c", False)]
    fold_all(spark, [odd, []], folder)
    assert rows(chunk_fold.folded(spark, folder)) == [(1, 0, "acd")]
    assert rows(chunk_fold.waiting(spark, folder)) == []


def test_folding_stays_in_the_jvm(spark, folder):
    fold_all(spark, [[(1, 0, 0, "a", False)]], folder)
    plans = []
    batch = spark.sql("SELECT 1L AS conv_id, 0L AS turn, 1L AS seq, 'b' AS piece, true AS is_last").repartition(2)
    write, writer = type(batch.write).parquet, type(batch.write)
    try:
        writer.parquet = lambda self, path, **how: plans.append(plan(self._df)) or write(self, path, **how)
        chunk_fold.fold_batch(batch, 1, folder)
    finally:
        writer.parquet = write
    assert len(plans) == 1 and "Python" not in plans[0] and "InPandas" not in plans[0]


def test_refresh_after_compaction_keeps_the_index_and_takes_keys_out(spark, folder):
    data = spark.createDataFrame([(1, "a b"), (2, "c"), (3, "d")], "id long, text string")
    later = spark.createDataFrame([(4, "e"), (2, None)], "id long, text string")
    for name, rows_ in (("in", data), ("later", later)):
        os.mkdir(f"{folder}/{name}")
        land(rows_, f"{folder}/{name}", "one")
    refresh(spark, f"{folder}/in", f"{folder}/index", f"{folder}/c1", data.schema)
    index_refresh.compact(spark, f"{folder}/index", ["id"], f"{folder}/compact")
    index = refresh(spark, f"{folder}/later", f"{folder}/compact", f"{folder}/c2", data.schema)
    final = spark.createDataFrame([(1, "a b"), (3, "d"), (4, "e")], "id long, text string")
    assert rows(index) == rows(vectors.build_index(final, ["id"], "text"))


def test_more_splits_are_dealt_into_more_files(spark, monkeypatch):
    from deskmill.plans import documents

    made, scratch = [], documents.scratch
    monkeypatch.setattr(documents, "scratch", lambda spark, name: made.append(scratch(spark, name)) or made[-1])
    key = "spark.sql.files.maxPartitionBytes"
    want = sorted(map(tuple, documents.stream_triggered_index(spark, "/root/testdata/sf0.001").collect()))
    few = made[0]
    before = spark.conf.get(key)
    spark.conf.set(key, str(16 << 10))
    try:
        splits = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").rdd.getNumPartitions()
        made.clear()
        got = documents.stream_triggered_index(spark, "/root/testdata/sf0.001").collect()
    finally:
        spark.conf.set(key, before)
    assert sorted(map(tuple, got)) == want
    files = [len(spark.read.parquet(inbox).inputFiles()) for inbox in (few, made[0])]
    assert files[0] <= 6 and splits > 4 and files[1] > 2 * splits

"""What must hold whatever the data's size: no pairwise plans, no hot tasks, whole results."""

import re
from datetime import date
from pathlib import Path

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

import __spark_entry__ as contract
from deskmill import session
from deskmill.operators import containment, evaluation, lookups, messages, metadata, tools, vectors
from deskmill.session import scratch_root

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_no_pairwise_join_and_no_python_row_functions(spark, name):
    text = plan(contract.queries()[name](spark, SF_DIR))
    assert not re.search("NestedLoop|Cartesian|BatchEvalPython|PythonUDTF", text)


@pytest.fixture()
def without_broadcast(spark):
    """Joins as they are once no side is small."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield spark
    spark.conf.set(key, before)


BIG_JOINS = (
    "change_feed dispatch_tools find_by_name groundedness incremental_sync prefix_overwrite "
    "prepend_system retrieval_hit_rate score_relevance search_docs_top1 tvf_call"
).split()


@pytest.mark.parametrize("name", BIG_JOINS)
def test_same_rows_when_every_join_shuffles(without_broadcast, name):
    job = contract.queries()[name]
    df = job(without_broadcast, SF_DIR)
    assert "BroadcastHashJoin" not in plan(df)
    shuffled = df.collect()
    without_broadcast.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")
    broadcast = job(without_broadcast, SF_DIR).collect()
    assert sorted(map(str, shuffled)) == sorted(map(str, broadcast))


@pytest.mark.parametrize(
    ("name", "pushed"),
    [
        ("not_null_names", "IsNotNull(p_name)"),
        ("order_history_as_written", "IsNotNull(user_id)"),
        ("latest_interaction", None),
    ],
)
def test_filters_and_columns_reach_the_scan(spark, name, pushed):
    text = plan(contract.queries()[name](spark, SF_DIR))
    if pushed:
        assert pushed in re.search(r"PushedFilters: .*", text).group(0)
    schemas = re.findall(r"ReadSchema: (.*)", text)
    assert schemas and all("value" not in s for s in schemas)


def test_top_one_is_no_full_sort(spark):
    assert "TakeOrderedAndProject" in plan(contract.queries()["latest_interaction"](spark, SF_DIR))


def test_cap_drops_rows_before_the_shuffle(spark):
    text = plan(contract.queries()["cap_turns"](spark, SF_DIR))
    assert "WindowGroupLimit" in text.split("Exchange")[-1] or text.count("WindowGroupLimit") >= 2


def test_index_build_moves_no_data(spark):
    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    assert "Exchange" not in plan(vectors.build_index(documents, ["doc_id"], "text"))


def test_scratch_follows_the_session(spark):
    root = spark.conf.get(session.SCRATCH_KEY)
    assert session.scratch(spark, "x").startswith(f"{root}/x-")


def test_scratch_without_a_shared_folder():
    class Conf:
        def get(self, key, default):
            return default

    class Session:
        conf = Conf()

        def __init__(self, master):
            self.sparkContext = type("Context", (), {"master": master})

    local = Session("local[2]")
    assert session.scratch_root(local) == session.scratch_root(local)
    with pytest.raises(ValueError, match=session.SCRATCH_KEY):
        session.scratch_root(Session("yarn"))


N = 20_000


def hot(spark, others=1000):
    """Key 0 holds a third of all rows."""
    return spark.range(N).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % others + 1).alias("k"), "id"
    )


def test_hot_customer(spark):
    df = hot(spark).select(
        F.timestamp_seconds("id").cast("timestamp_ntz").alias("date_time"),
        F.concat(F.lit("c"), F.col("id") % 5).alias("issue_category"),
        F.lit("d").alias("issue_description"),
        F.lit("n").alias("name"),
        F.col("k").cast("string").alias("email"),
        F.col("id").alias("row_id"),
    )
    history = lookups.order_history_by_key(df, date(2025, 1, 1))
    assert history.agg(F.sum("returns_last_12_months")).first()[0] == N
    assert lookups.latest_per_key(df).count() == df.select("email").distinct().count()
    calls = df.select(
        F.col("row_id").alias("call_id"),
        F.lit("history").alias("tool"),
        F.to_json(F.struct("email")).alias("arguments"),
    )
    answers = tools.dispatch(calls, {"history": ("email", tools.history_results(history))})
    assert answers.count() == N and answers.filter("status <> 'ok' OR result = '[]'").count() == 0


def test_hot_conversation(spark):
    df = hot(spark).select(F.col("k").alias("conv_id"), F.col("id").alias("turn"))
    turns = df.select("conv_id", "turn", F.when(F.col("turn") % 2 == 0, "user").otherwise("assistant").alias("role"), F.lit("t").alias("text"))
    rows_ = turns.select("conv_id", "turn", F.lit(0).alias("part"), "role", F.col("text").alias("content"))
    got = messages.prepend_system(rows_, "p")
    per_key = got.groupBy("conv_id").agg(F.count("*").alias("n"), F.max("position").alias("last"), F.countDistinct("position").alias("d"))
    assert per_key.filter("n <> last + 1 OR n <> d").count() == 0
    assert got.count() == N + df.select("conv_id").distinct().count()
    capped = messages.cap_turns(turns, 10)
    assert capped.filter("conv_id = 0").count() == 11
    paired = evaluation.answered_turns(turns.withColumn("text", F.col("turn").cast("string"))).filter("conv_id = 0")
    assert paired.filter("turn % 2 <> 0 OR int(answer) % 2 <> 1 OR int(answer) <= turn").count() == 0


def test_hot_owner_of_settings(spark):
    df = hot(spark).select(
        F.col("k").alias("owner"),
        F.col("id").alias("seq"),
        F.concat(F.lit("a.b"), F.col("id") % 7, F.when(F.col("id") % 2 == 0, ".c").otherwise("")).alias("key"),
        F.col("id").cast("string").alias("value"),
    )
    assert metadata.settings_map(df).count() == df.select("owner").distinct().count()
    left = metadata.apply_assignments(df)
    assert left.groupBy("owner", "key").count().filter("count > 1").count() == 0


def test_one_ancestor_of_very_many_keys(spark):
    n = 20_000
    keys = [("big", 2 * i, f"a.k{i:05}.x{i % 3}", "v") for i in range(n)] + [("big", n + 1, "a", "top"), ("big", 5 * n, "a.k00007", "own"), (None, 1, "a", "z"), (None, 0, "a.b", "z"), ("big", 3, None, "n")]
    df = spark.createDataFrame(keys, "owner string, seq long, key string, value string")
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        left = metadata.apply_assignments(df)
        got = {(r.owner, r.key) for r in left.collect()}
    finally:
        spark.conf.set(name, before)
    late = {("big", f"a.k{i:05}.x{i % 3}") for i in range(n) if 2 * i > n + 1 and i != 7}
    assert got == late | {("big", "a"), ("big", "a.k00007"), (None, "a"), (None, "a.b"), ("big", None)}
    # No block of keys holds much more than its share.
    swept = sorted(Path(scratch_root(spark)).glob("swept-*"), key=lambda p: p.stat().st_mtime)[-1]
    sizes = [r["count"] for r in spark.read.parquet(str(swept)).groupBy("block").count().collect()]
    assert len(sizes) > 4 and max(sizes) < 3 * sum(sizes) / len(sizes)


def test_a_hot_key_of_a_tool(spark):
    calls = spark.range(3000).selectExpr("id AS call_id", "'t__f' AS tool", "CASE WHEN id % 3 = 0 THEN '{\"k\": \"hot\"}' ELSE concat('{\"k\": \"c', id, '\"}') END AS arguments")
    results = spark.createDataFrame([("hot", "[1]"), ("c1", "[2]"), ("unasked", "[3]")], "key string, result string")
    got = tools.dispatch(calls, {"t.f": ("k", results)}, hot_rows=100)
    assert rows(got.groupBy("status", "result").count()) == [("ok", "[1]", 1000), ("ok", "[2]", 1), ("ok", "[]", 1999)]


def test_a_third_of_the_documents_hold_the_passage(spark):
    passage = "alpha beta gamma delta epsilon zeta eta theta"
    docs = spark.range(3000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 == 0, F.concat(F.lit(f"x {passage} y "), F.col("id"))).otherwise(F.concat(F.lit("other words here "), F.col("id"))).alias("text"),
    )
    items = spark.createDataFrame([(1, passage), (2, "never seen words in any of these texts")], "item_id int, text string")
    assert rows(containment.groundedness(items, docs)) == [(1, 1000, True), (2, 0, False)]

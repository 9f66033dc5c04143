import json

from conftest import rows
from pyspark.sql import functions as F

from deskmill.operators import evaluation, messages, tools

CHUNK = "conv_id long, turn long, seq long, chunk_id string, content string, tool_calls array<struct<id: string, name: string, arguments: string>>"


def normal(spark, *found):
    df = spark.createDataFrame([(1, i, json.dumps(m)) for i, m in enumerate(found)], "conv_id long, turn long, message string")
    return messages.normalize_messages(df)


def test_every_kind_of_message(spark):
    got = normal(
        spark,
        {"type": "function_call", "call_id": "c1", "name": "f", "arguments": '{"a":1}'},
        {"type": "message", "role": "user", "content": [{"text": "p1"}, {"text": "p2"}]},
        {"type": "message", "role": "user", "content": []},
        {"type": "reasoning", "summary": [{"text": "why"}]},
        {"type": "function_call_output", "call_id": "c1", "output": "42"},
        {"type": "message", "role": "user", "content": "plain", "extra": 1},
        {"role": "assistant", "content": "", "tool_calls": [{"id": "c2"}]},
        {"role": "assistant", "content": None, "tool_calls": []},
        {"status": "nothing kept"},
        {"role": "user", "content": "[1, 2]", "name": "ann"},
    )
    rows_ = {(r.turn, r.part): r for r in got.collect()}
    assert set(rows_) == {(0, 0), (1, 0), (1, 1), (3, 0), (4, 0), (5, 0), (6, 0), (7, 0), (9, 0)}
    first = rows_[0, 0]
    assert (first.role, first.content) == ("assistant", "tool call")
    assert json.loads(first.tool_calls) == [{"id": "c1", "type": "function", "function": {"arguments": '{"a":1}', "name": "f"}}]
    assert [rows_[1, i].content for i in (0, 1)] == ["p1", "p2"]
    assert rows_[3, 0].role == "assistant" and json.loads(rows_[3, 0].content) == [{"text": "why"}]
    assert (rows_[4, 0].role, rows_[4, 0].content, rows_[4, 0].tool_call_id) == ("tool", "42", "c1")
    assert rows_[5, 0].content == "plain"
    assert rows_[6, 0].content == "tool call" and json.loads(rows_[6, 0].tool_calls) == [{"id": "c2"}]
    assert rows_[7, 0].content is None
    assert (rows_[9, 0].content, rows_[9, 0].name) == ("[1, 2]", "ann")


def test_system_prompt_and_pending_step(spark):
    got = normal(spark, {"status": "dropped"}, {"role": "user", "content": "q"}, {"role": "assistant", "content": "a"})
    assert rows(messages.prepend_system(got, "be kind")) == [(1, 0, "system", "be kind"), (1, 1, "user", "q"), (1, 2, "assistant", "a")]
    assert rows(messages.prepend_system(got, "")) == [(1, 0, "user", "q"), (1, 1, "assistant", "a")]
    assert messages.pending_step(got).first().step == "done"
    assert messages.pending_step(normal(spark, {"role": "user", "content": "q"})).first().step == "llm"
    calling = normal(spark, {"role": "assistant", "content": "", "tool_calls": [{"id": "c"}]})
    assert messages.pending_step(calling).first().step == "tool"
    quiet = normal(spark, {"role": "assistant", "content": "x", "tool_calls": []})
    assert messages.pending_step(quiet).first().step == "done"


def test_folding_with_two_tools_and_any_block_size(spark):
    two = [("c1", "f", '{"a"'), ("c2", "g", "{}")]
    responses = [
        [("m0", "Hel", None), ("m1", "lo", []), ("m2", None, None), ("m3", "lost", two), ("m4", None, [(None, None, ":1}")]), ("m5", "!", None)],
        [("m0", "", None)],
        [("m0", None, [("c", "f", "x")]), ("m1", None, [(None, None, "y"), (None, None, "z")])],
        [("m0", "only text", None)],
    ]
    data = [(1, t, s, *chunk) for t, found in enumerate(responses) for s, chunk in enumerate(found)]
    want = [
        (1, 0, 0, "message", "m5", None, "Hello!"),
        (1, 0, 1, "function_call", "c1", "f", '{"a":1}'),
        (1, 0, 2, "function_call", "c2", "g", "{}"),
        (1, 2, 0, "function_call", "c", "f", "xy"),
        (1, 3, 0, "message", "m0", None, "only text"),
    ]
    for block in (1, 2, 4096):
        df = spark.createDataFrame(data, CHUNK).repartition(7)
        assert rows(messages.fold_chunks(df, block)) == sorted(want, key=lambda r: [(v is not None, v) for v in r])


def test_deltas_of_one_hot_message(spark):
    df = spark.range(5000).selectExpr("1 AS conv_id", "0 AS turn", "id AS seq", "concat(id, ',') AS text").repartition(8)
    [row] = messages.fold_deltas(df, ["conv_id", "turn"], "seq", "text", block=64).collect()
    assert row.text == "".join(f"{i}," for i in range(5000))


def test_cap_reached_on_the_last_step_still_stops(spark):
    data = [(c, t, "user", f"{c}-{t}") for c, n in ((1, 2), (2, 3), (3, 5)) for t in range(n)]
    df = spark.createDataFrame(data, "conv_id long, turn long, role string, text string")
    got = messages.cap_turns(df, 3)
    stops = rows(got.filter(F.col("text") == messages.STOP_TEXT).select("conv_id", "step"))
    assert stops == [(2, 4), (3, 4)]
    assert rows(got.groupBy("conv_id").count()) == [(1, 2), (2, 4), (3, 4)]


def test_final_outputs(spark):
    data = [(1, 0, 0, messages.TEXT_DELTA, "m", "a", "s"), (1, 0, 1, messages.ITEM_DONE, "m", "ab", "s")]
    df = spark.createDataFrame(data, "conv_id int, turn int, seq int, type string, item_id string, payload string, custom string")
    assert rows(messages.final_outputs(df)) == [(1, 0, 1, "m", "ab", "s")]


def test_dispatch(spark):
    calls = spark.createDataFrame(
        [
            (1, "support__history", '{"email": "a"}'),
            (2, "support__history", '{"email": "zz"}'),
            (3, "support__history", "{broken"),
            (4, "support__history", '{"other": 1}'),
            (5, "support__weather", "{}"),
            (6, "support__policy", '{"policy_name": "P"}'),
            (7, "support__policy", '{"policy_name": 5}'),
        ],
        "call_id int, tool string, arguments string",
    )
    history = spark.createDataFrame([("a", "[1]")], "key string, result string")
    policies = spark.createDataFrame([("P", "[2]"), ("5", "[3]")], "key string, result string")
    got = tools.dispatch(calls, {"support.history": ("email", history), "support.policy": ("policy_name", policies)})
    assert rows(got.drop("function_name")) == [
        (1, "ok", "[1]"),
        (2, "ok", "[]"),
        (3, "error", "arguments are not JSON"),
        (4, "error", "missing argument email"),
        (5, "error", "unknown tool support__weather"),
        (6, "ok", "[2]"),
        (7, "ok", "[3]"),
    ]
    assert {r.function_name for r in got.collect()} == {"support.history", "support.policy", "support.weather"}


def test_routing(spark):
    df = spark.createDataFrame([("What is my total bill?",), ("My device has no network",), ("Hello",), ("bill for product",)], "q string")
    assert [r[0] for r in df.select(tools.route(F.col("q"))).collect()] == ["structured", "documents", "documents", "documents"]


def test_scores(spark):
    df = spark.createDataFrame([("red red fox?", "The fox."), ("", "x"), ("a b", "")], "q string, a string")
    assert [r[0] for r in df.select(evaluation.relevance(F.col("q"), F.col("a"))).collect()] == [0.5, 0.0, 0.0]
    texts = spark.createDataFrame([("One. Two!",), ("One. Two! Three?",), ("...",), ("what a clown",), ("clowns",)], "t string")
    assert [r[0] for r in texts.select(evaluation.style_ok(F.col("t"))).collect()] == [True, False, True, True, True]
    assert [r[0] for r in texts.select(evaluation.is_flagged(F.col("t"))).collect()] == [False, False, False, True, False]


def test_totals_in_answers(spark):
    counts = {"Parcels": 400, "Opening hours": 350, "Invoices": 271, "Repairs": 4}
    history = spark.createDataFrame([("n@x", c, n) for c, n in counts.items()], "email string, issue_category string, returns_last_12_months int")
    [row] = evaluation.expected_total_check(evaluation.history_answers(history)).collect()
    assert (row.added, row.stated, row.consistent) == (1025, 1025, True)
    assert "total of 1,025 contacts" in row.answer
    wrong = spark.createDataFrame([("e", "1,000 returns related to A\n2 returns related to B\nThis shows a total of 1,003 returns"), ("f", "no numbers")], "email string, answer string")
    got = {r.email: (r.added, r.stated, r.consistent) for r in evaluation.expected_total_check(wrong).collect()}
    assert got["e"] == (1002, 1003, False) and got["f"][2] is False


def test_one_broken_message_gives_an_error_row(spark):
    df = spark.createDataFrame([(1, 0, "{broken"), (1, 1, '{"role": "user", "content": "q"}'), (1, 2, None)], "conv_id long, turn long, message string")
    got = messages.normalize_messages(df).select("turn", "role", "content")
    assert rows(got) == [(0, "error", "message is not JSON"), (1, "user", "q")]


def test_rows_without_ids_are_numbered_too(spark):
    data = [(1, 0, 0, "user", "a"), (None, 0, 0, "user", "b"), (None, None, 0, "user", "c"), (1, None, 0, "user", "d")]
    df = spark.createDataFrame(data, "conv_id long, turn long, part int, role string, content string")
    got = messages.prepend_system(df, "")
    assert rows(got.select("conv_id", "position", "content")) == [(None, 0, "c"), (None, 1, "b"), (1, 0, "d"), (1, 1, "a")]


def test_the_next_turn_is_the_next_there_is(spark):
    data = [(1, 0, "user", "q0"), (1, 2, "assistant", "a2"), (1, 5, "user", "q5"), (1, 9000, "assistant", "a9000"), (1, 9001, "user", "last"), (None, 1, "user", "n"), (None, 7, "assistant", "m")]
    df = spark.createDataFrame(data, "conv_id long, turn long, role string, text string")
    got = evaluation.answered_turns(df)
    assert rows(got) == [(None, 1, "n", "m"), (1, 0, "q0", "a2"), (1, 5, "q5", "a9000")]


def test_pairs_that_share_their_ids_stay_rows(spark):
    df = spark.createDataFrame([(1, 0, "red fox", "red"), (1, 0, "red fox", "red fox")], "conv_id long, turn long, question string, answer string")
    got = evaluation.evaluate_answers(df).filter("scorer = 'relevance'").select("conv_id", "score")
    assert rows(got) == [(None, 0.75), (1, 0.5), (1, 1.0)]

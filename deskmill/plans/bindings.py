"""The fixture tables in the roles the jobs expect.

Every binding takes all rows of its table. Where a table lacks something, such as message
types or settings, a rule derives it from the row's own values.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from deskmill.operators.messages import ITEM_DONE, TEXT_DELTA
from deskmill.operators.skew import unnest
from deskmill.session import spread_table, table

# The day reports are made for, and the day policies were last changed.
AS_OF = date(2025, 1, 15)
POLICY_DAY = date(2024, 6, 1)
PIECE = 40


def interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("ts").alias("date_time"),
        F.col("event_type").alias("issue_category"),
        F.col("props").alias("issue_description"),
        F.concat(F.lit("user_"), F.col("user_id")).alias("name"),
        F.col("user_id").cast("string").alias("email"),
        F.col("event_id").alias("row_id"),
    )


def policies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_type").alias("policy"),
        F.col("p_name").alias("policy_details"),
        F.lit(POLICY_DAY).alias("last_updated"),
        F.col("p_partkey").alias("row_id"),
    )


def settings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One assignment per event; errors assign NULL."""
    k = F.get_json_object("props", "$.k").cast("int")
    kind = F.col("event_type")
    data = F.concat(F.lit("datasets."), kind)
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("owner"),
        F.col("event_id").alias("seq"),
        F.when(k < 10, "catalog_name")
        .when(k < 20, "schema_name")
        .when(k < 25, "datasets")
        .when(k < 60, data)
        .when(k < 70, F.concat(F.lit("datasets_"), kind))
        .otherwise(F.concat(data, F.lit(".v"), k % 10))
        .alias("key"),
        F.when(kind != "error", F.concat(kind, F.lit("_"), k)).alias("value"),
    )


def documents_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents once reviewers are done: toxic ones taken down, poor ones rewritten in
    lower case, and the web pages added under negative ids."""
    documents = table(spark, sf_dir, "documents")
    marks = (
        table(spark, sf_dir, "labels")
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"), F.min("quality").alias("quality"))
    )
    kept = (
        documents.join(marks, "doc_id", "left")
        .filter(F.coalesce(F.col("toxic"), F.lit(0)) == 0)
        .withColumn("text", F.when(F.col("quality") == 0, F.lower("text")).otherwise(F.col("text")))
        .select(*documents.columns)
    )
    pages = table(spark, sf_dir, "pages").select(
        (-F.col("page_id") - 1).alias("doc_id"),
        F.col("html").alias("text"),
        F.lit(None).cast("string").alias("lang"),
        F.lit("web").alias("source"),
        F.length("html").cast("bigint").alias("n_chars"),
    )
    return kept.unionByName(pages)


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation turn as a JSON message; ``(conv_id + turn) % 7`` gives its kind."""
    kind = (F.col("conv_id") + F.col("turn")) % 7
    call_id = F.concat_ws("_", F.lit("call"), "conv_id", "turn")
    arguments = F.concat(F.lit('{"email":"'), F.col("conv_id"), F.lit('"}'))
    lit = F.lit

    def body(**fields):
        return F.to_json(F.struct(*[value.alias(name) for name, value in fields.items()]))

    calls = F.array(
        F.struct(
            F.struct(arguments.alias("arguments"), lit("get_order_history").alias("name")).alias("function"),
            call_id.alias("id"),
            lit("function").alias("type"),
        )
    )
    lines = F.transform(F.split("text", "\n"), lambda t: F.struct(lit("input_text").alias("type"), t.alias("text")))
    message = (
        F.when(kind == 0, body(type=lit("function_call"), call_id=call_id, name=lit("get_order_history"), arguments=arguments))
        .when(kind == 1, body(type=lit("message"), role=F.col("role"), content=lines))
        .when(kind == 2, body(type=lit("reasoning"), summary=F.array("text")))
        .when(kind == 3, body(type=lit("function_call_output"), call_id=call_id, output=F.col("text")))
        .when(kind == 4, body(role=F.col("role"), content=F.col("text"), id=call_id, status=lit("completed")))
        .when(kind == 5, body(role=lit("assistant"), content=lit(""), tool_calls=calls))
        .otherwise(body(id=call_id, status=lit("completed")))
    )
    return spread_table(spark, sf_dir, "conversations").select("conv_id", "turn", message.alias("message"))


def pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation turn cut into pieces of 40 characters; an empty text is one piece."""
    n = F.greatest(F.ceil(F.length("text") / PIECE), F.lit(1))
    cut = F.transform(
        F.sequence(F.lit(0).cast("bigint"), n - 1),
        lambda i: F.substring(F.col("text"), (i * PIECE + 1).cast("int"), F.lit(PIECE)),
    )
    turns = spread_table(spark, sf_dir, "conversations").withColumn("last_seq", n - 1)
    return unnest(turns, "conv_id", "turn", "last_seq", array=cut, value="piece", position="seq").select(
        "conv_id",
        "turn",
        F.col("seq").cast("bigint").alias("seq"),
        "piece",
        (F.col("seq") == F.col("last_seq")).alias("is_last"),
    )


def chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Response chunks: the pieces of a turn, then its tool calls in several fragments.

    ``(conv_id + turn) % 3`` is 0 for text only, 1 for one call and 2 for two calls. A
    chunk that carries calls also carries a text, which does not count.
    """
    kind = (F.col("conv_id") + F.col("turn")) % 3
    own = F.concat_ws("_", "conv_id", "turn")
    calls_type = "array<struct<id: string, name: string, arguments: string>>"
    text = pieces(spark, sf_dir).select(
        "conv_id",
        "turn",
        "seq",
        F.concat_ws("_", F.lit("msg"), own, "seq").alias("chunk_id"),
        F.col("piece").alias("content"),
        F.lit(None).cast(calls_type).alias("tool_calls"),
    )

    def call(number: str, name: str, arguments):
        call_id = F.lit(None).cast("string") if not number else F.concat(F.lit(f"call{number}_"), own)
        return F.struct(call_id.alias("id"), F.lit(name).alias("name"), arguments.alias("arguments"))

    first = call("0", "get_order_history", F.lit('{"email":'))
    second = call("1", "get_return_policy", F.lit('{"policy_name":"LARGE"}'))
    rest = [
        F.when(kind == 1, F.array(first)).otherwise(F.array(first, second)).cast(calls_type),
        F.array(call("", "", F.concat(F.lit(' "'), F.col("conv_id")))).cast(calls_type),
        F.array(call("", "", F.lit('"}'))).cast(calls_type),
    ]
    length = F.greatest(F.ceil(F.length("text") / PIECE), F.lit(1))
    tails = (
        spread_table(spark, sf_dir, "conversations")
        .filter(kind > 0)
        .select("conv_id", "turn", length.alias("n"), F.posexplode(F.array(*rest)).alias("i", "tool_calls"))
        .select(
            "conv_id",
            "turn",
            (F.col("n") + F.col("i")).cast("bigint").alias("seq"),
            F.concat_ws("_", F.lit("msg"), own, (F.col("n") + F.col("i")).cast("bigint")).alias("chunk_id"),
            F.lit("not counted").alias("content"),
            "tool_calls",
        )
    )
    return text.unionByName(tails)


def response_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A delta event per piece and one event for the finished text of every turn."""
    item = F.concat_ws("_", F.lit("msg"), "conv_id", "turn")
    custom = F.concat(F.lit("session-"), F.col("conv_id"))
    deltas = pieces(spark, sf_dir).select(
        "conv_id", "turn", "seq", F.lit(TEXT_DELTA).alias("type"), item.alias("item_id"),
        F.col("piece").alias("payload"), custom.alias("custom"),
    )
    done = spread_table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", F.greatest(F.ceil(F.length("text") / PIECE), F.lit(1)).alias("seq"),
        F.lit(ITEM_DONE).alias("type"), item.alias("item_id"), F.col("text").alias("payload"), custom.alias("custom"),
    )
    return deltas.unionByName(done)


def tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One tool call per event: good ones, unknown tools, broken and missing arguments."""
    k = F.get_json_object("props", "$.k").cast("int")
    names = F.array(*[F.lit(p) for p in ("ECONOMY", "SMALL", "MEDIUM", "PROMO", "STANDARD", "LARGE", "NONE")])
    kind = F.col("event_type")
    email = F.concat(F.lit('{"email":"'), F.col("user_id"), F.lit('"}'))
    policy = F.concat(F.lit('{"policy_name":"'), F.get(names, k % 7), F.lit('"}'))
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("call_id"),
        F.when(kind.isin("click", "error"), "support__get_order_history")
        .when(kind.isin("view", "purchase"), "support__get_return_policy")
        .otherwise("support__get_weather")
        .alias("tool"),
        F.when(kind == "click", email)
        .when(kind == "view", policy)
        .when(kind == "error", '{"email":')
        .otherwise("{}")
        .alias("arguments"),
    )

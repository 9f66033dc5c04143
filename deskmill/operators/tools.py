"""Tool calls answered in bulk, and questions sent to the right agent."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deskmill.functions.text import function_name, term_matches
from deskmill.session import materialized

SALTS = 1024
#: Calls with one key that one copy of its answer serves.
HOT_ROWS = 1 << 20

# Words that send a question to the structured data or to the documents.
STRUCTURED_TERMS = ("billing", "bill", "bills", "customer", "customers", "total", "average", "invoice")
DOCUMENT_TERMS = ("product", "products", "support", "device", "phone", "plan", "hotspot", "network")


def history_results(history: DataFrame) -> DataFrame:
    """``(key, result)``: the history of one customer as JSON, one row per customer."""
    row = F.struct("issue_category", "returns_last_12_months", "todays_date")
    return history.groupBy(F.col("email").alias("key")).agg(
        F.to_json(F.array_sort(F.collect_list(row))).alias("result")
    )


def policy_results(policies: DataFrame) -> DataFrame:
    """``(key, result)``: one policy as JSON."""
    row = F.struct("policy", "policy_details", "last_updated")
    return policies.select(F.col("policy").alias("key"), F.to_json(F.array(row)).alias("result"))


def dispatch(calls: DataFrame, functions: dict[str, tuple[str, DataFrame]], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Answer ``calls(call_id, tool, arguments)``.

    ``functions`` maps a function's name to its argument's name and its results for all
    keys, ``(key, result)``. A key without results gives ``[]``; an unknown tool, arguments
    that are no JSON object and a missing argument each give an error row.

    The calls are joined once to the results of all functions. A key asked for more than
    ``hot_rows`` times has its answer copied once for each ``hot_rows`` calls, and its calls
    are dealt out over the copies. Calls without a key are dealt out over salts that match
    nothing, so that they do not all wait in the task of the NULL key.
    """
    rows = calls.withColumn("function", function_name(F.col("tool"))).withColumn("_args", F.try_parse_json("arguments"))
    key, missing, found = F.lit(None).cast("string"), F.lit(None).cast("string"), None
    for name, (argument, results) in functions.items():
        mine = F.col("function") == name
        key = F.when(mine, F.try_variant_get(F.col("_args"), f"$.{argument}", "string")).otherwise(key)
        missing = F.when(mine, F.lit(f"missing argument {argument}")).otherwise(missing)
        own = results.select(F.lit(name).alias("function"), F.col("key").alias("_key"), F.col("result").alias("_result"))
        found = own if found is None else found.unionByName(own)
    rows = rows.withColumn("_key", key)
    asked = rows.filter("_key IS NOT NULL").groupBy("function", "_key").agg(F.count("*").alias("n")).filter(F.col("n") > hot_rows)
    # A row for each ``hot_rows`` calls at most, written first: the planner sees its size.
    hot = materialized(asked.select("function", "_key", F.ceil(F.col("n") / hot_rows).alias("_copies")), "hot_keys")
    salted = F.when(F.col("_key").isNull(), -1 - F.pmod(F.xxhash64("call_id"), F.lit(SALTS)))
    salted = salted.when(F.col("_copies").isNull(), 0).otherwise(F.pmod(F.xxhash64("call_id"), "_copies"))
    rows = rows.join(hot, ["function", "_key"], "left").withColumn("_salt", salted.cast("bigint")).drop("_copies")
    copies = F.explode(F.sequence(F.lit(0).cast("bigint"), F.coalesce(F.col("_copies"), F.lit(1)) - 1))
    found = found.join(hot, ["function", "_key"], "left").withColumn("_salt", copies).drop("_copies")
    rows = rows.join(found, ["function", "_key", "_salt"], "left")
    error = (
        F.when(~F.coalesce(F.col("function").isin(*functions), F.lit(False)), F.concat(F.lit("unknown tool "), F.col("tool")))
        .when(F.col("_args").isNull(), "arguments are not JSON")
        .when(F.col("_key").isNull(), missing)
    )
    return rows.select(
        "call_id",
        F.col("function").alias("function_name"),
        F.when(error.isNull(), "ok").otherwise("error").alias("status"),
        F.coalesce(error, F.col("_result"), F.lit("[]")).alias("result"),
    )


def route(
    question: Column,
    structured: tuple[str, ...] = STRUCTURED_TERMS,
    documents: tuple[str, ...] = DOCUMENT_TERMS,
) -> Column:
    """The agent with more of its words in the question; the documents win a tie."""
    s, d = term_matches(question, structured), term_matches(question, documents)
    return F.when(s > d, "structured").otherwise("documents")

"""Agent logs: normalising messages, folding response chunks, steps of a conversation.

Messages are rows ``(conv_id, turn, message)`` with the message as JSON text. Chunks are
rows ``(conv_id, turn, seq, chunk_id, content, tool_calls)`` with ``tool_calls`` an array
of ``(id, name, arguments)``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deskmill.operators.skew import BLOCK, joined_in_order, number_rows, top_per_key, unnest

# Message types, roles, kept keys, texts and event types of the log format.
FUNCTION_CALL, MESSAGE, REASONING, FUNCTION_OUTPUT = (
    "function_call",
    "message",
    "reasoning",
    "function_call_output",
)
ASSISTANT, TOOL, SYSTEM = "assistant", "tool", "system"
KEPT_KEYS = ("role", "content", "name", "tool_calls", "tool_call_id")
TOOL_CALL_TEXT = "tool call"
STOP_TEXT = "Max iterations reached. Stopping."
ITEM_DONE = "response.output_item.done"
TEXT_DELTA = "response.output_text.delta"


# -- messages -------------------------------------------------------------------------------


def _field(name: str, kind: str = "string") -> Column:
    return F.try_variant_get(F.col("_m"), f"$.{name}", kind)


ERROR, NOT_JSON = "error", "message is not JSON"


def _row(role: Column, content: Column, name=None, tool_calls=None, tool_call_id=None) -> Column:
    def text(value) -> Column:
        return (F.lit(None) if value is None else value).cast("string")

    return F.struct(
        text(role).alias("role"),
        text(content).alias("content"),
        text(name).alias("name"),
        text(tool_calls).alias("tool_calls"),
        text(tool_call_id).alias("tool_call_id"),
    )


def normalize_messages(messages: DataFrame) -> DataFrame:
    """Bring every kind of message into one shape: none, one or several rows per message.

    ``(conv_id, turn, part, role, content, name, tool_calls, tool_call_id)``; ``tool_calls``
    is JSON. A message with none of the kept keys gives no row, one that is not JSON a row
    with the role ``error``. Everything happens within the message's own row.
    """
    kind = _field("type")
    raw_content = _field("content", "variant")
    is_list = F.schema_of_variant(raw_content).startswith("ARRAY")
    parts = _field("content", "array<struct<text: string>>")
    raw_calls = _field("tool_calls", "variant")
    has_calls = F.size(_field("tool_calls", "array<variant>")) > 0
    content = F.when(is_list, F.to_json(raw_content)).otherwise(_field("content"))
    no_content = F.coalesce(content == "", F.lit(True)) | (is_list & (F.size(parts) == 0))
    call = F.struct(
        F.struct(_field("arguments").alias("arguments"), _field("name").alias("name")).alias("function"),
        _field("call_id").alias("id"),
        F.lit("function").alias("type"),
    )
    known = F.lit(False)
    for key in KEPT_KEYS:
        known = known | _field(key, "variant").isNotNull()
    plain = _row(
        _field("role"),
        F.when(no_content & has_calls, TOOL_CALL_TEXT).otherwise(content),
        _field("name"),
        F.to_json(raw_calls),
        _field("tool_call_id"),
    )
    one = F.array
    rows = (
        F.when(
            kind == FUNCTION_CALL,
            one(_row(F.lit(ASSISTANT), F.lit(TOOL_CALL_TEXT), tool_calls=F.to_json(F.array(call)))),
        )
        .when((kind == MESSAGE) & is_list, F.transform(parts, lambda p: _row(_field("role"), p["text"])))
        .when(kind == REASONING, one(_row(F.lit(ASSISTANT), F.to_json(_field("summary", "variant")))))
        .when(
            kind == FUNCTION_OUTPUT,
            one(_row(F.lit(TOOL), _field("output"), tool_call_id=_field("call_id"))),
        )
        .when(known, one(plain))
        .when(F.col("message").isNotNull() & F.col("_m").isNull(), one(_row(F.lit(ERROR), F.lit(NOT_JSON))))
    )
    return (
        unnest(
            messages.withColumn("_m", F.try_parse_json("message")),
            "conv_id",
            "turn",
            array=rows,
            value="r",
            position="part",
        )
        .select("conv_id", "turn", "part", "r.*")
    )


def prepend_system(normalized: DataFrame, prompt: str) -> DataFrame:
    """Every conversation with the system prompt, if not empty, in front; ``position`` from 0."""
    rows = normalized.select("conv_id", "turn", "part", "role", "content")
    numbered = number_rows(rows, ["conv_id"], "turn", ["part"], "position")
    if not prompt:
        return numbered.select("conv_id", "position", "role", "content")

    def row(position: Column, role: Column, content: Column) -> Column:
        return F.struct(position.alias("position"), role.alias("role"), content.alias("content"))

    # The first row of a conversation brings the prompt along, so nothing is read again.
    own = row(F.col("position") + 1, F.col("role"), F.col("content"))
    system = row(F.lit(0).cast("bigint"), F.lit(SYSTEM), F.lit(prompt))
    both = F.when(F.col("position") == 0, F.array(system, own)).otherwise(F.array(own))
    return numbered.select("conv_id", F.explode(both).alias("r")).select("conv_id", "r.*")


def pending_step(normalized: DataFrame) -> DataFrame:
    """What an agent does next per conversation: ``tool``, ``llm``, or it is ``done``."""
    calls = F.coalesce(F.col("tool_calls"), F.lit("[]")) != "[]"
    last = F.max_by(F.struct(calls.alias("calls"), "role"), F.struct("turn", "part"))
    step = (
        F.when(F.col("r.calls"), "tool").when(F.col("r.role") == ASSISTANT, "done").otherwise("llm")
    )
    return normalized.groupBy("conv_id").agg(last.alias("r")).select("conv_id", step.alias("step"))


def cap_turns(turns: DataFrame, cap: int) -> DataFrame:
    """The first ``cap`` steps of every conversation, then a row that says it was stopped.

    A conversation that ends in exactly its last allowed step is told so too. Spark drops
    all but ``cap`` rows per conversation and task before it shuffles.
    """
    kept = top_per_key(turns.select("conv_id", "turn", "role", "text"), ["conv_id"], [F.col("turn")], cap)
    stopped = (
        turns.groupBy("conv_id")
        .count()
        .filter(F.col("count") >= cap)
        .select(
            "conv_id",
            F.lit(cap + 1).alias("step"),
            F.lit(ASSISTANT).alias("role"),
            F.lit(STOP_TEXT).alias("text"),
        )
    )
    return kept.select("conv_id", F.col("rank").alias("step"), "role", "text").unionByName(stopped)


# -- chunks ---------------------------------------------------------------------------------


def fold_deltas(chunks: DataFrame, keys: list[str], seq: str, text: str, block: int = BLOCK) -> DataFrame:
    """The texts of every key put together in the order of ``seq``.

    Pieces are joined within blocks of ``seq`` first and the blocks after, so a key of very
    many small pieces is worked on by many tasks. The result is one string per key.
    """
    cut = F.floor(F.col(seq) / block)
    pieces = chunks.groupBy(*keys, cut.alias("_block")).agg(
        joined_in_order(seq, F.col(text)).alias(text)
    )
    return pieces.groupBy(*keys).agg(joined_in_order("_block", F.col(text)).alias(text))


def fold_chunks(chunks: DataFrame, block: int = BLOCK) -> DataFrame:
    """The finished items of every response.

    Text of chunks without tool calls adds up to one item. Of the tool calls, the list in
    the first chunk that has any is kept; arguments in later chunks go to the first call of
    that list. A chunk with tool calls adds no text. The id is that of the last chunk.
    """
    keys = ["conv_id", "turn"]
    calls = F.size("tool_calls") > 0
    fragment = F.coalesce(F.col("tool_calls")[0]["arguments"], F.lit(""))
    parts = chunks.groupBy(*keys, F.floor(F.col("seq") / block).alias("_block")).agg(
        joined_in_order("seq", F.when(~F.coalesce(calls, F.lit(False)), F.col("content"))).alias("text"),
        joined_in_order("seq", F.when(calls, fragment)).alias("arguments"),
        F.min_by("tool_calls", F.when(calls, F.col("seq"))).alias("calls"),
        F.max_by(F.struct("chunk_id"), "seq").alias("last"),
    )
    whole = parts.groupBy(*keys).agg(
        joined_in_order("_block", F.col("text")).alias("text"),
        joined_in_order("_block", F.col("arguments")).alias("arguments"),
        F.min_by("calls", F.when(F.col("calls").isNotNull(), F.col("_block"))).alias("calls"),
        F.max_by("last", "_block").alias("last"),
    )

    def item(kind: str, item_id: Column, name: Column, body: Column) -> Column:
        return F.struct(
            F.lit(kind).alias("item_type"),
            item_id.alias("item_id"),
            name.alias("name"),
            body.alias("body"),
        )

    text_item = item(MESSAGE, F.col("last.chunk_id"), F.lit(None).cast("string"), F.col("text"))
    call_items = F.transform(
        "calls",
        lambda call, i: item(
            FUNCTION_CALL,
            call["id"],
            call["name"],
            F.when(i == 0, F.col("arguments")).otherwise(call["arguments"]),
        ),
    )
    items = F.filter(
        F.concat(F.array(text_item), F.coalesce(call_items, F.array().cast(_ITEMS))),
        lambda it: (it["item_type"] != MESSAGE) | (it["body"] != ""),
    )
    rows = unnest(whole, *keys, array=items, value="it", position="item_no")
    return rows.select(*keys, "item_no", "it.*")


_ITEMS = "array<struct<item_type: string, item_id: string, name: string, body: string>>"


def final_outputs(events: DataFrame) -> DataFrame:
    """Only the finished items of an event stream; the request's own fields stay with them."""
    return events.filter(F.col("type") == ITEM_DONE).select(
        "conv_id", "turn", "seq", "item_id", "payload", "custom"
    )

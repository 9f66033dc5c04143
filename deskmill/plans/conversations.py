"""Queries over conversations, agent logs and answers."""

from __future__ import annotations

from pyspark.sql import functions as F

from deskmill.operators import evaluation, lookups, messages, tools
from deskmill.plans import bindings
from deskmill.plans.bindings import AS_OF, POLICY_DAY
from deskmill.plans.documents import blocked_sql, tokens_sql
from deskmill.plans.registry import query
from deskmill.session import scratch, spread_table
from deskmill.streaming import chunk_fold, index_refresh

PROMPT = "You are a support assistant."
CAP = 4

_CALLS_SQL = """'[{"function":{"arguments":"{\\"email\\":\\"' || conv_id || '\\"}","name":"get_order_history"},"id":"call_'
    || conv_id || '_' || turn || '","type":"function"}]'"""

NORMAL_SQL = f"""
    k AS (SELECT *, (conv_id + turn) % 7 AS kind, string_split(text, chr(10)) AS lines FROM conversations),
    norm AS (
        SELECT conv_id, turn, 0 AS part, 'assistant' AS role, 'tool call' AS content, {_CALLS_SQL} AS tool_calls,
               NULL AS tool_call_id FROM k WHERE kind IN (0, 5)
        UNION ALL
        SELECT conv_id, turn, CAST(generate_subscripts(lines, 1) - 1 AS INTEGER), role, unnest(lines), NULL, NULL
        FROM k WHERE kind = 1
        UNION ALL
        SELECT conv_id, turn, 0, 'assistant', CAST(to_json([text]) AS VARCHAR), NULL, NULL FROM k WHERE kind = 2
        UNION ALL
        SELECT conv_id, turn, 0, 'tool', text, NULL, 'call_' || conv_id || '_' || turn FROM k WHERE kind = 3
        UNION ALL
        SELECT conv_id, turn, 0, role, text, NULL, NULL FROM k WHERE kind = 4)"""


def _normal(spark, sf_dir):
    return messages.normalize_messages(bindings.messages(spark, sf_dir))


@query(
    "normalize_messages",
    f"""WITH {NORMAL_SQL}
        SELECT conv_id, turn, part, role, content, NULL::VARCHAR AS name, tool_calls, tool_call_id FROM norm""",
)
def normalize_messages(spark, sf_dir):
    return _normal(spark, sf_dir)


@query(
    "prepend_system",
    f"""WITH {NORMAL_SQL},
        a AS (SELECT conv_id, turn, part, role, content FROM norm
              UNION ALL SELECT DISTINCT conv_id, -1, 0, 'system', '{PROMPT}' FROM norm)
        SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn, part) - 1 AS position, role, content FROM a""",
)
def prepend_system(spark, sf_dir):
    return messages.prepend_system(_normal(spark, sf_dir), PROMPT)


@query(
    "pending_step",
    f"""WITH {NORMAL_SQL},
        r AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC, part DESC) AS rn FROM norm)
        SELECT conv_id, CASE WHEN tool_calls IS NOT NULL THEN 'tool' WHEN role = 'assistant' THEN 'done' ELSE 'llm' END AS step
        FROM r WHERE rn = 1""",
)
def pending_step(spark, sf_dir):
    return messages.pending_step(_normal(spark, sf_dir))


@query(
    "cap_turns",
    f"""WITH r AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS step FROM conversations)
        SELECT conv_id, CAST(step AS INTEGER) AS step, role, text FROM r WHERE step <= {CAP}
        UNION ALL
        SELECT conv_id, {CAP + 1}, 'assistant', 'Max iterations reached. Stopping.'
        FROM conversations GROUP BY conv_id HAVING count(*) >= {CAP}""",
)
def cap_turns(spark, sf_dir):
    return messages.cap_turns(spread_table(spark, sf_dir, "conversations"), CAP)


_PIECES_SQL = """
    n AS (SELECT *, greatest(CAST(ceil(length(text) / 40) AS BIGINT), 1) AS n FROM conversations),
    p AS (SELECT conv_id, turn, n, text, unnest(range(n)) AS seq FROM n),
    pieces AS (SELECT conv_id, turn, seq, substring(text, seq * 40 + 1, 40) AS piece FROM p)"""

_FOLD_SQL = f"""WITH {_PIECES_SQL}
    SELECT conv_id, turn, string_agg(piece, '' ORDER BY seq) AS text FROM pieces GROUP BY conv_id, turn"""


@query("fold_deltas", _FOLD_SQL)
def fold_deltas(spark, sf_dir):
    pieces = bindings.pieces(spark, sf_dir).withColumnRenamed("piece", "text")
    return messages.fold_deltas(pieces, ["conv_id", "turn"], "seq", "text")


@query(
    "fold_chunks",
    f"""WITH {_PIECES_SQL},
        t AS (SELECT conv_id, turn, max(seq) AS last, string_agg(piece, '' ORDER BY seq) AS body,
                     (conv_id + turn) % 3 AS kind FROM pieces GROUP BY conv_id, turn),
        i AS (SELECT conv_id, turn, 'message' AS item_type,
                     'msg_' || conv_id || '_' || turn || '_' || (last + CASE WHEN kind > 0 THEN 3 ELSE 0 END) AS item_id,
                     NULL AS name, body, 0 AS o FROM t WHERE body <> ''
              UNION ALL
              SELECT conv_id, turn, 'function_call', 'call0_' || conv_id || '_' || turn, 'get_order_history',
                     '{{"email": "' || conv_id || '"}}', 1 FROM t WHERE kind > 0
              UNION ALL
              SELECT conv_id, turn, 'function_call', 'call1_' || conv_id || '_' || turn, 'get_return_policy',
                     '{{"policy_name":"LARGE"}}', 2 FROM t WHERE kind = 2)
        SELECT conv_id, turn, CAST(row_number() OVER (PARTITION BY conv_id, turn ORDER BY o) - 1 AS INTEGER) AS item_no,
               item_type, item_id, name, body FROM i""",
)
def fold_chunks(spark, sf_dir):
    return messages.fold_chunks(bindings.chunks(spark, sf_dir))


@query(
    "final_outputs",
    f"""WITH {_PIECES_SQL}
        SELECT conv_id, turn, n AS seq, 'msg_' || conv_id || '_' || turn AS item_id, text AS payload,
               'session-' || conv_id AS custom FROM n""",
)
def final_outputs(spark, sf_dir):
    return messages.final_outputs(bindings.response_events(spark, sf_dir))


_HISTORY_JSON_SQL = f"""
    h AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY ALL),
    hr AS (SELECT CAST(user_id AS VARCHAR) AS key, '[' || string_agg('{{"issue_category":"' || event_type ||
                  '","returns_last_12_months":' || n || ',"todays_date":"{AS_OF}"}}', ',' ORDER BY event_type) || ']' AS result
           FROM h GROUP BY user_id),
    pr AS (SELECT p_type AS key, '[{{"policy":"' || p_type || '","policy_details":"' || min_by(p_name, p_partkey) ||
                  '","last_updated":"{POLICY_DAY}"}}]' AS result FROM part GROUP BY p_type)"""


@query(
    "dispatch_tools",
    f"""WITH {_HISTORY_JSON_SQL},
        c AS (SELECT *, ['ECONOMY', 'SMALL', 'MEDIUM', 'PROMO', 'STANDARD', 'LARGE', 'NONE'][
                        CAST(json_extract_string(props, '$.k') AS INTEGER) % 7 + 1] AS policy FROM events)
        SELECT event_id AS call_id,
               CASE WHEN event_type IN ('click', 'error') THEN 'support.get_order_history'
                    WHEN event_type IN ('view', 'purchase') THEN 'support.get_return_policy'
                    ELSE 'support.get_weather' END AS function_name,
               CASE WHEN event_type IN ('click', 'view') THEN 'ok' ELSE 'error' END AS status,
               CASE event_type WHEN 'click' THEN hr.result WHEN 'view' THEN coalesce(pr.result, '[]')
                    WHEN 'error' THEN 'arguments are not JSON' WHEN 'purchase' THEN 'missing argument policy_name'
                    ELSE 'unknown tool support__get_weather' END AS result
        FROM c LEFT JOIN hr ON hr.key = CAST(user_id AS VARCHAR) LEFT JOIN pr ON pr.key = policy""",
)
def dispatch_tools(spark, sf_dir):
    history = lookups.order_history_by_key(bindings.interactions(spark, sf_dir), AS_OF)
    policies = lookups.policy_lookup(bindings.policies(spark, sf_dir))
    functions = {
        "support.get_order_history": ("email", tools.history_results(history)),
        "support.get_return_policy": ("policy_name", tools.policy_results(policies)),
    }
    return tools.dispatch(bindings.tool_calls(spark, sf_dir), functions)


# The fixture's texts are invented, so its own frequent words stand in for domain words.
STRUCTURED_WORDS = (*tools.STRUCTURED_TERMS, "the", "les", "und", "los")
DOCUMENT_WORDS = (*tools.DOCUMENT_TERMS, "of", "de", "der", "en")


def _matches_sql(words: tuple[str, ...]) -> str:
    terms = ", ".join(f"'{w}'" for w in words)
    return f"len(list_filter({tokens_sql('text')}, lambda t: list_contains([{terms}], t)))"


@query(
    "route_questions",
    f"""SELECT conv_id, turn, CASE WHEN {_matches_sql(STRUCTURED_WORDS)} > {_matches_sql(DOCUMENT_WORDS)}
                                   THEN 'structured' ELSE 'documents' END AS agent
        FROM conversations WHERE role = 'user'""",
)
def route_questions(spark, sf_dir):
    asked = spread_table(spark, sf_dir, "conversations").filter(F.col("role") == "user")
    return asked.select(
        "conv_id", "turn", tools.route(F.col("text"), STRUCTURED_WORDS, DOCUMENT_WORDS).alias("agent")
    )


# -- evaluation -----------------------------------------------------------------------------

_PAIRS_SQL = f"""
    turns AS (SELECT *, lead(role) OVER w AS next_role, lead(text) OVER w AS answer
              FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
    pairs AS (SELECT conv_id, turn, text AS question, answer,
                     list_distinct({tokens_sql('text')}) AS wanted, {tokens_sql('answer')} AS given
              FROM turns WHERE role = 'user' AND next_role = 'assistant')"""
_RELEVANCE_SQL = "CASE WHEN len(wanted) = 0 THEN 0 ELSE round(len(list_intersect(wanted, given)) / len(wanted), 6) END"
_SENTENCES_SQL = r"len(list_filter(regexp_split_to_array({}, '[.!?]+'), lambda s: regexp_replace(s, '\s+', '', 'g') <> ''))"


@query("score_relevance", f"WITH {_PAIRS_SQL} SELECT conv_id, turn, {_RELEVANCE_SQL} AS relevance FROM pairs")
def score_relevance(spark, sf_dir):
    pairs = evaluation.answered_turns(spread_table(spark, sf_dir, "conversations"))
    score = evaluation.relevance(F.col("question"), F.col("answer"))
    return pairs.select("conv_id", "turn", score.alias("relevance"))


@query(
    "score_relevance_normalized",
    f"""WITH {NORMAL_SQL},
        n AS (SELECT conv_id, turn, role, content AS question,
                     lead(role) OVER w AS next_role, lead(content) OVER w AS answer
              FROM norm WINDOW w AS (PARTITION BY conv_id ORDER BY turn, part)),
        pairs AS (SELECT conv_id, turn, list_distinct({tokens_sql('question')}) AS wanted, {tokens_sql('answer')} AS given
                  FROM n WHERE role = 'user' AND next_role = 'assistant')
        SELECT conv_id, turn, {_RELEVANCE_SQL} AS relevance FROM pairs""",
)
def score_relevance_normalized(spark, sf_dir):
    turns = _normal(spark, sf_dir).select("conv_id", "turn", "part", "role", F.col("content").alias("text"))
    pairs = evaluation.answered_turns(turns, order=("part",))
    return pairs.select("conv_id", "turn", evaluation.relevance(F.col("question"), F.col("answer")).alias("relevance"))


@query(
    "evaluate_answers",
    f"""WITH {_PAIRS_SQL},
        s AS (SELECT conv_id, turn, 'relevance' AS scorer, CAST({_RELEVANCE_SQL} AS DOUBLE) AS score FROM pairs
              UNION ALL SELECT conv_id, turn, 'safety', CASE WHEN {blocked_sql('answer')} THEN 0 ELSE 1 END FROM pairs
              UNION ALL SELECT conv_id, turn, 'style', CASE WHEN {_SENTENCES_SQL.format('answer')} <= 2 THEN 1 ELSE 0 END
              FROM pairs)
        SELECT * FROM s UNION ALL SELECT NULL, NULL, scorer, round(avg(score), 6) FROM s GROUP BY scorer""",
)
def evaluate_answers(spark, sf_dir):
    return evaluation.evaluate_answers(evaluation.answered_turns(spread_table(spark, sf_dir, "conversations")))


@query(
    "style_check",
    f"""SELECT conv_id, turn, CAST({_SENTENCES_SQL.format('text')} AS INTEGER) AS n_sentences,
               {_SENTENCES_SQL.format('text')} <= 2 AS style_ok FROM conversations""",
)
def style_check(spark, sf_dir):
    return evaluation.style_check(spread_table(spark, sf_dir, "conversations"))


@query(
    "expected_total_check",
    """WITH h AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY ALL)
       SELECT CAST(user_id AS VARCHAR) AS email,
              string_agg(format('{:,}', n) || ' contacts about ' || event_type, chr(10) ORDER BY event_type)
                  || chr(10) || 'In all, a total of ' || format('{:,}', CAST(sum(n) AS BIGINT)) || ' contacts' AS answer,
              CAST(sum(n) AS BIGINT) AS added, CAST(sum(n) AS BIGINT) AS stated, true AS consistent
       FROM h GROUP BY user_id""",
)
def expected_total_check(spark, sf_dir):
    history = lookups.order_history_by_key(bindings.interactions(spark, sf_dir), AS_OF)
    return evaluation.expected_total_check(evaluation.history_answers(history))


# -- streams of chunks ----------------------------------------------------------------------


@query("stream_fold_deltas", _FOLD_SQL)
def stream_fold_deltas(spark, sf_dir):
    landed, target, checkpoint = (scratch(spark, name) for name in ("pieces", "folded", "checkpoint"))
    files = int(spark.conf.get("spark.sql.shuffle.partitions"))
    pieces = bindings.pieces(spark, sf_dir)
    # Dealing the pieces out by their own hash puts those of one message in several files.
    pieces.repartition(files, F.xxhash64("conv_id", "turn", "seq")).write.parquet(landed)
    stream = index_refresh.read_stream(spark, landed, pieces.schema, "*.parquet", max(1, files // 2))
    chunk_fold.run_fold(stream, target, checkpoint).awaitTermination()
    return chunk_fold.folded(spark, target)

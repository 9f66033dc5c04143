"""Queries over tables: sources, lookups, summaries, settings, scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from deskmill.functions import sql_functions, text
from deskmill.operators import lookups, metadata
from deskmill.plans import bindings
from deskmill.plans.bindings import AS_OF, POLICY_DAY
from deskmill.plans.registry import iso_days, query
from deskmill.session import TABLES, scratch, spread_table, table, view
from deskmill.sources import csv_tables, landing, profile, snapshots

# -- sources --------------------------------------------------------------------------------


@query("scan_all", "SELECT event_id, ts, user_id, event_type, value, props FROM events")
def scan_all(spark, sf_dir):
    return spark.table(view(spark, sf_dir, "events"))


@query("csv_multiline_scan", "SELECT doc_id, text, lang, source, n_chars FROM documents")
def csv_multiline_scan(spark, sf_dir):
    documents = spread_table(spark, sf_dir, "documents")
    path = scratch(spark, "csv")
    csv_tables.write_csv(documents, path)
    return csv_tables.scan_csv(spark, path, documents.schema)


@query("idempotent_load", "SELECT doc_id, text, lang, source, n_chars FROM documents")
def idempotent_load(spark, sf_dir):
    documents = spread_table(spark, sf_dir, "documents")
    landed, target = scratch(spark, "landed"), scratch(spark, "loaded")
    csv_tables.write_csv(documents, landed)
    for _ in range(2):  # the second run finds every file loaded
        csv_tables.load_new_files(spark, landed, target, documents.schema)
    return csv_tables.loaded_rows(spark, target, documents.schema).drop(csv_tables.SOURCE_FILE)


@query(
    "load_report",
    """SELECT 'skipped' AS status, CAST(count(*) AS BIGINT) AS n_rows FROM orders WHERE o_orderkey % 10 <> 0
       UNION ALL SELECT 'loaded', count(*) FROM orders WHERE o_orderkey % 10 = 0
       UNION ALL SELECT 'failed', 0""",
)
def load_report(spark, sf_dir):
    """Two loads: most orders, then the rest with their columns the other way round, and other tables."""
    orders, customers = (spread_table(spark, sf_dir, name) for name in ("orders", "customer"))
    landed, target = scratch(spark, "landed"), scratch(spark, "loaded")
    csv_tables.write_csv(orders.filter("o_orderkey % 10 <> 0"), landed)
    csv_tables.write_csv(customers, landed, "append")
    csv_tables.load_new_files(spark, landed, target, orders.schema)
    csv_tables.write_csv(orders.filter("o_orderkey % 10 = 0").select(*reversed(orders.columns)), landed, "append")
    report = csv_tables.load_new_files(spark, landed, target, orders.schema)
    return report.groupBy("status").agg(F.sum("rows").alias("n_rows"))


@query(
    "overwrite_load",
    "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders",
)
def overwrite_load(spark, sf_dir):
    path = scratch(spark, "billing")
    name = "billing_" + path.rsplit("-", 1)[1]
    for source in ("customer", "orders"):  # the second load replaces rows and schema
        rows = spread_table(spark, sf_dir, source)
        landed = scratch(spark, "landed")
        csv_tables.write_csv(rows, landed)
        csv_tables.overwrite_table(csv_tables.scan_csv(spark, landed, rows.schema), name, path)
    return spark.table(name)


_COLUMNS = dict(
    region=2, nation=3, customer=5, supplier=4, part=6, orders=6, lineitem=11, events=6,
    documents=5, embeddings=3, pages=3, benchmark=2, labels=3, conversations=4,
)


@query(
    "table_profile",
    " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS row_count, CAST({n} AS BIGINT) AS column_count FROM {name}"
        for name, n in _COLUMNS.items()
    ),
)
def table_profile(spark, sf_dir):
    return profile.table_profile({name: table(spark, sf_dir, name) for name in TABLES})


@query(
    "binary_roundtrip",
    """SELECT doc_id, doc_id || '.pdf' AS file_name, base64(encode(text)) AS payload,
              CAST(octet_length(encode(text)) AS BIGINT) AS n_bytes, true AS intact
       FROM documents""",
)
def binary_roundtrip(spark, sf_dir):
    files = spread_table(spark, sf_dir, "documents").select(
        "doc_id",
        F.concat_ws("/", F.lit("landing"), "source", F.concat(F.col("doc_id"), F.lit(".pdf"))).alias("path"),
        F.col("text").cast("binary").alias("bytes"),
    )
    back = landing.decode_payloads(landing.encode_payloads(files, "path", "bytes"))
    return back.select(
        "doc_id",
        "file_name",
        "payload",
        F.octet_length("bytes").cast("bigint").alias("n_bytes"),
        (F.col("content") == F.col("bytes")).alias("intact"),
    )


@query("file_basename", "SELECT page_id, list_extract(string_split(url, '/'), -1) AS file_name FROM pages")
def file_basename(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", text.file_name(F.col("url")).alias("file_name"))


@query("identifier_scan", "SELECT event_id, user_id, event_type, value FROM events")
def identifier_scan(spark, sf_dir):
    return sql_functions.scan_named(spark, view(spark, sf_dir, "events"), "event_id, user_id, event_type, value")


AFTER_SQL = """
    SELECT d.doc_id, CASE WHEN m.quality = 0 THEN lower(d.text) ELSE d.text END AS text, d.lang, d.source, d.n_chars
    FROM documents d LEFT JOIN (SELECT doc_id, max(toxic) AS toxic, min(quality) AS quality FROM labels GROUP BY doc_id) m
      ON d.doc_id = m.doc_id
    WHERE coalesce(m.toxic, 0) = 0
    UNION ALL
    SELECT -page_id - 1, html, NULL, 'web', CAST(length(html) AS BIGINT) FROM pages"""


@query(
    "change_feed",
    f"""WITH a AS ({AFTER_SQL}), b AS (SELECT * FROM documents),
        u AS (SELECT b.doc_id FROM b JOIN a ON a.doc_id = b.doc_id
              WHERE a.text IS DISTINCT FROM b.text OR a.lang IS DISTINCT FROM b.lang
                 OR a.source IS DISTINCT FROM b.source OR a.n_chars IS DISTINCT FROM b.n_chars)
        SELECT doc_id, 'insert' AS change_type, text, lang, source, n_chars FROM a
        WHERE doc_id NOT IN (SELECT doc_id FROM b)
        UNION ALL
        SELECT doc_id, 'delete', text, lang, source, n_chars FROM b WHERE doc_id NOT IN (SELECT doc_id FROM a)
        UNION ALL
        SELECT doc_id, 'update_preimage', text, lang, source, n_chars FROM b WHERE doc_id IN (SELECT doc_id FROM u)
        UNION ALL
        SELECT doc_id, 'update_postimage', text, lang, source, n_chars FROM a WHERE doc_id IN (SELECT doc_id FROM u)""",
)
def change_feed(spark, sf_dir):
    return snapshots.change_feed(
        table(spark, sf_dir, "documents"), bindings.documents_after(spark, sf_dir), "doc_id"
    )


@query(
    "change_feed_events",
    """SELECT event_id, 'update_preimage' AS change_type, ts, user_id, event_type, value, props FROM events WHERE event_id % 11 = 0
       UNION ALL
       SELECT event_id, 'update_postimage', ts + INTERVAL 1 MICROSECOND, user_id, event_type, value, props
       FROM events WHERE event_id % 11 = 0""",
)
def change_feed_events(spark, sf_dir):
    before = table(spark, sf_dir, "events")
    later = F.expr("CASE WHEN event_id % 11 = 0 THEN ts + INTERVAL '0.000001' SECOND ELSE ts END")
    return snapshots.change_feed(before, before.withColumn("ts", later), "event_id")


# -- lookups and summaries ------------------------------------------------------------------


@query("not_null_names", "SELECT p_name FROM part WHERE p_name IS NOT NULL")
def not_null_names(spark, sf_dir):
    return lookups.not_null(table(spark, sf_dir, "part"), "p_name")


@query(
    "policy_lookup",
    f"""SELECT p_type AS policy, p_name AS policy_details, '{POLICY_DAY}' AS last_updated
        FROM (SELECT *, row_number() OVER (PARTITION BY p_type ORDER BY p_partkey) AS rn FROM part) WHERE rn = 1""",
)
def policy_lookup(spark, sf_dir):
    return iso_days(lookups.policy_lookup(bindings.policies(spark, sf_dir)))


@query(
    "find_by_name",
    """WITH r AS (SELECT DISTINCT 'Customer#' || lpad(CAST(o_custkey + 100 AS VARCHAR), 9, '0') AS c_name FROM orders)
       SELECT r.c_name, min(c.c_custkey) AS c_custkey FROM r LEFT JOIN customer c ON r.c_name = c.c_name
       GROUP BY r.c_name""",
)
def find_by_name(spark, sf_dir):
    number = F.lpad((F.col("o_custkey") + 100).cast("string"), 9, "0")
    requests = table(spark, sf_dir, "orders").select(F.concat(F.lit("Customer#"), number).alias("c_name"))
    return lookups.find_by_name(requests, table(spark, sf_dir, "customer"), "c_name", "c_custkey", "c_custkey")


@query(
    "latest_interaction",
    """SELECT strftime(ts, '%Y-%m-%d') AS purchase_date, event_type AS issue_category, props AS issue_description,
              'user_' || user_id AS name
       FROM events ORDER BY ts DESC, event_id DESC LIMIT 1""",
)
def latest_interaction(spark, sf_dir):
    return iso_days(lookups.latest_interaction(bindings.interactions(spark, sf_dir)))


_LATEST_PER_KEY_SQL = """
    SELECT CAST(user_id AS VARCHAR) AS email, strftime(ts, '%Y-%m-%d') AS purchase_date, event_type AS issue_category,
           props AS issue_description, 'user_' || user_id AS name
    FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
    WHERE rn = 1"""


@query("latest_per_key", _LATEST_PER_KEY_SQL)
def latest_per_key(spark, sf_dir):
    return iso_days(lookups.latest_per_key(bindings.interactions(spark, sf_dir)))


@query(
    "order_history_as_written",
    f"""SELECT CAST(count(*) AS INTEGER) AS returns_last_12_months, event_type AS issue_category,
               '{AS_OF}' AS todays_date
        FROM events WHERE user_id IS NOT NULL GROUP BY event_type""",
)
def order_history_as_written(spark, sf_dir):
    return iso_days(lookups.order_history_as_written(bindings.interactions(spark, sf_dir), AS_OF))


@query(
    "order_history_by_key",
    f"""SELECT CAST(user_id AS VARCHAR) AS email, CAST(count(*) AS INTEGER) AS returns_last_12_months,
               event_type AS issue_category, '{AS_OF}' AS todays_date
        FROM events WHERE CAST(ts AS DATE) > DATE '{AS_OF}' - INTERVAL 12 MONTH AND CAST(ts AS DATE) <= DATE '{AS_OF}'
        GROUP BY user_id, event_type""",
)
def order_history_by_key(spark, sf_dir):
    return iso_days(lookups.order_history_by_key(bindings.interactions(spark, sf_dir), AS_OF, months=12))


@query(
    "category_totals",
    """SELECT coalesce(event_type, 'TOTAL') AS issue_category, count(*) AS n
       FROM events WHERE event_type IS NOT NULL GROUP BY ROLLUP (event_type)""",
)
def category_totals(spark, sf_dir):
    return lookups.category_totals(bindings.interactions(spark, sf_dir))


@query(
    "avg_total_bill",
    """WITH b AS (SELECT c_mktsegment, CAST(o_totalprice AS DECIMAL(18, 2)) AS amount
                  FROM orders JOIN customer ON o_custkey = c_custkey)
       SELECT coalesce(c_mktsegment, 'ALL') AS segment, count(*) AS bills,
              round(CAST(sum(amount) AS DOUBLE) / count(*), 2) AS average_bill
       FROM b GROUP BY ROLLUP (c_mktsegment)""",
)
def avg_total_bill(spark, sf_dir):
    bills = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_totalprice")
    customers = table(spark, sf_dir, "customer")
    return lookups.average_bill(bills, customers, "c_custkey", "c_mktsegment", "o_totalprice")


@query(
    "bill_change",
    """WITH m AS (SELECT o_custkey, strftime(o_orderdate, '%Y-%m') AS month,
                         sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS total
                  FROM orders GROUP BY ALL),
            w AS (SELECT *, lag(total) OVER (PARTITION BY o_custkey ORDER BY month) AS p FROM m)
       SELECT o_custkey, month, CAST(total AS DOUBLE) AS total, CAST(p AS DOUBLE) AS previous_total,
              CAST(total - p AS DOUBLE) AS change FROM w""",
)
def bill_change(spark, sf_dir):
    return lookups.bill_change(table(spark, sf_dir, "orders"), "o_custkey", "o_orderdate", "o_totalprice")


_CHECKS = {
    "documents": (["doc_id"], ["text"]),
    "events": (["event_id"], ["user_id", "event_type"]),
    "conversations": (["conv_id", "turn"], ["text"]),
    "customer": (["c_custkey"], ["c_name"]),
    "orders": (["o_orderkey"], ["o_custkey", "o_orderdate"]),
    "part": (["p_name"], ["p_type"]),  # names repeat: not ready
}


def _readiness_sql() -> str:
    parts = []
    for name, (key, required) in _CHECKS.items():
        missing = " OR ".join(f"{c} IS NULL" for c in [*key, *required])
        parts.append(
            f"""SELECT '{name}' AS table_name, count(*) > 0 AS has_rows,
                       count(*) = count(DISTINCT ({', '.join(key)})) AS key_unique,
                       count(*) FILTER (WHERE {missing}) = 0 AS required_filled FROM {name}"""
        )
    flags = "bool_and(has_rows) AS has_rows, bool_and(key_unique) AS key_unique, bool_and(required_filled) AS required_filled"
    return f"""WITH t AS ({" UNION ALL ".join(parts)}), a AS (SELECT * FROM t UNION ALL SELECT '*', {flags} FROM t)
        SELECT *, has_rows AND key_unique AND required_filled AS ready FROM a"""


@query("readiness", _readiness_sql())
def readiness(spark, sf_dir):
    return profile.readiness({n: (table(spark, sf_dir, n), *checks) for n, checks in _CHECKS.items()})


# -- settings -------------------------------------------------------------------------------

SETTINGS_SQL = """
    SELECT user_id AS owner, event_id AS seq,
           CASE WHEN k < 10 THEN 'catalog_name' WHEN k < 20 THEN 'schema_name' WHEN k < 25 THEN 'datasets'
                WHEN k < 60 THEN 'datasets.' || event_type WHEN k < 70 THEN 'datasets_' || event_type
                ELSE 'datasets.' || event_type || '.v' || (k % 10) END AS key,
           CASE WHEN event_type <> 'error' THEN event_type || '_' || k END AS value
    FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)"""


def _last_value(rows: str) -> str:
    return f"""SELECT owner, key, seq, value FROM (
        SELECT *, row_number() OVER (PARTITION BY owner, key ORDER BY seq DESC) AS rn FROM ({rows})) WHERE rn = 1"""


@query(
    "meta_map",
    f"""SELECT owner, key AS map_key, value AS map_value FROM (
        {_last_value(f"SELECT owner, seq, replace(key, '.', '_') AS key, value FROM ({SETTINGS_SQL})")})""",
)
def meta_map(spark, sf_dir):
    metadata.settings_map(bindings.settings(spark, sf_dir)).createOrReplaceTempView("owner_settings")
    entries = spark.sql("SELECT owner, explode(settings) AS (map_key, map_value) FROM owner_settings")
    spark.sql("DROP VIEW IF EXISTS owner_settings")
    return entries


@query(
    "meta_lookup",
    f"""WITH s AS ({_last_value(SETTINGS_SQL)}),
        o AS (SELECT owner, max(value) FILTER (WHERE key = 'catalog_name') AS catalog_name,
                     max(value) FILTER (WHERE key = 'schema_name') AS schema_name
              FROM s WHERE key IN ('catalog_name', 'schema_name') GROUP BY owner)
        SELECT owner, catalog_name, CASE WHEN catalog_name IS NOT NULL THEN schema_name END AS schema_name FROM o""",
)
def meta_lookup(spark, sf_dir):
    return metadata.catalog_and_schema(bindings.settings(spark, sf_dir))


@query(
    "prefix_scan",
    f"""SELECT owner, substr(key, 10) AS key, seq, value FROM ({_last_value(SETTINGS_SQL)})
        WHERE starts_with(key, 'datasets.')""",
)
def prefix_scan(spark, sf_dir):
    return metadata.under_prefix(bindings.settings(spark, sf_dir), "datasets")


@query(
    "prefix_overwrite",
    f"""WITH s AS ({_last_value(SETTINGS_SQL)})
        SELECT owner, key, seq, value FROM s c WHERE NOT EXISTS (
            SELECT 1 FROM s p WHERE p.owner = c.owner AND starts_with(c.key, p.key || '.') AND p.seq > c.seq)""",
)
def prefix_overwrite(spark, sf_dir):
    return metadata.apply_assignments(bindings.settings(spark, sf_dir))


# -- scalar functions -----------------------------------------------------------------------


@query("login_prefix", "SELECT c_custkey, c_name AS login_name FROM customer")
def login_prefix(spark, sf_dir):
    login = F.concat("c_name", F.lit("@"), F.lower("c_mktsegment"), F.lit("@example.com"))
    return table(spark, sf_dir, "customer").select("c_custkey", text.login_prefix(login).alias("login_name"))


@query(
    "safe_name",
    r"""SELECT doc_id, substring(lower(regexp_replace(regexp_replace(text, '[./ ]', '_', 'g'),
               '[\x00-\x1f\x7f]', '', 'g')), 1, 255) AS safe_name FROM documents""",
)
def safe_name(spark, sf_dir):
    return spread_table(spark, sf_dir, "documents").select("doc_id", text.safe_name(F.col("text")).alias("safe_name"))


@query(
    "rename_keys",
    """SELECT p_partkey, replace(p_brand || '.' || p_type, '.', '_') AS flat_key, replace(p_name, ' ', '-') AS unique_name,
              'support.' || replace(p_name, ' ', '.') AS function_name
       FROM part""",
)
def rename_keys(spark, sf_dir):
    tool = F.concat(F.lit("support__"), F.replace("p_name", F.lit(" "), F.lit("__")))
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        text.flat_key(F.concat_ws(".", "p_brand", "p_type")).alias("flat_key"),
        text.spaced_name(F.col("p_name"), "-").alias("unique_name"),
        text.function_name(tool).alias("function_name"),
    )


@query(
    "name_parts",
    r"""WITH h AS (SELECT page_id, regexp_extract(url, '^[a-z]+://([^/?#:]+)', 1) AS host FROM pages)
        SELECT page_id, host, string_split(host, '.')[1] AS first_part, len(string_split(host, '.')) = 3 AS three_parts
        FROM h""",
)
def name_parts(spark, sf_dir):
    hosts = table(spark, sf_dir, "pages").select("page_id", text.host(F.col("url")).alias("host"))
    parts = text.name_parts(F.col("host"))
    return hosts.select("page_id", "host", parts[0].alias("first_part"), (F.size(parts) == 3).alias("three_parts"))


def _tagged(spark, sf_dir):
    doc = text.indexed_doc(F.col("lang"), F.col("source"), F.col("doc_id").cast("string"), F.col("text"))
    return spread_table(spark, sf_dir, "documents").select("doc_id", doc.alias("indexed_doc"))


@query(
    "indexed_doc",
    """SELECT doc_id, '<product_category>' || lang || '</product_category>' || chr(10) ||
              '<product_sub_category>' || source || '</product_sub_category>' || chr(10) ||
              '<product_name>' || doc_id || '</product_name>' || chr(10) ||
              '<product_doc>' || text || '</product_doc>' AS indexed_doc FROM documents""",
)
def indexed_doc(spark, sf_dir):
    return _tagged(spark, sf_dir)


@query(
    "parse_indexed_doc",
    """SELECT doc_id, lang AS product_category, source AS product_sub_category,
              CAST(doc_id AS VARCHAR) AS product_name, text AS product_doc FROM documents""",
)
def parse_indexed_doc(spark, sf_dir):
    fields = text.parse_indexed_doc(F.col("indexed_doc"))
    return _tagged(spark, sf_dir).select("doc_id", *[field.alias(tag) for tag, field in fields.items()])


@query(
    "json_args",
    """SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
              '{"k":' || json_extract_string(props, '$.k') || '}' AS arguments FROM events""",
)
def json_args(spark, sf_dir):
    args = F.try_parse_json("props")
    return table(spark, sf_dir, "events").select(
        "event_id", F.try_variant_get(args, "$.k", "int").alias("k"), F.to_json(args).alias("arguments")
    )


# -- SQL functions and variables ------------------------------------------------------------


@query(
    "tvf_call",
    f"""SELECT 'get_latest_return' AS called, NULL AS argument, issue_category AS label, issue_description AS detail,
               NULL::INTEGER AS n, purchase_date AS day
        FROM (SELECT * FROM (
            SELECT event_type AS issue_category, props AS issue_description, strftime(ts, '%Y-%m-%d') AS purchase_date
            FROM events ORDER BY ts DESC, event_id DESC LIMIT 1))
        UNION ALL
        SELECT 'latest_return_of', email, issue_category, issue_description, NULL, purchase_date
        FROM ({_LATEST_PER_KEY_SQL})
        UNION ALL
        SELECT 'get_order_history', CAST(user_id AS VARCHAR), event_type, NULL, CAST(count(*) AS INTEGER), '{AS_OF}'
        FROM events GROUP BY user_id, event_type
        UNION ALL
        SELECT 'get_return_policy', p_type, p_type, min_by(p_name, p_partkey), NULL, '{POLICY_DAY}'
        FROM part GROUP BY p_type""",
)
def tvf_call(spark, sf_dir):
    bindings.interactions(spark, sf_dir).createOrReplaceTempView("fn_interactions")
    bindings.policies(spark, sf_dir).createOrReplaceTempView("fn_policies")
    fn = sql_functions.create_functions(spark, "fn_interactions", "fn_policies", AS_OF)
    return iso_days(spark.sql(f"""
        SELECT 'get_latest_return' AS called, CAST(NULL AS STRING) AS argument, issue_category AS label,
               issue_description AS detail, CAST(NULL AS INT) AS n, purchase_date AS day
        FROM {fn["get_latest_return"]}()
        UNION ALL
        SELECT 'latest_return_of', u.email, r.issue_category, r.issue_description, NULL, r.purchase_date
        FROM (SELECT DISTINCT email FROM fn_interactions) u, LATERAL {fn["latest_return_of"]}(p_email => u.email) r
        UNION ALL
        SELECT 'get_order_history', u.email, h.issue_category, NULL, h.returns_last_12_months, h.todays_date
        FROM (SELECT DISTINCT email FROM fn_interactions) u, LATERAL {fn["get_order_history"]}(p_email => u.email) h
        UNION ALL
        SELECT 'get_return_policy', p.policy, r.policy, r.policy_details, NULL, r.last_updated
        FROM (SELECT DISTINCT policy FROM fn_policies) p, LATERAL {fn["get_return_policy"]}(p_policy => p.policy) r
    """))


@query(
    "session_variable",
    """SELECT o_orderpriority, count(*) AS n_orders FROM orders
       WHERE o_orderstatus = (SELECT max(o_orderstatus) FROM orders) GROUP BY o_orderpriority""",
)
def session_variable(spark, sf_dir):
    orders = view(spark, sf_dir, "orders")
    sql_functions.set_variable(spark, "bills", "MAP<STRING, STRING>", f"SELECT map('table_name', '{orders}')")
    sql_functions.set_variable(spark, "wanted_status", "STRING", "SELECT max(o_orderstatus) FROM IDENTIFIER(bills.table_name)")
    return spark.sql("""
        SELECT o_orderpriority, count(*) AS n_orders FROM IDENTIFIER(bills.table_name)
        WHERE o_orderstatus = wanted_status GROUP BY o_orderpriority""")

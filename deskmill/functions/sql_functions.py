"""SQL table functions and session variables.

Every parameter starts with ``p_``, so no column can hide it. Functions that are called
for many rows at once hold no ``LIMIT``: a lateral call would apply it to all calls
together.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession


def _create(temporary: bool) -> str:
    return "CREATE OR REPLACE TEMPORARY FUNCTION" if temporary else "CREATE OR REPLACE FUNCTION"


def create_functions(
    spark: SparkSession,
    interactions: str,
    policies: str,
    as_of: date,
    prefix: str = "",
    temporary: bool = True,
) -> dict[str, str]:
    """Create the functions over two views or tables and return their names.

    Persistent functions need persistent tables; temporary ones also work over views.
    ``interactions(date_time, issue_category, issue_description, name, email, row_id)`` and
    ``policies(policy, policy_details, last_updated, row_id)``.
    """
    names = {
        key: prefix + key
        for key in ("get_latest_return", "latest_return_of", "get_order_history", "get_return_policy")
    }
    newest = "max_by(struct(date_time, issue_category, issue_description, name), struct(date_time, row_id))"
    interaction_columns = """
        RETURNS TABLE (purchase_date DATE, issue_category STRING, issue_description STRING, name STRING)"""
    spark.sql(f"""
        {_create(temporary)} {names["get_latest_return"]}() {interaction_columns}
        COMMENT 'The newest interaction of all customers'
        RETURN SELECT cast(date_time AS DATE), issue_category, issue_description, name
        FROM {interactions} ORDER BY date_time DESC, row_id DESC LIMIT 1""")
    spark.sql(f"""
        {_create(temporary)} {names["latest_return_of"]}(
            p_email STRING COMMENT 'Customer to look up') {interaction_columns}
        COMMENT 'The newest interaction of one customer; safe to call laterally'
        RETURN SELECT cast(r.date_time AS DATE), r.issue_category, r.issue_description, r.name
        FROM (SELECT {newest} AS r FROM {interactions} WHERE email = p_email GROUP BY email)""")
    spark.sql(f"""
        {_create(temporary)} {names["get_order_history"]}(
            p_email STRING COMMENT 'Customer to look up')
        RETURNS TABLE (returns_last_12_months INT, issue_category STRING, todays_date DATE)
        COMMENT 'Interactions of one customer per category'
        RETURN SELECT count(*), issue_category, DATE '{as_of.isoformat()}'
        FROM {interactions} WHERE email = p_email GROUP BY issue_category""")
    spark.sql(f"""
        {_create(temporary)} {names["get_return_policy"]}(
            p_policy STRING COMMENT 'Policy to look up')
        RETURNS TABLE (policy STRING, policy_details STRING, last_updated DATE)
        COMMENT 'The details of one policy'
        RETURN SELECT policy, r.policy_details, r.last_updated
        FROM (SELECT policy, min_by(struct(policy_details, last_updated), row_id) AS r
              FROM {policies} WHERE policy = p_policy GROUP BY policy)""")
    return names


def create_search(
    spark: SparkSession, index: str, documents: str, name: str = "search_product_docs", temporary: bool = True
) -> str:
    """A table function that finds the documents nearest to a search term.

    ``index(id, vector)`` is a stored vector index and ``documents(id, product_name, doc)``
    what it was made from. The term alone is embedded; the index is read once and not
    shuffled. ``p_num_results`` rows come back, the best first, or all if there are fewer. A
    zero vector has similarity 0, so there is an answer whatever the term; equal
    similarities go to the lower id.
    """
    spark.sql(f"""
        {_create(temporary)} {name}(
            p_search_term STRING COMMENT 'What to look for',
            p_num_results INT DEFAULT 1 COMMENT 'How many documents')
        RETURNS TABLE
        COMMENT 'The documents nearest to a search term'
        RETURN
        WITH found AS (
            SELECT transform(filter(split(lower(p_search_term), '[^\\\\p{{L}}\\\\p{{N}}]+'), t -> t <> ''),
                             t -> cast(conv(substr(md5(t), 1, 8), 16, 10) AS BIGINT) % 64) AS buckets),
        term AS (
            SELECT transform(sequence(0, 63), b -> cast(size(filter(buckets, x -> x = b)) AS DOUBLE)) AS asked FROM found),
        held AS (SELECT id, vector, (SELECT max(asked) FROM term) AS asked FROM {index} WHERE vector IS NOT NULL),
        scored AS (
            SELECT id, sqrt(aggregate(asked, 0D, (acc, x) -> acc + x * x) * aggregate(vector, 0D, (acc, x) -> acc + x * x)) AS norm,
                   aggregate(zip_with(vector, asked, (x, y) -> x * y), 0D, (acc, x) -> acc + x) AS dot FROM held),
        best AS (
            SELECT id, CASE WHEN norm > 0 THEN round(dot / norm, 6) ELSE 0D END AS similarity
            FROM scored),
        ranked AS (SELECT id, similarity, row_number() OVER (ORDER BY similarity DESC, id) AS rank FROM best)
        SELECT d.product_name, d.doc, b.similarity, b.rank
        FROM ranked b JOIN {documents} d ON d.id = b.id WHERE b.rank <= p_num_results""")
    return name


def set_variable(spark: SparkSession, name: str, kind: str, query: str) -> None:
    """Declare a session variable and fill it from a one-row query."""
    spark.sql(f"DECLARE OR REPLACE VARIABLE {name} {kind}")
    spark.sql(f"SET VAR {name} = ({query})")


def scan_named(spark: SparkSession, table: str, columns: str = "*") -> DataFrame:
    """Scan a table whose name is a value, not a part of the query text."""
    return spark.sql(f"SELECT {columns} FROM IDENTIFIER(:t)", args={"t": table})

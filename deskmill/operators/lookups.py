"""Lookups and summaries over interactions, policies and bills."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNotNull()).select(column)


def money(column: str) -> Column:
    """Cents add up exactly as decimals, in whatever order the tasks finish."""
    return F.col(column).cast("decimal(18,2)")


# -- interactions: (date_time, issue_category, issue_description, name, email, row_id) ------


def latest_interaction(interactions: DataFrame) -> DataFrame:
    """The newest interaction; of two at the same time, the one with the higher row id."""
    return (
        interactions.orderBy(F.desc("date_time"), F.desc("row_id"))
        .limit(1)
        .select(
            F.col("date_time").cast("date").alias("purchase_date"),
            "issue_category",
            "issue_description",
            "name",
        )
    )


def latest_per_key(interactions: DataFrame, key: str = "email") -> DataFrame:
    """:func:`latest_interaction` for every key, as an aggregate that combines early."""
    row = F.struct("date_time", "issue_category", "issue_description", "name")
    newest = F.max_by(row, F.struct("date_time", "row_id"))
    return (
        interactions.groupBy(key)
        .agg(newest.alias("r"))
        .select(
            key,
            F.col("r.date_time").cast("date").alias("purchase_date"),
            "r.issue_category",
            "r.issue_description",
            "r.name",
        )
    )


def _history(rows: DataFrame, keys: list[str], as_of: date) -> DataFrame:
    return rows.groupBy(*keys, "issue_category").agg(
        F.count(F.lit(1)).cast("int").alias("returns_last_12_months"),
        F.lit(as_of).cast("date").alias("todays_date"),
    )


def order_history_as_written(interactions: DataFrame, as_of: date) -> DataFrame:
    """Interactions per category.

    The filter compares the key with itself, so it keeps every row that has a key, for
    whatever customer one asks; nor does it look at dates. Kept for its results.
    """
    kept = interactions.filter(F.col("email") == F.col("email"))
    return _history(kept, [], as_of)


def order_history_by_key(
    interactions: DataFrame, as_of: date, key: str | None = None, months: int | None = None
) -> DataFrame:
    """Interactions per customer and category: for one key, or for all keys at once."""
    kept = interactions.filter(F.col("email").isNotNull())
    if key is not None:
        kept = kept.filter(F.col("email") == key)
    if months is not None:
        day = F.lit(as_of).cast("date")
        when = F.col("date_time").cast("date")
        kept = kept.filter((when > F.add_months(day, -months)) & (when <= day))
    return _history(kept, ["email"], as_of)


def category_totals(interactions: DataFrame) -> DataFrame:
    """Rows per category, and the total of all categories in the row ``TOTAL``."""
    counted = interactions.filter(F.col("issue_category").isNotNull()).rollup("issue_category")
    return counted.agg(F.count(F.lit(1)).alias("n")).select(
        F.coalesce("issue_category", F.lit("TOTAL")).alias("issue_category"), "n"
    )


# -- policies: (policy, policy_details, last_updated, row_id) -------------------------------


def policy_lookup(policies: DataFrame, policy: str | None = None) -> DataFrame:
    """At most one row per policy, that of the lowest row id: for one policy or for all."""
    wanted = policies.filter(F.col("policy").isNotNull())
    if policy is not None:
        wanted = wanted.filter(F.col("policy") == policy)
    first = F.min_by(F.struct("policy_details", "last_updated"), "row_id")
    return wanted.groupBy("policy").agg(first.alias("r")).select("policy", "r.*")


def find_by_name(requests: DataFrame, listing: DataFrame, name: str, found: str, order: str) -> DataFrame:
    """The first listed item of every requested name; NULL where none has the name.

    Both sides shrink to one row per name before they meet.
    """
    first = listing.groupBy(name).agg(F.min_by(found, order).alias(found))
    return requests.select(name).distinct().join(first, name, "left")


# -- bills: (customer, segment, day, amount) ------------------------------------------------


def average_bill(bills: DataFrame, customers: DataFrame, customer: str, segment: str, amount: str) -> DataFrame:
    """Average bill per segment, and over all in the row ``ALL``.

    Bills shrink to one row per customer before the join, so a customer with very many
    bills weighs no more there than any other.
    """
    per_customer = bills.groupBy(customer).agg(
        F.sum(money(amount)).alias("total"), F.count(F.lit(1)).alias("bills")
    )
    total = F.sum("total").cast("double")
    bill_count = F.sum("bills")
    return (
        per_customer.join(customers.select(customer, segment), customer)
        .rollup(segment)
        .agg(bill_count.alias("bills"), F.round(total / bill_count, 2).alias("average_bill"), F.grouping_id().alias("_all"))
        .select(F.when(F.col("_all") > 0, F.lit("ALL")).otherwise(F.col(segment)).alias("segment"), "bills", "average_bill")
    )


def bill_change(bills: DataFrame, customer: str, day: str, amount: str) -> DataFrame:
    """Monthly bill per customer next to that of the customer's month before.

    The window sees one row per customer and month, however many bills a month has.
    """
    monthly = bills.groupBy(customer, F.date_format(day, "yyyy-MM").alias("month")).agg(
        F.sum(money(amount)).alias("total")
    )
    before = F.lag("total").over(Window.partitionBy(customer).orderBy("month"))
    return monthly.withColumn("before", before).select(
        customer,
        "month",
        F.col("total").cast("double").alias("total"),
        F.col("before").cast("double").alias("previous_total"),
        (F.col("total") - F.col("before")).cast("double").alias("change"),
    )

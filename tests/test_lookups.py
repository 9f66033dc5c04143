from datetime import date, datetime

import pytest
from conftest import plan, rows

from deskmill.functions import sql_functions
from deskmill.operators import lookups, metadata, vectors

AS_OF = date(2025, 1, 15)


@pytest.fixture()
def interactions(spark):
    data = [
        (datetime(2025, 1, 2, 8), "Billing", "d1", "Ann", "a@x", 1),
        (datetime(2025, 1, 2, 8), "Returns", "d2", "Bob", "b@x", 2),
        (datetime(2023, 5, 1, 9), "Billing", "d3", "Ann", "a@x", 3),
        (datetime(2024, 6, 1, 9), "Feedback", "d4", "Nobody", None, 4),
    ]
    return spark.createDataFrame(
        data,
        "date_time timestamp_ntz, issue_category string, issue_description string, name string, email string, row_id long",
    )


def test_as_written_ignores_the_customer_and_drops_missing_keys(interactions):
    got = rows(lookups.order_history_as_written(interactions, AS_OF))
    assert got == [(c, n, AS_OF) for c, n in (("Billing", 2), ("Returns", 1))]


def test_history_by_key_and_months(interactions):
    by_key = lookups.order_history_by_key(interactions, AS_OF, "a@x")
    assert rows(by_key) == [("a@x", "Billing", 2, AS_OF)]
    recent = lookups.order_history_by_key(interactions, AS_OF, months=12)
    assert rows(recent) == [("a@x", "Billing", 1, AS_OF), ("b@x", "Returns", 1, AS_OF)]
    assert lookups.order_history_by_key(interactions, AS_OF, "zzz").count() == 0


def test_self_comparison_is_pushed_as_not_null(spark, interactions, folder):
    interactions.write.parquet(f"{folder}/i")
    text = plan(lookups.order_history_as_written(spark.read.parquet(f"{folder}/i"), AS_OF))
    assert "PushedFilters: [IsNotNull(email)]" in text


def test_latest_breaks_ties_by_row(interactions):
    assert rows(lookups.latest_interaction(interactions)) == [(date(2025, 1, 2), "Returns", "d2", "Bob")]
    assert rows(lookups.latest_per_key(interactions)) == [
        (None, date(2024, 6, 1), "Feedback", "d4", "Nobody"),
        ("a@x", date(2025, 1, 2), "Billing", "d1", "Ann"),
        ("b@x", date(2025, 1, 2), "Returns", "d2", "Bob"),
    ]


@pytest.fixture()
def policies(spark):
    day = date(2024, 6, 1)
    data = [("Refund", "second", day, 2), ("Refund", "first", day, 1), ("Privacy", "p", day, 3), (None, "n", day, 0)]
    return spark.createDataFrame(data, "policy string, policy_details string, last_updated date, row_id long")


def test_policy_lookup(policies):
    day = date(2024, 6, 1)
    assert rows(lookups.policy_lookup(policies, "Refund")) == [("Refund", "first", day)]
    assert rows(lookups.policy_lookup(policies, "Exchange")) == []
    assert rows(lookups.policy_lookup(policies)) == [("Privacy", "p", day), ("Refund", "first", day)]


def test_find_by_name(spark):
    listing = spark.createDataFrame([("a", 7, 2), ("a", 9, 1), ("b", 3, 1)], "name string, id int, pos int")
    asked = spark.createDataFrame([("a",), ("zz",), ("a",)], "name string")
    assert rows(lookups.find_by_name(asked, listing, "name", "id", "pos")) == [("a", 9), ("zz", None)]


def test_bills(spark):
    bills = spark.createDataFrame(
        [(1, datetime(2025, 5, 1), 10.1), (1, datetime(2025, 5, 9), 0.2), (1, datetime(2025, 6, 1), 11.0), (2, datetime(2025, 6, 3), 5.1)],
        "c int, day timestamp_ntz, amount double",
    )
    assert rows(lookups.bill_change(bills, "c", "day", "amount")) == [
        (1, "2025-05", 10.3, None, None),
        (1, "2025-06", 11.0, 10.3, 0.7),
        (2, "2025-06", 5.1, None, None),
    ]
    customers = spark.createDataFrame([(1, "home"), (2, "work"), (3, "work")], "c int, segment string")
    got = rows(lookups.average_bill(bills.drop("day"), customers, "c", "segment", "amount"))
    assert got == [("ALL", 4, 6.6), ("home", 3, 7.1), ("work", 1, 5.1)]


def test_functions_alone_and_laterally(spark, interactions, policies):
    interactions.createOrReplaceTempView("t_interactions")
    policies.createOrReplaceTempView("t_policies")
    fn = sql_functions.create_functions(spark, "t_interactions", "t_policies", AS_OF, "t_")
    one = spark.sql(f"SELECT * FROM {fn['get_order_history']}(p_email => 'a@x')")
    assert rows(one) == [(2, "Billing", AS_OF)]
    assert rows(spark.sql(f"SELECT * FROM {fn['get_order_history']}('zzz')")) == []
    assert rows(spark.sql(f"SELECT policy_details FROM {fn['get_return_policy']}('Refund')")) == [("first",)]
    assert rows(spark.sql(f"SELECT name FROM {fn['get_latest_return']}()")) == [("Bob",)]
    each = spark.sql(f"""SELECT k, r.name FROM VALUES ('a@x'), ('b@x'), ('zzz') AS t(k),
                         LATERAL {fn['latest_return_of']}(k) r""")
    assert rows(each) == [("a@x", "Ann"), ("b@x", "Bob")]


def test_persistent_functions_over_tables(spark, interactions, policies):
    interactions.write.mode("overwrite").saveAsTable("t_kept_interactions")
    policies.write.mode("overwrite").saveAsTable("t_kept_policies")
    fn = sql_functions.create_functions(spark, "t_kept_interactions", "t_kept_policies", AS_OF, "kept_", temporary=False)
    assert rows(spark.sql(f"SELECT * FROM {fn['get_order_history']}('a@x')")) == [(2, "Billing", AS_OF)]
    assert rows(spark.sql(f"SELECT policy_details FROM {fn['get_return_policy']}('Refund')")) == [("first",)]
    assert "Customer to look up" in str(spark.sql(f"DESCRIBE FUNCTION EXTENDED {fn['get_order_history']}").collect())


def test_search_function(spark):
    documents = spark.createDataFrame([(1, "a", "red fox"), (2, "b", "blue fox jumps"), (3, "c", "blue fox jumps"), (4, "d", "")], "id long, product_name string, doc string")
    documents.createOrReplaceTempView("t_docs")
    vectors.build_index(documents, ["id"], "doc").createOrReplaceTempView("t_index")
    name = sql_functions.create_search(spark, "t_index", "t_docs", "t_search")
    assert rows(spark.sql(f"SELECT * FROM {name}('Blue FOX, jumps!')")) == [("b", "blue fox jumps", 1.0, 1)]
    assert rows(spark.sql(f"SELECT * FROM {name}('')")) == [("a", "red fox", 0.0, 1)]  # the lowest id
    two = spark.sql(f"SELECT product_name, rank FROM {name}('blue fox jumps', p_num_results => 2)")
    assert rows(two) == [("b", 1), ("c", 2)]
    searching = plan(spark.sql(f"SELECT * FROM {name}('fox', 5)"))
    assert "hashpartitioning(id" not in searching
    assert "NestedLoop" not in plan(spark.sql(f"SELECT * FROM {name}('fox')"))


def test_named_table_and_variables(spark, policies):
    policies.createOrReplaceTempView("t_named")
    assert sql_functions.scan_named(spark, "t_named", "policy").count() == 4
    sql_functions.set_variable(spark, "t_policy", "STRING", "SELECT max(policy) FROM t_named")
    assert rows(spark.sql("SELECT policy_details FROM t_named WHERE policy = t_policy")) == [("first",), ("second",)]


def settings(spark, *data):
    return spark.createDataFrame([("o", i, k, v) for i, (k, v) in enumerate(data)], "owner string, seq long, key string, value string")


def test_map_keeps_nulls_and_resolves_equal_names(spark):
    df = settings(spark, ("a.b", None), ("c", "2"), ("d.e", "1"), ("d_e", "2"))
    [row] = metadata.settings_map(df).collect()
    assert row.settings == {"a_b": None, "c": "2", "d_e": "2"}


def test_assignment_prunes_children_only(spark):
    df = settings(spark, ("a.b", "1"), ("a.b.c", "2"), ("a.bc", "3"), ("a.b", "4"), ("a.b.d", "5"))
    assert [r[1:] for r in rows(metadata.apply_assignments(df))] == [("a.b", 3, "4"), ("a.b.d", 4, "5"), ("a.bc", 2, "3")]


def test_assignments_at_several_depths(spark):
    df = settings(spark, ("a.b.c.d", "0"), ("ab", "1"), ("a", "2"), ("a.b.c", "3"), ("b.a.a", "4"), ("b.a", "5"), ("a.b", "6"), ("a.b.c.d", "7"), ("ab", "8"))
    got = {r.key: r.value for r in metadata.apply_assignments(df).collect()}
    assert got == {"a": "2", "a.b": "6", "a.b.c.d": "7", "ab": "8", "b.a": "5"}


def test_prefix_and_names(spark):
    df = settings(spark, ("datasets.x", "1"), ("datasets.x", "2"), ("datasetsy", "3"), ("datasets.y.z", "4"))
    assert [(r.key, r.value) for r in metadata.under_prefix(df, "datasets").orderBy("key").collect()] == [("x", "2"), ("y.z", "4")]
    named = settings(spark, ("schema_name", "s"), ("catalog_name", "c"), ("catalog_name", None))
    assert rows(metadata.catalog_and_schema(named)) == [("o", None, None)]
    named = settings(spark, ("schema_name", "s"), ("catalog_name", "c"))
    assert rows(metadata.catalog_and_schema(named)) == [("o", "c", "s")]


def test_totals_row_is_one_even_with_a_missing_segment(spark):
    bills = spark.createDataFrame([(1, 10.0), (2, 20.0)], "c long, amount double")
    customers = spark.createDataFrame([(1, "x"), (2, None)], "c long, segment string")
    got = lookups.average_bill(bills, customers, "c", "segment", "amount")
    assert rows(got.select("segment", "bills", "average_bill")) == [(None, 1, 20.0), ("ALL", 2, 15.0), ("x", 1, 10.0)]


def test_search_gives_as_many_rows_as_asked(spark):
    spark.range(250).selectExpr("id", "transform(sequence(0, 63), b -> cast((id * b) % 7 AS DOUBLE)) AS vector").createOrReplaceTempView("m_index")
    spark.range(250).selectExpr("id", "concat('p', id) AS product_name", "'d' AS doc").createOrReplaceTempView("m_docs")
    name = sql_functions.create_search(spark, "m_index", "m_docs", "m_search")
    for asked, given in ((2, 2), (180, 180), (9999, 250)):
        found = spark.sql(f"SELECT rank FROM {name}('hello world', {asked})")
        assert sorted(r.rank for r in found.collect()) == list(range(1, given + 1))
        if asked < 250:  # each task hands on only what is asked for
            assert "TakeOrdered" in plan(found)

"""Every registered query against its SQL on the smallest fixture."""

import duckdb
import pytest

import __spark_entry__ as contract
from check import canonical
from deskmill import plans
from deskmill.session import TABLES

SF_DIR = "/root/testdata/sf0.001"
QUERIES, CHECKS = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_query_matches_sql(spark, db, name):
    got = canonical(QUERIES[name](spark, SF_DIR).toPandas())
    want = canonical(db.sql(CHECKS[name]).df())
    assert list(got.columns) == list(want.columns)
    assert len(got) > 0
    assert got.equals(want)


def test_every_job_of_the_library_has_sql():
    # SQL cannot express a trained model: test_latent.py compares it with a full decomposition.
    trained = {"latent_likeness"}
    assert set(plans.JOBS) - trained == set(plans.CHECKS) and set(plans.JOBS) <= set(QUERIES)


def test_entry_has_rows_and_schema(spark):
    df = contract.entry(spark)
    assert df.columns == ["item_id", "rank", "source", "uri", "similarity"]
    assert df.count() > 0

"""Every registered query against its SQL, on the smallest tables."""

import pytest
from check_queries import compare, connect
from conftest import SF_DIR

from __spark_entry__ import entry, oracle_sql, queries
from riskweave.catalog import ORACLE, QUERIES

ROWS_ONLY: set[str] = set()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    verdict, rows = compare(spark, con, SF_DIR, name)
    assert verdict == ("rows only" if name in ROWS_ONLY else "equal")
    assert rows > 0


def test_only_known_queries_lack_sql():
    assert set(QUERIES) - set(ORACLE) == ROWS_ONLY
    assert set(QUERIES) <= set(queries())
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    df = entry(spark)
    assert df.columns == [
        "metric_date",
        "total_transactions",
        "flagged_transactions",
        "flagged_amount",
        "avg_fraud_probability",
    ]
    assert sum(r["total_transactions"] for r in df.collect()) == 1000

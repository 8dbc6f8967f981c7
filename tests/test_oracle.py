"""Every registered query against the SQL oracle, over whole tables."""

import pytest

from checks.oracle import ORACLE
from checks.queries import QUERIES
from oracle_compare import differences, oracle_connection


@pytest.fixture(scope="module")
def oracle(data):
    connection = oracle_connection(data)
    yield connection
    connection.close()


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, data, oracle, name):
    assert differences(QUERIES[name](spark, data), oracle, ORACLE[name]) == ""


def test_oracles_return_rows(oracle):
    empty = [name for name, sql in ORACLE.items() if not oracle.execute(sql).fetchone()]
    assert empty == []


def test_entry_runs(spark):
    import __spark_entry__

    rows = __spark_entry__.entry(spark).collect()
    assert sum(row["total_requests"] for row in rows) == 1_500

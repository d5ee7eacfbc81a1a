"""Every query gives what plain SQL gives."""

import oracle
import pytest

import __spark_entry__ as entry
from tablewright.queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def db(tables):
    return oracle.connect(tables)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(name, spark, tables, db):
    assert oracle.difference(QUERIES[name](spark, tables), db, ORACLES[name]) is None


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES) and set(QUERIES) <= set(entry.queries())


def test_entry_gives_a_page(spark):
    rows = entry.entry(spark).collect()
    assert 0 < len(rows) <= 10
    balances = [r["c_acctbal"] for r in rows]
    assert balances == sorted(balances, reverse=True)

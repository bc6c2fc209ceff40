"""Every registered query with SQL agrees with DuckDB; the others return rows."""

import pytest
from compare import connect, difference
from conftest import SF

import __spark_entry__ as entry

ORACLE = entry.oracle_sql()
QUERIES = entry.queries()


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_agrees_with_sql(spark, duck, name):
    assert difference(QUERIES[name](spark, SF), duck, ORACLE[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_returns_rows(spark, name):
    assert QUERIES[name](spark, SF).limit(1).count() == 1


def test_every_sql_belongs_to_a_query():
    from tidegauge.plans.oracle import ORACLE as every

    assert set(every) <= set(QUERIES)


def test_entry(spark):
    df = entry.entry(spark)
    assert "alert_types" in df.columns and df.count() > 0

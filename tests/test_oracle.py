"""Every registered query gives the rows that its SQL gives in another engine."""

import duckdb
import pytest

import __spark_entry__ as entry_points
from bidmill.checks.oracle import oracle_sql
from bidmill.checks.queries import queries
from conftest import SF_DIR

QUERIES = queries()
ORACLE = oracle_sql()


@pytest.fixture(scope="module")
def database():
    con = duckdb.connect()
    for table in ("events", "nation"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return con


def _sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(repr([r[i] for i in order]) for r in rows)


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_sql(spark, database, name):
    result = QUERIES[name](spark, SF_DIR)
    found = _sorted_rows(result.columns, [tuple(r) for r in result.collect()])
    if name not in ORACLE:
        assert found[1]
        return
    answer = database.execute(ORACLE[name])
    names = [d[0] for d in answer.description]
    assert found == _sorted_rows(names, answer.fetchall())


def test_only_the_approximate_query_has_no_sql():
    assert set(QUERIES) - set(ORACLE) == {"agg_approx_count_distinct"}
    assert set(ORACLE) <= set(QUERIES)


def test_entry_runs(spark):
    result = entry_points.entry(spark)
    assert result.columns == ["country", "day", "COUNT(*)", "sum(bid_price)"]
    assert result.count() > 0

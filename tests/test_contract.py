"""Driver contract: entry() runs; every SQL-checked query matches its DuckDB oracle."""

import math

import pytest

from conftest import SF_CHECK

import __spark_entry__ as E

SQL_NAMES = sorted(E.oracle_sql())


def test_entry(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["table", "split", "rows", "columns"]


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    return v


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", SQL_NAMES)
def test_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_CHECK)
    res = duck.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    assert _canon(df.columns, [tuple(r) for r in df.collect()]) == _canon(ocols, res.fetchall())


ROWS_ONLY = sorted(set(E.queries()) - set(E.oracle_sql()))


@pytest.mark.parametrize("name", ROWS_ONLY)
def test_rows_only_queries_run(spark, name):
    from conftest import SF_SMALL
    df = E.queries()[name](spark, SF_SMALL)
    assert df.count() > 0
    assert len(df.columns) == len(set(df.columns))

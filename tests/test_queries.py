"""Every registered query that SQL can express gives the rows that DuckDB gives, on the tables of 0.01."""

import collections

import pandas as pd
import pytest

from conftest import connected

from quarrylight.jobs import registry

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def sf():
    return SF


@pytest.fixture(scope="module")
def duck():
    return connected(SF)


def rows(df):
    names = sorted(df.columns)
    plain = lambda v: None if pd.isna(v) else int(v) if isinstance(v, float) and v == int(v) else v
    return names, collections.Counter(tuple(map(plain, r)) for r in df[names].astype(object).values.tolist())


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_matches_duckdb(spark, duck, sf, name):
    assert rows(registry.queries()[name](spark, sf).toPandas()) == rows(duck.execute(registry.oracle_sql()[name]).df())


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - set(registry.oracle_sql())))
def test_other_queries_give_rows(spark, sf, name):
    assert registry.queries()[name](spark, sf).count() > 0


def test_entry_imports_and_registers():
    import __spark_entry__ as entry

    assert set(registry.queries()) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())

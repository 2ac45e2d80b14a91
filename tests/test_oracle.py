"""Every query with SQL gives DuckDB's rows over sf0.001; the others are in ``test_plain``."""

import decimal

import duckdb
import pytest

from storyloom import registry
from tests import test_plain

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.sql("set timezone='UTC'")
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    return con


def plain(v):
    return float(v) if isinstance(v, decimal.Decimal) else round(v, 6) if isinstance(v, float) else v


def rows_of(rows):
    return sorted(tuple(repr(plain(v)) for v in r) for r in rows)


@pytest.mark.parametrize("name", sorted(set(registry.queries()) & set(registry.oracle_sql())))
def test_same_rows(spark, duck, name):
    df = registry.queries()[name](spark, DATA)
    want = duck.sql(registry.oracle_sql()[name])
    cols = sorted(want.columns)
    assert sorted(df.columns) == cols
    assert rows_of(df.select(*cols).collect()) == rows_of(want.select(*[f'"{c}"' for c in cols]).fetchall())


def test_queries_without_sql_have_plain_tests():
    assert set(registry.queries()) - set(registry.oracle_sql()) == test_plain.TESTED


def test_entry_imports_without_the_optional_part():
    import __spark_entry__ as e

    assert set(registry.queries()) <= set(e.queries())
    assert set(registry.oracle_sql()) <= set(e.oracle_sql())

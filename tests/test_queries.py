"""Every registered query against its SQL on the small tables."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from tomelight import oracle, registry

SF = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}

pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="test tables absent")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(registry.queries()) <= set(entry.queries())


@pytest.mark.parametrize("name", list(registry.queries()))
def test_query(spark, duck, name):
    df = registry.queries()[name](spark, SF)
    rows = df.collect()
    assert rows
    sql = oracle.oracle_sql().get(name)
    if sql is None:
        return
    result = duck.execute(sql)
    columns = [d[0] for d in result.description]
    types = {d[0]: str(d[1]) for d in result.description}
    assert sorted(columns) == sorted(df.columns)
    assert {c: TYPES[t] for c, t in df.dtypes} == types
    order = sorted(columns)
    left = sorted((tuple(r[c] for c in order) for r in rows), key=repr)
    at = [columns.index(c) for c in order]
    right = sorted((tuple(r[i] for i in at) for r in result.fetchall()), key=repr)
    zero = lambda row: tuple(0.0 if v == 0 and isinstance(v, float) else v for v in row)
    assert list(map(zero, left)) == list(map(zero, right))


def test_entry(spark):
    assert entry.entry(spark).count() > 0

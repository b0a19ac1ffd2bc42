"""Every registered query against its SQL twin in DuckDB, at sf0.001."""

import os

import duckdb
import pytest

os.environ.setdefault("STRICT", "1")     # exact float comparison, no re-rounding

from tests.conftest import SF001
from tests.oracle_check import TABLES, digest

import __spark_entry__ as entry

SQL = entry.oracle_sql()
TYPE_NAMES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
QUERIES = entry.queries()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    df = QUERIES[name](spark, SF001)
    rows = [tuple(r) for r in df.collect()]
    if name not in SQL:
        assert len(rows) > 0
        return
    rel = con.sql(SQL[name])
    types = dict(zip(rel.columns, (str(t) for t in rel.types)))
    spark_types = {f.name: TYPE_NAMES.get(f.dataType.simpleString(), f.dataType.simpleString())
                   for f in df.schema.fields}
    assert spark_types == types
    cur = con.execute(SQL[name])
    dcols = [c[0] for c in cur.description]
    drows = cur.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(rows) == len(drows)
    assert digest(rows, df.columns)[0] == digest(drows, dcols)[0]


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() == 1000

"""Every registered query against its DuckDB oracle on the sf0.001 tables."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from duckdb_oracle import oracle_queries
from proficio.plans.registry import queries

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem".split()


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return repr(v)


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("|".join(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return c


SPARK_TO_DUCK = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", sorted(oracle_queries()))
def test_query_matches_oracle(spark, con, name):
    df = queries()[name](spark, SF)
    res = con.execute(oracle_queries()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    spark_types = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString()) for f in df.schema.fields}
    assert {d[0]: str(d[1]).upper() for d in res.description} == spark_types
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(ocols, res.fetchall())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "improvement_score" in df.columns


def test_every_query_has_oracle():
    assert set(queries()) == set(oracle_queries())
    assert set(queries()) <= set(E.queries()) and set(oracle_queries()) <= set(E.oracle_sql())

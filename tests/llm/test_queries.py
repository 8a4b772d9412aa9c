"""The registered queries equal their DuckDB SQL on the smallest test tables."""

import os

import duckdb
import pytest

from proficio.llm.oracles import oracle_sql
from proficio.llm.queries import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="needs the driver's test tables")
@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    exp = con.execute(oracle_sql()[name]).df()
    got = queries()[name](spark, SF).toPandas()
    cols = sorted(got.columns)
    assert cols == sorted(exp.columns)
    plain = lambda d: sorted(map(repr, d[cols].astype(object).where(d[cols].notna(), None)
                                 .itertuples(index=False, name=None)))
    assert plain(got) == plain(exp)

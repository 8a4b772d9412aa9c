"""The test-table adaptors: Spark DataFrame form == SQL text form (DuckDB), row for row."""

import duckdb
import pytest

import duckdb_inputs as raw
from proficio.sources.catalog import test_table_catalog as make_catalog

SF = "/root/testdata/sf0.001"
SQL = {
    "demographic": raw.RAW_DEMOGRAPHIC.format(cutoff=""),
    "assessment": raw.RAW_ASSESSMENT,
    "absenteeism": raw.RAW_ABSENTEEISM,
    "school_regions": raw.RAW_REGIONS,
    "school_locations": raw.RAW_LOCATIONS,
}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in "region customer part orders lineitem".split():
        c.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(SQL))
def test_adaptor_matches_sql(spark, con, name):
    df = make_catalog(spark, SF).table(name)
    res = con.execute(SQL[name])
    cols = [d[0] for d in res.description]
    assert cols == df.columns
    assert sorted(map(repr, map(tuple, df.collect()))) == sorted(map(repr, res.fetchall()))


def test_early_extract_matches_sql(spark, con):
    df = make_catalog(spark, SF, cutoff="2000-07-01").table("demographic")
    res = con.execute(raw.RAW_DEMOGRAPHIC.format(
        cutoff="where o_orderdate < timestamp '2000-07-01'"))
    assert sorted(map(repr, map(tuple, df.collect()))) == sorted(map(repr, res.fetchall()))

"""Data checks (failing and passing rows, NULL rules) and seed CSV reading."""

import os

from pyspark.sql import functions as F

from proficio.operators import checks as C
from proficio.session import new_table_path
from proficio.sources.seeds import LOCATIONS_SCHEMA, read_seed


def test_checks(spark):
    df = spark.createDataFrame([("1", 2020, "Low", 50), ("1", 2020, "Bad", 150), (None, 2014, None, None)],
                               "k string, y int, tier string, rate int")
    assert C.not_null(df, "k").count() == 1
    assert [r.k for r in C.unique(df, "k").collect()] == ["1"]          # NULL key ignored
    assert [r.tier for r in C.accepted_values(df, "tier", ["Low"]).collect()] == ["Bad"]  # NULL passes
    assert C.accepted_range(df, "rate", 0, 100).count() == 1             # NULL passes
    assert C.accepted_range(df, "y", 2015, 2030).count() == 1
    parent = spark.createDataFrame([("1",)], "k string")
    assert C.orphans(df, parent, "k").count() == 1                       # NULL key fails
    s = {r.test_name: r.failures for r in C.check_summary(
        df, "m", [C.not_null_check("k"), C.accepted_values_check("tier", ["Low"]),
                  C.accepted_range_check("rate", 0, 100)]).collect()}
    assert s == {"not_null_k": 1, "accepted_values_tier": 1, "accepted_range_rate": 1}


def test_conditional_range(spark):
    df = spark.createDataFrame([(150, True, 50, False), (150, False, 50, False), (None, False, -1, True)],
                               "m int, ms boolean, e int, es boolean")
    assert C.conditional_range(df, [("m", "ms"), ("e", "es")]).count() == 1


def test_seed_csv_quotes_and_text_keys(spark):
    d = new_table_path(spark, "seed")
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, "locations.csv"), "w", encoding="utf-8") as f:
        f.write("organization_code,school_name,address,city,state,zip_code\n")
        f.write('0042,"Mary ""Ms"" Smith ES","1735 ""D"" St., Apt 2",Las Vegas,NV,089101\n')
        f.write("2511,Escuela Nuñez,,Henderson,NV,89002\n")
    got = {r.organization_code: r for r in read_seed(spark, d, LOCATIONS_SCHEMA).collect()}
    assert got["0042"].school_name == 'Mary "Ms" Smith ES'
    assert got["0042"].address == '1735 "D" St., Apt 2' and got["0042"].zip_code == "089101"
    assert got["2511"].school_name == "Escuela Nuñez" and got["2511"].address is None


def test_csv_catalog_reads_text(spark):
    from proficio.sources.catalog import csv_catalog
    d = new_table_path(spark, "raw-csv")
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, "demo.csv"), "w", encoding="utf-8") as f:
        f.write("organization_code,school_name,accountability_year,num_enrolled\n")
        f.write("0042,A,2023-2024,<5\n0043,B,2023-2024,120\n")
    t = csv_catalog(spark, {"demographic": d}).table("demographic")
    assert all(str(f.dataType) == "StringType()" for f in t.schema.fields)
    assert sorted(r.organization_code for r in t.collect()) == ["0042", "0043"]


def test_clustered_layout_sorted_files(spark):
    import glob

    import pyarrow.parquet as pq

    from proficio.plans.registry import models
    from proficio.sources.sinks import write_clustered
    path = new_table_path(spark, "clustered")
    write_clustered(models(spark, "/root/testdata/sf0.001").enrollment_trends(), path,
                    "school_year", ["school_id"])
    folders = glob.glob(os.path.join(path, "school_year=*"))
    assert folders
    for folder in folders:
        files = glob.glob(os.path.join(folder, "*.parquet"))
        assert 1 <= len(files) <= 8                       # few files per year
        for f in files:
            ids = pq.read_table(f, columns=["school_id"]).column(0).to_pylist()
            assert ids == sorted(ids)                     # sorted inside each file


def test_the_hand_written_tests_run_with_the_declared_ones(spark):
    from proficio.params import Params
    from proficio.plans import quality
    from proficio.plans.build import Models
    from proficio.sources.catalog import test_table_catalog

    m = Models(test_table_catalog(spark, "/root/testdata/sf0.001"),
               Params(start_year=1997, current_school_year="2000-2001"), audit=False)
    clean = {(r.model, r.test_name): r.failures for r in quality.test_summary(m).collect()}
    assert len(clean) == 36
    assert clean["enrollment_trends", "orphans_school_id"] == 0
    assert clean["stg_assessment_scores", "conditional_range_pct_proficient"] == 0
    a = m.stg_assessment_scores
    high = F.when((F.col("school_id") == "45") & ~F.col("math_suppressed"), F.lit(140).cast("decimal(38,0)"))
    tables = {"stg_assessment_scores": a.withColumn("math_pct_proficient", F.coalesce(high, "math_pct_proficient")),
              "dim_schools": m.dim_schools.where("school_id <> '100'")}
    bad = {(r.model, r.test_name): r.failures for r in quality.test_summary(m, tables).collect()}
    assert bad["stg_assessment_scores", "conditional_range_pct_proficient"] == \
        a.where("school_id = '45' and not math_suppressed").count() > 0
    assert bad["enrollment_trends", "orphans_school_id"] == m.stg_enrollment.where("school_id = '100'").count() > 0

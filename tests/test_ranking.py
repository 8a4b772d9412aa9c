"""Distributed rank == window rank; top-n ties; latest / precedence dedupe."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from proficio.operators import RankSpec, latest_per_key, rank_columns, topn_per_group


def test_rank_columns_equals_window_rank(spark):
    rnd = random.Random(7)
    rows = []
    for i in range(3000):
        g = rnd.choice(["a", "b", "c", None])
        v = None if rnd.random() < 0.1 else float(rnd.randint(-50, 50)) / 2
        if rnd.random() < 0.3:
            v = 7.0  # a hot value carried by a large share of rows
        rows.append((i, g, v, rnd.randint(0, 20)))
    df = spark.createDataFrame(rows, "id int, g string, v double, w int")
    specs = [RankSpec("r_desc", "v"), RankSpec("r_asc", "w", ascending=True),
             RankSpec("r_grp", "v", partition_by=("g",)),
             RankSpec("r_nf", "v", ascending=True, nulls_last=False)]
    got = rank_columns(df, specs, buckets=8)
    exp = (df.withColumn("e_desc", F.rank().over(Window.orderBy(F.col("v").desc_nulls_last())))
             .withColumn("e_asc", F.rank().over(Window.orderBy(F.col("w").asc_nulls_last())))
             .withColumn("e_grp", F.rank().over(Window.partitionBy("g")
                                                .orderBy(F.col("v").desc_nulls_last())))
             .withColumn("e_nf", F.rank().over(Window.orderBy(F.col("v").asc_nulls_first()))))
    j = got.join(exp.select("id", "e_desc", "e_asc", "e_grp", "e_nf"), "id")
    bad = j.filter((F.col("r_desc") != F.col("e_desc")) | (F.col("r_asc") != F.col("e_asc"))
                   | (F.col("r_grp") != F.col("e_grp")) | (F.col("r_nf") != F.col("e_nf")))
    assert got.count() == 3000
    assert bad.count() == 0


def test_rank_all_null_measure(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "id int, v double")
    got = rank_columns(df, [RankSpec("r", "v")]).collect()
    assert sorted(r.r for r in got) == [1, 1]


def test_topn_keeps_ties(spark):
    rows = [("r", "a", 10.0), ("r", "b", 9.0), ("r", "c", 8.0), ("r", "d", 8.0), ("r", "e", 8.0),
            ("r", "f", 8.0), ("r", "g", 1.0), ("s", "h", None)]
    df = spark.createDataFrame(rows, "region string, school string, v double")
    got = topn_per_group(df, 3, ["region"], [F.col("v").desc_nulls_last()], "rank").collect()
    assert sorted(r.school for r in got if r.region == "r") == ["a", "b", "c", "d", "e", "f"]
    assert {r.rank for r in got if r.school in "cdef"} == {3}


def test_latest_per_key_ties_repeatable(spark):
    rows = [("1", 2020, "Old"), ("1", 2022, "New"), ("2", 2021, "B"), ("2", 2021, "A")]
    df = spark.createDataFrame(rows, "school_id string, school_year int, school_name string")
    got = {r.school_id: r.school_name for r in
           latest_per_key(df, ["school_id"], "school_year", ["school_name"], ["school_name"]).collect()}
    assert got == {"1": "New", "2": "B"}


def test_dedupe_precedence(spark):
    from proficio.plans.marts import school_regions
    rows = [("2093", "Region 1"), ("2093", "Transformation Network"), ("2083", "Region 2"),
            ("2083", "Region 2"), ("9", "Region 3"), ("9", "Region 1"), ("7", "Charter")]
    got = {r.school_id: r.region for r in
           school_regions(spark.createDataFrame(rows, "organization_code string, region string")).collect()}
    assert got == {"2093": "Transformation Network", "2083": "Region 2", "9": "Region 1", "7": "Charter"}


def test_rank_columns_shuffle_join_path(spark):
    """Without any broadcast the ranks join back with a shuffle join: same result."""
    rows = [(i, float(i % 7) if i % 11 else None) for i in range(500)]
    df = spark.createDataFrame(rows, "id int, v double")
    a = rank_columns(df, [RankSpec("r", "v")], buckets=4)
    b = df.withColumn("r", F.rank().over(Window.orderBy(F.col("v").desc_nulls_last())))
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_rank_columns_nan_order(spark):
    rows = [(1, float("nan")), (2, 5.0), (3, None), (4, float("inf")), (5, 5.0)]
    df = spark.createDataFrame(rows, "id int, v double")
    got = rank_columns(df, [RankSpec("d", "v"), RankSpec("a", "v", ascending=True)], buckets=2)
    exp = (df.withColumn("d", F.rank().over(Window.orderBy(F.col("v").desc_nulls_last())))
             .withColumn("a", F.rank().over(Window.orderBy(F.col("v").asc_nulls_last()))))
    assert sorted(map(tuple, got.select("id", "d", "a").collect())) == \
        sorted(map(tuple, exp.select("id", "d", "a").collect()))


def test_hot_narrow_group_is_split(spark):
    from proficio.operators import ranking as R
    rows = [(i, "hot", 1.0 + i / 100000.0) for i in range(2000)]            # narrow range
    rows += [(10000 + i, f"g{i % 5}", float(i)) for i in range(500)]         # wide range
    df = spark.createDataFrame(rows, "id int, g string, v double")
    specs = [RankSpec("r", "v", partition_by=("g",))]
    dv = R._stack(df, list(enumerate(specs)), T.DoubleType()).groupBy("_m", "_g", "_v").agg(F.count(F.lit(1)).alias("_n"))
    b = R._with_bucket(dv, 16, ascending=False, nulls_last=True)
    hot_buckets = b.filter(F.get(F.col("_g"), 0) == "hot").select("_b").distinct().count()
    assert hot_buckets >= 12                       # spread, not one bucket
    got = rank_columns(df, specs, buckets=16)
    exp = df.withColumn("e", F.rank().over(Window.partitionBy("g").orderBy(F.col("v").desc())))
    assert got.join(exp, "id").filter(F.col("r") != F.col("e")).count() == 0


def test_rank_columns_rejects_text_keys(spark):
    df = spark.createDataFrame([(1, "a")], "id int, name string")
    with pytest.raises(TypeError, match="numeric order key"):
        rank_columns(df, [RankSpec("r", "name")])


def test_forty_hot_groups_are_all_split(spark):
    from proficio.operators import ranking as R
    rows = [(g * 1000 + i, f"g{g}", g + i / 10000.0) for g in range(40) for i in range(200)]
    df = spark.createDataFrame(rows, "id int, g string, v double")
    specs = [RankSpec("r", "v", partition_by=("g",))]
    dv = R._stack(df, list(enumerate(specs)), T.DoubleType()).groupBy("_m", "_g", "_v").agg(F.count(F.lit(1)).alias("_n"))
    b = R._with_bucket(dv, 8, ascending=False, nulls_last=True)
    assert b.groupBy("_g").agg(F.countDistinct("_b").alias("n")).where("n < 6").count() == 0
    got = rank_columns(df, specs, buckets=8)
    exp = df.withColumn("e", F.rank().over(Window.partitionBy("g").orderBy(F.col("v").desc())))
    assert got.join(exp, "id").filter(F.col("r") != F.col("e")).count() == 0


def test_large_integers_and_decimals_rank_exactly(spark):
    big = 2 ** 53
    rows = [(1, big + 1, "0.1"), (2, big, "0.10000000000000000001"), (3, big - 1, None), (4, -2 ** 63, "0.1"),
            (5, None, "-3")]
    df = spark.createDataFrame(rows, "id int, v bigint, t string").withColumn("d", F.col("t").cast("decimal(38,20)"))
    got = rank_columns(df, [RankSpec("r", "v"), RankSpec("a", "v", ascending=True), RankSpec("x", "d")], buckets=4)
    assert {r.id: (r.r, r.a, r.x) for r in got.collect()} == \
        {1: (1, 4, 2), 2: (2, 3, 1), 3: (3, 2, 5), 4: (4, 1, 2), 5: (5, 5, 4)}

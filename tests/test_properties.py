"""Property tests: distributed rank == window rank; upsert == dict merge (idempotent)."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from proficio.operators import RankSpec, rank_columns, upsert
from proficio.session import new_table_path

SETTINGS = settings(max_examples=10, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

values = st.one_of(st.none(), st.integers(-5, 5).map(float))
rows_st = st.lists(st.tuples(st.sampled_from(["a", "b", None]), values), min_size=1, max_size=40)


@SETTINGS
@given(rows=rows_st, buckets=st.integers(1, 6), asc=st.booleans())
def test_rank_equals_window(spark, rows, buckets, asc):
    df = spark.createDataFrame([(i, g, v) for i, (g, v) in enumerate(rows)], "id int, g string, v double")
    got = rank_columns(df, [RankSpec("r", "v", ascending=asc),
                            RankSpec("rg", "v", partition_by=("g",), ascending=asc)], buckets=buckets)
    o = F.col("v").asc_nulls_last() if asc else F.col("v").desc_nulls_last()
    exp = (df.withColumn("r", F.rank().over(Window.orderBy(o)))
             .withColumn("rg", F.rank().over(Window.partitionBy("g").orderBy(o))))
    assert sorted(map(tuple, got.select("id", "r", "rg").collect())) == \
        sorted(map(tuple, exp.select("id", "r", "rg").collect()))


batch = st.dictionaries(st.tuples(st.sampled_from("abcd"), st.sampled_from([2021, 2022])),
                        st.integers(0, 9), min_size=1, max_size=6)


@SETTINGS
@given(batches=st.lists(batch, min_size=1, max_size=3))
def test_upsert_is_dict_merge(spark, batches):
    path = new_table_path(spark, "prop-upsert")
    model: dict = {}
    for b in batches:
        src = spark.createDataFrame([(k, y, v) for (k, y), v in b.items()],
                                    "school_id string, school_year int, total int")
        upsert.upsert(spark, path, src, ["school_id", "school_year"], "school_year")
        model.update(b)
    got = {(r.school_id, r.school_year): r.total for r in upsert.read_table(spark, path).collect()}
    assert got == model
    # rerunning the last batch changes nothing
    upsert.upsert(spark, path, src, ["school_id", "school_year"], "school_year")
    again = {(r.school_id, r.school_year): r.total for r in upsert.read_table(spark, path).collect()}
    assert again == model


snap_st = st.dictionaries(st.sampled_from(["1", "2", "3"]), st.sampled_from(["A", "B", None]),
                          max_size=3)


def scd2_model(runs):
    """Expected versions (key, value, first run, closing run or None) of check-strategy SCD-2."""
    versions, current = [], {}
    for r, snap in enumerate(runs):
        for k, i in list(current.items()):
            if k not in snap or versions[i][1] != snap[k]:
                versions[i][3] = r
                del current[k]
        for k, v in snap.items():
            if k not in current:
                versions.append([k, v, r, None])
                current[k] = len(versions) - 1
    return sorted(map(tuple, versions), key=repr)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(runs=st.lists(snap_st, min_size=1, max_size=3))
def test_scd2_matches_model(spark, runs):
    from proficio.operators import scd2
    path = new_table_path(spark, "prop-scd2")
    state = None
    for r, snap in enumerate(runs):
        df = spark.createDataFrame(sorted(snap.items()), "school_id string, school_name string")
        state = scd2.snapshot_run(spark, path, df, ["school_id"], ["school_name"],
                                  F.lit(f"{2000 + r}-01-01 00:00:00"))
    got = sorted(((x.school_id, x.school_name, x.valid_from.year - 2000,
                   None if x.valid_to is None else x.valid_to.year - 2000)
                  for x in state.collect()), key=repr)
    assert got == scd2_model(runs)


rows_kyn = st.lists(st.tuples(st.sampled_from(["k1", "k2", "k3"]), st.integers(2019, 2022),
                              st.sampled_from(["A", "B", "C"])), min_size=1, max_size=30)


@SETTINGS
@given(rows=rows_kyn)
def test_dedupe_operators_equal_row_number(spark, rows):
    from proficio.operators import dedupe_precedence, latest_per_key
    df = spark.createDataFrame(rows, "k string, y int, name string")
    got = {r.k: r.name for r in latest_per_key(df, ["k"], "y", ["name"], ["name"]).collect()}
    w = Window.partitionBy("k").orderBy(F.col("y").desc(), F.col("name").desc())
    exp = {r.k: r.name for r in df.withColumn("rn", F.row_number().over(w))
           .filter("rn = 1").collect()}
    assert got == exp
    prec = F.when(F.col("name") == "B", 1).otherwise(2)
    got2 = {r.k: r.name for r in dedupe_precedence(df, ["k"], prec, ["name"]).collect()}
    w2 = Window.partitionBy("k").orderBy(prec, F.col("name"))
    exp2 = {r.k: r.name for r in df.withColumn("rn", F.row_number().over(w2))
            .filter("rn = 1").collect()}
    assert got2 == exp2

"""Release stream: each file merged once, later releases win, reruns are no-ops."""

from pyspark.sql import functions as F

from proficio.operators import upsert
from proficio.session import new_table_path
from proficio.streaming import merge_releases

RAW = "code string, year_label string, total string, release int"


def to_rows(raw):
    return raw.select(F.col("code").alias("school_id"),
                      F.substring("year_label", 1, 4).cast("int").alias("school_year"),
                      F.col("total").cast("int").alias("total"))


def test_release_stream(spark):
    landing, target = new_table_path(spark, "landing"), new_table_path(spark, "target")
    ckpt = new_table_path(spark, "ckpt")

    def land(rows, sub):
        spark.createDataFrame(rows, RAW).write.parquet(f"{landing}/{sub}")

    def run():
        merge_releases(spark, f"{landing}/*", schema, to_rows, target, ["code", "year_label"],
                       ["school_id", "school_year"], "school_year", checkpoint=ckpt)

    def table():
        return {(r.school_id, r.school_year): r.total for r in upsert.read_table(spark, target).collect()}

    land([("a", "2020-2021", "1", 1), ("b", "2020-2021", "2", 1)], "r1")
    schema = spark.read.parquet(f"{landing}/r1").schema
    run()
    assert table() == {("a", 2020): 1, ("b", 2020): 2}
    # a later release corrects a and adds c; the same key twice in one trigger: newest wins
    land([("a", "2020-2021", "10", 2), ("c", "2021-2022", "3", 2)], "r2")
    land([("c", "2021-2022", "30", 3)], "r3")
    run()
    assert table() == {("a", 2020): 10, ("b", 2020): 2, ("c", 2021): 30}
    run()  # nothing new: no change
    assert table() == {("a", 2020): 10, ("b", 2020): 2, ("c", 2021): 30}


def test_an_older_release_that_lands_late_changes_nothing(spark):
    landing, target = new_table_path(spark, "landing"), new_table_path(spark, "target")
    ckpt = new_table_path(spark, "ckpt")

    def land_and_run(rows, sub):
        spark.createDataFrame(rows, RAW).write.parquet(f"{landing}/{sub}")
        merge_releases(spark, f"{landing}/*", spark.read.parquet(f"{landing}/{sub}").schema, to_rows, target,
                       ["code", "year_label"], ["school_id", "school_year"], "school_year", checkpoint=ckpt)
        return {(r.school_id, r.school_year): r.total for r in upsert.read_table(spark, target).collect()}

    assert land_and_run([("a", "2020-2021", "2", 2)], "r2") == {("a", 2020): 2}
    assert land_and_run([("a", "2020-2021", "1", 1), ("b", "2020-2021", "5", 1), ("c", "2021-2022", "6", 1)], "r1") \
        == {("a", 2020): 2, ("b", 2020): 5, ("c", 2021): 6}
    assert land_and_run([("a", "2020-2021", "3", 3)], "r3")[("a", 2020)] == 3

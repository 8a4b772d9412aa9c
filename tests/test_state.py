"""Incremental upsert and SCD-2 history on literal rows (written to the shared folder)."""

import pytest
from pyspark.sql import functions as F

from proficio.operators import scd2, upsert
from proficio.session import new_table_path

S = "school_id string, school_year int, total int"


def rows(df):
    return sorted(repr(tuple(r)) for r in df.select(*sorted(df.columns)).collect())


def test_upsert(spark):
    path = new_table_path(spark, "t-upsert")
    first = spark.createDataFrame([("a", 2022, 1), ("b", 2022, 2), ("c", 2023, 3), ("d", 2023, 4)], S)
    upsert.upsert(spark, path, first, ["school_id", "school_year"], "school_year")
    # update c, insert e, keep d (same year, not in source), keep 2022 untouched, add a column
    src = spark.createDataFrame([("c", 2023, 30, 1), ("e", 2023, 5, 1)],
                                S + ", new_col int")
    upsert.upsert(spark, path, src, ["school_id", "school_year"], "school_year")
    t = upsert.read_table(spark, path)
    got = {(r.school_id, r.school_year): (r.total, r.new_col) for r in t.collect()}
    assert got == {("a", 2022): (1, None), ("b", 2022): (2, None), ("c", 2023): (30, 1),
                   ("d", 2023): (4, None), ("e", 2023): (5, 1)}
    before = rows(t)
    upsert.upsert(spark, path, src, ["school_id", "school_year"], "school_year")   # rerun
    assert rows(upsert.read_table(spark, path)) == before


def test_upsert_rejects_duplicate_source_keys(spark):
    path = new_table_path(spark, "t-upsert-dup")
    src = spark.createDataFrame([("a", 2022, 1), ("a", 2022, 2)], S)
    with pytest.raises(upsert.DuplicateKeyError):
        upsert.upsert(spark, path, src, ["school_id", "school_year"], "school_year")


D = "school_id string, school_name string"


def run(spark, path, data, at):
    return scd2.snapshot_run(spark, path, spark.createDataFrame(data, D), ["school_id"],
                             ["school_name"], F.lit(at))


def test_scd2_history(spark):
    path = new_table_path(spark, "t-scd2")
    run(spark, path, [("1", "A"), ("2", None), ("3", "C")], "2020-01-01 00:00:00")
    # 1 renamed, 2 null -> value, 3 deleted
    run(spark, path, [("1", "A2"), ("2", "B")], "2021-01-01 00:00:00")
    # 3 re-appears
    st = run(spark, path, [("1", "A2"), ("2", "B"), ("3", "C")], "2022-01-01 00:00:00")
    v = sorted((r.school_id, r.school_name or "", str(r.valid_from)[:4],
                str(r.valid_to)[:4] if r.valid_to else "") for r in st.collect())
    assert v == [("1", "A", "2020", "2021"), ("1", "A2", "2021", ""),
                 ("2", "", "2020", "2021"), ("2", "B", "2021", ""),
                 ("3", "C", "2020", "2021"), ("3", "C", "2022", "")]
    # identical rerun: no version changes
    st2 = run(spark, path, [("1", "A2"), ("2", "B"), ("3", "C")], "2023-01-01 00:00:00")
    assert rows(st2) == rows(st)
    # intervals of one key never overlap
    for k in ("1", "2", "3"):
        iv = sorted((r.valid_from, r.valid_to) for r in st2.filter(F.col("school_id") == k).collect())
        for (a0, a1), (b0, _) in zip(iv, iv[1:]):
            assert a1 is not None and a1 <= b0


def test_scd2_rejects_duplicate_keys(spark):
    path = new_table_path(spark, "t-scd2-dup")
    with pytest.raises(upsert.DuplicateKeyError):
        run(spark, path, [("1", "A"), ("1", "B")], "2020-01-01 00:00:00")
    assert scd2.latest(spark, path)[0] == 0          # nothing committed
    run(spark, path, [("1", "A"), ("2", "B")], "2020-01-01 00:00:00")
    with pytest.raises(upsert.DuplicateKeyError):
        run(spark, path, [("1", "A"), ("2", "C"), ("2", "D")], "2021-01-01 00:00:00")
    n, state = scd2.latest(spark, path)                # the failed run left run 1 intact
    assert n == 1 and state.count() == 2


def test_clean_work_removes_only_old_intermediates(spark):
    from proficio.session import clean_work, stage
    _, old_path = stage(spark.range(2), "clean-old")
    fresh = stage(spark.range(3), "clean-fresh")[0]
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(old_path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).setTimes(p, 0, 0)   # back-date to 1970
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    ckpt = jvm.org.apache.hadoop.fs.Path(new_table_path(spark, "cleantest"))
    fs.mkdirs(ckpt)
    fs.setTimes(ckpt, 0, 0)                          # an old table or stream checkpoint
    gone = clean_work(spark, older_than_hours=24.0)  # nothing of this session is a day old
    old_name = old_path.rstrip("/").split("/")[-1]
    assert [g.rstrip("/").split("/")[-1] for g in gone if "clean-" in g] == [old_name]
    assert fs.exists(ckpt)                           # tables and stream checkpoints are kept
    assert fresh.count() == 3                      # a fresh intermediate is still readable


def test_upsert_keeps_new_columns_of_untouched_rows(spark):
    path = new_table_path(spark, "t-upsert-drift")
    keys = ["school_id", "school_year"]
    upsert.upsert(spark, path, spark.createDataFrame([("a", 2022, 1), ("c", 2023, 3)], S),
                  keys, "school_year")
    upsert.upsert(spark, path, spark.createDataFrame([("c", 2023, 30, 7), ("d", 2023, 4, 8)],
                                                      S + ", new_col int"), keys, "school_year")
    # a later slice without the new column: the untouched row d keeps its value
    upsert.upsert(spark, path, spark.createDataFrame([("c", 2023, 31)], S), keys, "school_year")
    got = {(r.school_id, r.school_year): (r.total, r.new_col)
           for r in upsert.read_table(spark, path).collect()}
    assert got == {("a", 2022): (1, None), ("c", 2023): (31, None), ("d", 2023): (4, 8)}


def test_scd2_keep_runs(spark):
    path = new_table_path(spark, "t-scd2-keep")
    for y in (2020, 2021, 2022):
        st = scd2.snapshot_run(spark, path, spark.createDataFrame([("1", f"A{y}")], D), ["school_id"],
                               ["school_name"], F.lit(f"{y}-01-01 00:00:00"), keep_runs=2)
    assert scd2._runs(spark, path) == [1, 2, 3]
    assert len(scd2._parts(spark, path, [1, 2, 3], "open")) == 2
    assert st.count() == 3                         # the newest state still holds the whole history


def test_scd2_composite_key(spark):
    path = new_table_path(spark, "t-scd2-composite")
    sch = "district string, school_id string, school_name string"

    def go(rows, at):
        return scd2.snapshot_run(spark, path, spark.createDataFrame(rows, sch),
                                 ["district", "school_id"], ["school_name"], F.lit(at))
    go([("d1", "1", "A"), ("d2", "1", "B")], "2020-01-01 00:00:00")
    st = go([("d1", "1", "A"), ("d2", "1", "B2")], "2021-01-01 00:00:00")
    v = sorted((r.district, r.school_name, r.valid_to is None) for r in st.collect())
    assert v == [("d1", "A", True), ("d2", "B", False), ("d2", "B2", True)]


def test_empty_inputs(spark):
    path = new_table_path(spark, "t-empty-upsert")
    upsert.upsert(spark, path, spark.createDataFrame([], S), ["school_id", "school_year"], "school_year")
    assert not upsert.table_exists(spark, path)
    upsert.upsert(spark, path, spark.createDataFrame([("a", 2022, 1)], S),
                  ["school_id", "school_year"], "school_year")
    upsert.upsert(spark, path, spark.createDataFrame([], S), ["school_id", "school_year"], "school_year")
    assert upsert.read_table(spark, path).count() == 1
    hist = new_table_path(spark, "t-empty-scd2")
    assert run(spark, hist, [], "2020-01-01 00:00:00").count() == 0
    assert run(spark, hist, [("1", "A")], "2021-01-01 00:00:00").count() == 1


def test_work_paths_are_under_the_session_checkpoint_dir(spark):
    from proficio.session import materialize, shared_dir
    base = spark.conf.get("spark.checkpoint.dir")
    assert shared_dir(spark) == base
    assert new_table_path(spark, "x").startswith(base.rstrip("/") + "/proficio/")
    files = materialize(spark.range(2), "where").inputFiles()
    assert files and all(base.rstrip("/").removeprefix("file:") in f for f in files)


def _session(master, settings):
    """A stand-in with what shared_dir asks of a session; its core settings can't be changed, as in Spark 4."""
    from types import SimpleNamespace as N

    made = []

    def refuse(*_):
        raise ValueError("CANNOT_MODIFY_CONFIG")
    context = N(master=master, getConf=lambda: settings, setCheckpointDir=lambda d: made.append(f"{d}/one-session"),
                getCheckpointDir=lambda: made[0] if made else None)
    hadoop = N(get=lambda key, default: default)
    conf = N(get=lambda key, default=None: settings.get(key, default), set=refuse)
    return N(conf=conf, sparkContext=context, _jsc=N(hadoopConfiguration=lambda: hadoop))


def test_a_cluster_takes_the_configured_folder_without_a_file_systems_name():
    s = _session("spark://cluster:7077", {"spark.checkpoint.dir": "/mnt/shared"})
    assert new_table_path(s, "x").startswith("/mnt/shared/proficio/x-")


def test_without_a_configured_folder():
    import os

    from proficio.session import shared_dir
    own = {"spark.sql.warehouse.dir": f"file:{os.path.abspath('spark-warehouse')}"}
    local = _session("local[2]", own)
    assert os.path.isdir(shared_dir(local)) and shared_dir(local) == shared_dir(local)
    for master in ("spark://cluster:7077", "local-cluster[2,1,1024]"):
        s = _session(master, {"spark.sql.warehouse.dir": "hdfs://n/warehouse"})
        assert shared_dir(s) == "hdfs://n/warehouse"
    with pytest.raises(RuntimeError):
        shared_dir(_session("spark://cluster:7077", own))


def _names(spark, path):
    return upsert._children(spark, path)


def _mkdirs(spark, path):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(p)


def test_leftovers_of_a_dead_first_load_are_no_table(spark):
    from proficio.params import Params
    from proficio.plans.incremental import run_enrollment_trends

    class FakeModels:
        p = Params()

        def enrollment_trends(self, incremental=False, extra=()):
            df = spark.createDataFrame([("a", 2022, 1), ("a", 2023, 2)], S)
            return df.where("school_year = 2023") if incremental else df

    path = new_table_path(spark, "t-leftover")
    _mkdirs(spark, f"{path}/_temporary/0")
    assert not upsert.table_exists(spark, path)
    run_enrollment_trends(spark, path, FakeModels())
    assert sorted(r.school_year for r in upsert.read_table(spark, path).collect()) == [2022, 2023]
    torn = new_table_path(spark, "t-torn")
    spark.createDataFrame([("a", 2022, 1)], S).write.parquet(f"{torn}/school_year=2022")
    with pytest.raises(upsert.UncommittedTableError):
        run_enrollment_trends(spark, torn, FakeModels())
    run_enrollment_trends(spark, torn, FakeModels(), full_refresh=True)
    assert upsert.read_table(spark, torn).count() == 2


def test_null_keys_are_rejected(spark):
    path = new_table_path(spark, "t-null")
    with pytest.raises(upsert.NullKeyError):
        upsert.upsert(spark, path, spark.createDataFrame([(None, 2022, 1)], S), ["school_id", "school_year"],
                      "school_year")
    with pytest.raises(upsert.NullKeyError):
        upsert.upsert(spark, path, spark.createDataFrame([("a", None, 1)], S), ["school_id", "school_year"],
                      "school_year")
    assert not upsert.table_exists(spark, path)
    hist = new_table_path(spark, "t-null-scd2")
    for data in ([(None, "A")], [("1", "A")], [("1", "A"), (None, "B")]):
        if any(k is None for k, _ in data):
            with pytest.raises(upsert.NullKeyError):
                run(spark, hist, data, "2020-01-01 00:00:00")
        else:
            run(spark, hist, data, "2020-01-01 00:00:00")
    assert scd2.latest(spark, hist)[1].count() == 1


def test_a_torn_snapshot_run_is_ignored_and_replaced(spark):
    path = new_table_path(spark, "t-torn-scd2")
    run(spark, path, [("1", "A"), ("2", "B"), ("3", "C")], "2020-01-01 00:00:00")
    spark.createDataFrame([("9", "Z")], D).write.parquet(f"{path}/snapshot_run=2/state=open")
    n, state = scd2.latest(spark, path)
    assert n == 1 and state.count() == 3
    st = run(spark, path, [("1", "A2"), ("2", "B")], "2021-01-01 00:00:00")
    assert sorted((r.school_id, r.school_name, r.valid_to is None) for r in st.collect()) == \
        [("1", "A", False), ("1", "A2", True), ("2", "B", True), ("3", "C", False)]


def test_a_run_does_not_write_closed_history_again(spark):
    path = new_table_path(spark, "t-volume")
    for i in range(5):
        st = run(spark, path, [("1", f"A{i}"), ("2", "B")], f"{2020 + i}-01-01 00:00:00")
    sizes = [spark.read.parquet(f"{path}/snapshot_run={n}").count() for n in scd2._runs(spark, path)]
    # each later run closes one version and opens one; what stays open is not written again
    assert sizes == [2, 2, 2, 2, 2] and st.count() == 6


def test_scd_ids_tell_keys_and_times_apart(spark):
    sch = "a string, b string, v string"
    ids = set()
    for data, at in (([("a|b", "c", "x"), ("a", "b|c", "x"), ("", "b", "x")], "2020-01-01 00:00:00"),
                     ([("a|b", "c", "x")], "2020-01-01 00:00:00.5")):
        st = scd2.scd2_apply(None, spark.createDataFrame(data, sch), ["a", "b"], ["v"], F.lit(at))
        ids |= {r.scd_id for r in st.collect()}
    assert len(ids) == 4


def _files(spark, path):
    """Data files below a local table folder, with their times."""
    import os
    found = {}
    for base, _, names in os.walk(path.removeprefix("file:")):
        found.update({os.path.join(base, n): os.stat(os.path.join(base, n)).st_mtime_ns for n in names if n.endswith(".parquet")})
    return found


def test_a_merge_rewrites_only_the_buckets_that_change(spark):
    path = new_table_path(spark, "t-buckets")
    keys = ["school_id", "school_year"]
    all_rows = [(str(i), y, i) for i in range(400) for y in (2022, 2023)]
    upsert.upsert(spark, path, spark.createDataFrame(all_rows, S), keys, "school_year", buckets=16)
    before = _files(spark, path)
    assert len(before) == 32                                    # one file a (year, bucket)
    # the whole year comes again, three rows differ and one is new
    later = [(k, y, -1 if k in ("7", "70", "170") else v) for k, y, v in all_rows if y == 2023] + [("new", 2023, 1)]
    upsert.upsert(spark, path, spark.createDataFrame(later, S), keys, "school_year")
    after = _files(spark, path)
    new, gone = set(after) - set(before), set(before) - set(after)
    assert len(new) == len(gone) <= 4 and all("school_year=2023" in f for f in new)
    assert all(after[f] == before[f] for f in set(after) & set(before))
    got = {(r.school_id, r.school_year): r.total for r in upsert.read_table(spark, path).collect()}
    assert got == {**{(k, y): v for k, y, v in all_rows}, **{(k, y): v for k, y, v in later}}
    # the same slice once more writes no file
    upsert.upsert(spark, path, spark.createDataFrame(later, S), keys, "school_year")
    assert _files(spark, path) == after


def test_the_schema_lies_beside_the_table(spark):
    path = new_table_path(spark, "t-meta")
    keys = ["school_id", "school_year"]
    upsert.upsert(spark, path, spark.createDataFrame([("a", 2022, 1)], S), keys, "school_year")
    upsert.upsert(spark, path, spark.createDataFrame([("b", 2023, 2, "x")], S + ", note string"), keys, "school_year")
    t = upsert.read_table(spark, path)
    assert t.columns == ["school_id", "school_year", "total", "note"] and dict(t.dtypes)["school_year"] == "int"
    assert {r.school_id: (r.total, r.note) for r in t.collect()} == {"a": (1, None), "b": (2, "x")}
    assert "mergeSchema" not in open(upsert.__file__).read().split("def _adopted")[0]
    # a table of another writer is put in buckets by its first merge
    plain = new_table_path(spark, "t-plain")
    spark.createDataFrame([("a", 2022, 1), ("b", 2022, 2)], S).write.partitionBy("school_year").parquet(plain)
    assert upsert.read_table(spark, plain).count() == 2
    upsert.upsert(spark, plain, spark.createDataFrame([("b", 2022, 5)], S), keys, "school_year")
    assert {r.school_id: r.total for r in upsert.read_table(spark, plain).collect()} == {"a": 1, "b": 5}


def test_audit_times_are_those_of_the_last_change(spark):
    path = new_table_path(spark, "t-audit")
    keys, kind = ["school_id", "school_year"], S + ", updated_at string"
    for at, total in (("t1", 1), ("t2", 1), ("t3", 2)):
        upsert.upsert(spark, path, spark.createDataFrame([("a", 2022, total, at), ("b", 2022, 9, at)], kind), keys, "school_year",
                      audit=["updated_at"])
        got = {r.school_id: r.updated_at for r in upsert.read_table(spark, path).collect()}
        assert got == {"a": "t1" if total == 1 else "t3", "b": "t1"}


def test_an_unchanged_snapshot_writes_no_version(spark):
    path = new_table_path(spark, "t-log")
    run(spark, path, [("1", "A"), ("2", None)], "2020-01-01 00:00:00")
    st = run(spark, path, [("1", "A"), ("2", None)], "2021-01-01 00:00:00")
    assert scd2._runs(spark, path) == [1, 2]
    assert not any(scd2._parts(spark, path, [2], s) for s in ("open", "closed"))
    assert rows(st) == rows(scd2.read_run(spark, path, 1)) and st.count() == 2


def test_compaction_keeps_the_kept_runs_readable(spark):
    path = new_table_path(spark, "t-compact")
    states = {}
    for i, data in enumerate(([("1", "A"), ("2", "B")], [("1", "A2"), ("2", "B")], [("2", "B")], [("1", "A3"), ("2", "B"), ("3", "C")],
                              [("1", "A3"), ("3", "C")])):
        states[i + 1] = rows(run(spark, path, data, f"{2020 + i}-01-01 00:00:00"))
    scd2.compact(spark, path, ["school_id"], keep_runs=2)
    assert [n for n in (1, 2, 3, 4, 5) if scd2._parts(spark, path, [n], "open")] == [4]
    assert {n: rows(scd2.read_run(spark, path, n)) for n in (4, 5)} == {n: states[n] for n in (4, 5)}
    assert rows(scd2.current(spark, path, 5, ["school_id"])) == rows(scd2.current(spark, path, 5))
    st = run(spark, path, [("1", "A3"), ("3", "C2")], "2030-01-01 00:00:00")
    assert sorted(r.school_name for r in st.where("valid_to is null").collect()) == ["A3", "C2"]
    whole = rows(st)
    scd2.compact(spark, path, ["school_id"])
    assert rows(scd2.latest(spark, path)[1]) == whole


def test_a_clustered_table_keeps_its_cut_points(spark):
    """Later writes to the table compute their input once; the slices are about even, also for keys with one beginning."""
    from proficio.sources import sinks
    path = new_table_path(spark, "t-cuts")
    computed = spark.sparkContext.accumulator(0)

    def tally(parts):
        for part in parts:
            computed.add(part.num_rows)
            yield part

    df = spark.range(8000).selectExpr("cast(id % 2 as int) as year", "concat('school-00000000', lpad(id, 6, '0')) as school")
    df = df.mapInArrow(tally, df.schema)
    for _ in range(2):
        computed.value = 0
        sinks.write_clustered(df, path, "year", ["school"], files_per_partition=4)
        assert computed.value == 8000
        files = _files(spark, path)
        assert 2 <= len(files) <= 8 and spark.read.parquet(path).distinct().count() == 8000
    import json
    from proficio.session import read_text
    points = json.loads(read_text(spark, f"{path}/{sinks.CUTS}"))["points"]
    assert len(points) == 3
    sizes = [df.where(sinks._slice_of("school", df.schema["school"].dataType, points) == i).count() for i in range(4)]
    assert min(sizes) > 1500
    sinks.write_clustered(df.limit(0), new_table_path(spark, "t-cuts-empty"), "year", ["school"])

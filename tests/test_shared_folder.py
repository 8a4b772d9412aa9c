"""Queries that write to the shared folder, in a session of executors of their own that names no such folder.

The session has no ``spark.checkpoint.dir`` and a temporary folder that each process resolves for itself; its rows
are held against those of the tests' session on the same small tables.
"""

import importlib.util
import json
import os
import subprocess
import sys
from datetime import datetime, timedelta
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

import __spark_entry__ as E

REPO = Path(E.__file__).parent
QUERIES = [
    "clustered_write_readback",
    "global_rank",
    "global_rank_bucketed",
    "incremental_full_refresh",
    "incremental_upsert",
    "project_build",
    "regional_rank",
    "regional_rank_bucketed",
    "scd2_check_snapshot",
    "scd_school_directory",
    "school_improvement",
    "scorecard_extract",
    "seed_csv_roundtrip",
    "stream_release_upsert",
    "typed_key_load",
]


def _tables(at):
    """Small tables of the schema of the test tables, made by formula."""
    os.makedirs(at)
    day = [datetime(1992, 1, 3) + timedelta(days=37 * i % 2500) for i in range(1600)]
    kinds = [("region", 5, {"r_regionkey": (pa.int32(), lambda i: i), "r_name": (pa.string(), lambda i: f"R{i}")}),
             ("nation", 25, {"n_nationkey": (pa.int32(), lambda i: i), "n_name": (pa.string(), lambda i: f"NATION_{i}"),
                             "n_regionkey": (pa.int32(), lambda i: i % 5)}),
             ("customer", 60, {"c_custkey": (pa.int64(), lambda i: i), "c_name": (pa.string(), lambda i: f"Customer#{i:09}"),
                               "c_nationkey": (pa.int32(), lambda i: i * 7 % 25),
                               "c_acctbal": (pa.float64(), lambda i: i * 163.25 % 9000),
                               "c_mktsegment": (pa.string(), lambda i: ("FURNITURE", "MACHINERY", "BUILDING")[i % 3])}),
             ("supplier", 20, {"s_suppkey": (pa.int64(), lambda i: i), "s_name": (pa.string(), lambda i: f"Supplier#{i:09}"),
                               "s_nationkey": (pa.int32(), lambda i: i * 3 % 25),
                               "s_acctbal": (pa.float64(), lambda i: i * 311.5 % 9000)}),
             ("part", 40, {"p_partkey": (pa.int64(), lambda i: i), "p_name": (pa.string(), lambda i: f"large ring {i}"),
                           "p_brand": (pa.string(), lambda i: f"Brand#{i % 9}"),
                           "p_type": (pa.string(), lambda i: ("LARGE", "SMALL")[i % 2]),
                           "p_size": (pa.int32(), lambda i: i % 50 + 1),
                           "p_retailprice": (pa.float64(), lambda i: 900.0 + i)}),
             ("orders", 600, {"o_orderkey": (pa.int64(), lambda i: i), "o_custkey": (pa.int64(), lambda i: i * 11 % 60),
                              "o_orderstatus": (pa.string(), lambda i: "FOP"[i % 3]),
                              "o_totalprice": (pa.float64(), lambda i: 1000 + i * 757.25 % 90000),
                              "o_orderdate": (pa.timestamp("us"), lambda i: day[i]),
                              "o_orderpriority": (pa.string(), lambda i: ("1-URGENT", "3-MEDIUM", "5-LOW")[i % 3])}),
             ("lineitem", 1600, {"l_orderkey": (pa.int64(), lambda i: i * 7 % 600), "l_partkey": (pa.int64(), lambda i: i % 40),
                                 "l_suppkey": (pa.int64(), lambda i: i * 13 % 20), "l_linenumber": (pa.int32(), lambda i: i % 7 + 1),
                                 "l_quantity": (pa.float64(), lambda i: float(i % 50 + 1)),
                                 "l_extendedprice": (pa.float64(), lambda i: 900 + i * 31.75 % 80000),
                                 "l_discount": (pa.float64(), lambda i: i % 11 / 100),
                                 "l_tax": (pa.float64(), lambda i: i % 9 / 100),
                                 "l_returnflag": (pa.string(), lambda i: "NRA"[i % 3]),
                                 "l_linestatus": (pa.string(), lambda i: "OF"[i % 2]),
                                 "l_shipdate": (pa.timestamp("us"), lambda i: day[i])}),
             ("events", 200, {"event_id": (pa.int64(), lambda i: i),
                              "ts": (pa.timestamp("us"), lambda i: datetime(2024, 1, 1) + timedelta(hours=i)),
                              "user_id": (pa.int64(), lambda i: i % 30),
                              "event_type": (pa.string(), lambda i: ("error", "view", "click")[i % 3]),
                              "value": (pa.float64(), lambda i: i * 1.5), "props": (pa.string(), lambda i: f'{{"k": {i}}}')})]
    for name, n, columns in kinds:
        pq.write_table(pa.table({c: pa.array([f(i) for i in range(n)], kind) for c, (kind, f) in columns.items()}),
                       f"{at}/{name}.parquet")
    return at


def _rows(df):
    return sorted(str(tuple(r)) for r in df.collect())


def _run(tables, to):
    """In a process of its own: the rows of every query, or its error."""
    from pyspark.sql import SparkSession
    spark = SparkSession.builder.config(map={
        "spark.master": "local-cluster[2,1,1024]", "spark.executor.memory": "768m", "spark.driver.host": "127.0.0.1",
        "spark.sql.shuffle.partitions": "4", "spark.sql.session.timeZone": "UTC", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false"}).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    found = {"the setting": spark.sparkContext.getConf().get("spark.checkpoint.dir")}
    for name in QUERIES:
        try:
            found[name] = _rows(E.queries()[name](spark, tables))
        except Exception as x:
            found[name] = f"{type(x).__name__}: {str(x)[:200]}"
    Path(to).write_text(json.dumps(found))
    spark.stop()


@pytest.fixture(scope="module")
def tables(tmp_path_factory):
    return _tables(f"{tmp_path_factory.mktemp('small')}/t")


@pytest.fixture(scope="module")
def unset(tables, tmp_path_factory):
    at = tmp_path_factory.mktemp("unset")
    for d in ("conf", "cwd/.tmp", "home/work", "local"):
        (at / d).mkdir(parents=True)
    for p in Path(importlib.util.find_spec("pyspark").origin).parent.iterdir():  # executors work below Spark's home
        if p.name not in ("work", "conf"):
            (at / "home" / p.name).symlink_to(p)
    env = {k: v for k, v in os.environ.items() if not k.startswith(("SPARK_", "PYSPARK_"))} | {
        "SPARK_CONF_DIR": f"{at}/conf", "SPARK_HOME": f"{at}/home", "SPARK_LOCAL_DIRS": f"{at}/local", "SPARK_SCALA_VERSION": "2.13",
        "PYSPARK_PYTHON": sys.executable, "PYTHONPATH": f"{REPO}:{REPO}/tests", "TMPDIR": "/proc/self/cwd/.tmp"}
    subprocess.run([sys.executable, "-c", f"import test_shared_folder as t; t._run({tables!r}, '{at}/found')"], cwd=at / "cwd",
                   env=env, check=True, timeout=600)
    return json.loads((at / "found").read_text())


@pytest.mark.parametrize("name", QUERIES)
def test_rows_without_a_named_folder(spark, tables, unset, name):
    assert unset["the setting"] is None
    rows = _rows(E.queries()[name](spark, tables))
    assert rows and unset[name] == rows

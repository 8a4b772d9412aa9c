"""Session helpers: building a session and finding the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SCRATCH = "scratch"


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "proficio") -> SparkSession:
    """Return the active session or build one.

    On a cluster the master and memory come from spark-submit; locally
    (tests, bench) a ``local[N]`` master is used.  Adaptive execution is
    kept on so shuffle partitions are coalesced and skewed join
    partitions split at run time.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    b = (b.config("spark.ui.enabled", "false")
          .config("spark.ui.showConsoleProgress", "false")
          .config("spark.sql.adaptive.enabled", "true")
          .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
          .config("spark.sql.adaptive.skewJoin.enabled", "true")
          .config("spark.sql.session.timeZone", "UTC"))
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder for checkpoints and written tables.

    Read from ``spark.checkpoint.dir`` (or the context's checkpoint dir).
    Without one, executors of their own share the warehouse (on a cluster of
    several machines only a configured one), and a local session gets a fresh
    temporary folder, by its real path; a cluster session without either is a
    configuration error, because a machine-local folder is not visible to
    other executors.
    The folder that the setting names is taken as shared: a path without a
    file system's name may be a mount that all machines see, and Spark itself
    warns when it lies on a local disk of a cluster.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not d:
        cp = spark.sparkContext.getCheckpointDir()
        if cp:
            d = os.path.dirname(cp.rstrip("/"))
    if not d:
        master, warehouse = spark.sparkContext.master, spark.conf.get("spark.sql.warehouse.dir")
        configured = warehouse.removeprefix("file:").rstrip("/") != os.path.abspath("spark-warehouse")
        if master == "local" or master.startswith("local["):
            d = os.path.realpath(tempfile.mkdtemp(prefix="proficio-"))
        elif configured or master.startswith("local-cluster["):
            d = warehouse
        else:
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/S3/...)")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


def new_table_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared folder for a written table (kept until it is dropped)."""
    base = shared_dir(spark).rstrip("/")
    return f"{base}/proficio/{name}-{uuid.uuid4().hex[:12]}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path for an intermediate, in the folder that :func:`clean_work` empties."""
    base = shared_dir(spark).rstrip("/")
    return f"{base}/proficio/{SCRATCH}/{name}-{uuid.uuid4().hex[:12]}"


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a staging table folder (any Hadoop file system)."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def read_text(spark: SparkSession, path: str) -> str | None:
    """The text of a small file of any Hadoop file system, or None if it does not exist."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file whole: under a name of its own first, then renamed over the old one in one step."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(conf)
    part = jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex[:12]}")
    stream = fs.create(part)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    full = fs.makeQualified(p)
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(full.toUri(), conf).rename(fs.makeQualified(part), full, options)


def clean_work(spark: SparkSession, older_than_hours: float = 24.0) -> list[str]:
    """Delete this library's intermediate tables older than ``older_than_hours``.

    Intermediates behind a returned DataFrame (summary, rank tables, staged
    inputs) live in ``<spark.checkpoint.dir>/proficio/scratch/``; nothing else
    is touched.  Run this between jobs (never while a job may still read them).
    Returns the deleted paths.
    """
    import time

    base = f"{shared_dir(spark).rstrip('/')}/proficio/{SCRATCH}"
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(base)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return []
    cutoff = (time.time() - older_than_hours * 3600) * 1000
    gone = []
    for st in fs.listStatus(p):
        if st.getModificationTime() < cutoff:
            fs.delete(st.getPath(), True)
            gone.append(st.getPath().toString())
    return gone


def stage(df: DataFrame, name: str = "stage") -> tuple[DataFrame, str]:
    """Write ``df`` as Parquet in the shared folder; return (re-read DataFrame, path)."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path), path


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Cut lineage: write ``df`` as Parquet in the shared folder and read it back.

    Used where an intermediate is read several times (bounds, ranking) so it
    is computed once; the written files survive the loss of an executor and
    give the planner real size statistics.  (A reliable ``checkpoint()``
    without persist would compute the input twice.)
    """
    return stage(df, name)[0]

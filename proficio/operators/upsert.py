"""Incremental upsert into a partitioned Parquet table (MERGE on a composite key).

The partition column is part of the key, so a row never moves between
partitions.  Inside a partition value rows lie in key buckets (a hash of the
rest of the key), and a merge rewrites only the buckets that hold a row that
differs: the source is compared with the stored rows of its partition values,
column by column, and for the buckets with new or changed rows the other rows
are kept, the new ones added (new columns allowed: old rows read NULL), and
just these folders replaced (dynamic partition overwrite).  So what a run
writes follows the changed keys, not the year.  Rows absent from the source
are never deleted, and a source that changes nothing writes nothing.

Beside the data, in ``_table/meta.json``, lie the table's schema and the
number of buckets.  Readers pass that schema on, so no footers are merged; a
new column is entered there before the first row with it is written.

The source slice and the changed rows are computed once into staging tables,
which are deleted after the commit.  The new files replace the old folders
when all tasks have ended, so a lost executor only repeats tasks, which read
the old files.  One writer per table at a time.

A table counts as present only when a completed job left its ``_SUCCESS``
marker in it: the folder that a dead first load leaves behind is loaded again
from the start, and data without a marker stops the run.  Keys must not be
NULL (a NULL never equals the stored NULL, so a rerun would add rows).
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from proficio.session import drop_path, read_text, stage, write_text

BUCKET_COL = "key_bucket"
#: Key buckets of a partition value in a new table: about the largest value's bytes / 256 MB.
BUCKETS = 8
META = "_table/meta.json"


class DuplicateKeyError(ValueError):
    pass


class NullKeyError(ValueError):
    pass


class UncommittedTableError(RuntimeError):
    pass


def _children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder of any Hadoop file system (none if it does not exist)."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return [st.getPath().getName() for st in fs.listStatus(p)] if fs.exists(p) else []


def is_committed(spark: SparkSession, path: str) -> bool:
    """True when a completed write left its ``_SUCCESS`` marker in the folder."""
    return "_SUCCESS" in _children(spark, path)


def table_exists(spark: SparkSession, path: str) -> bool:
    """True when a committed table lies at ``path``.

    Left-overs of a write that never completed (``_temporary``) are no table;
    data files or partitions without a marker raise, they are never replaced
    silently.
    """
    names = _children(spark, path)
    if "_SUCCESS" in names:
        return True
    if any(not n.startswith(("_", ".")) for n in names):
        raise UncommittedTableError(f"{path} holds data that no completed job has committed; "
                                    "inspect it, then rebuild with a full refresh")
    return False


def folders(spark: SparkSession, path: str, partition_col: str, values, buckets: dict | None = None) -> list[str]:
    """Folders of the listed partition values that exist under ``path``, or of the listed buckets of each."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    unescape = jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    wanted = {str(v): v for v in values}
    out = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if not st.isDirectory() or not name.startswith(partition_col + "="):
            continue
        value = unescape(name.split("=", 1)[1])
        if value not in wanted:
            continue
        if buckets is None:
            out.append(st.getPath().toString())
            continue
        inside = set(_children(spark, st.getPath().toString()))
        out += [f"{st.getPath().toString()}/{BUCKET_COL}={b}" for b in sorted(buckets[wanted[value]])
                if f"{BUCKET_COL}={b}" in inside]
    return out


def read_meta(spark: SparkSession, path: str) -> dict | None:
    """The table's stored schema and layout, or None for a table that another writer made."""
    text = read_text(spark, f"{path.rstrip('/')}/{META}")
    return None if text is None else json.loads(text)


def _write_meta(spark: SparkSession, path: str, schema: T.StructType, partition_col: str, keys: Sequence[str],
                buckets: int) -> None:
    meta = {"schema": schema.jsonValue(), "partition_col": partition_col, "keys": list(keys), "buckets": buckets}
    write_text(spark, f"{path.rstrip('/')}/{META}", json.dumps(meta))


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields if f.name != BUCKET_COL])


def _read(spark: SparkSession, path: str, meta: dict, parts: Sequence[str] = ()) -> DataFrame:
    """The table, or some of its folders, under its stored schema (with ``BUCKET_COL``)."""
    schema = T.StructType.fromJson(meta["schema"]).add(BUCKET_COL, T.IntegerType())
    reader = spark.read.schema(schema).option("basePath", path)
    return reader.parquet(*(parts or [path]))


def read_table(spark: SparkSession, path: str, parts: Sequence[str] = ()) -> DataFrame:
    """Read a table, or some of its folders, under the schema stored beside it: columns that old files lack are NULL."""
    meta = read_meta(spark, path)
    if meta is None:
        return spark.read.option("basePath", path).parquet(*(parts or [path])).drop(BUCKET_COL)
    names = [f["name"] for f in meta["schema"]["fields"]]
    return _read(spark, path, meta, parts).select(*names)


def _bucket(keys: Sequence[str], partition_col: str, buckets: int) -> Column:
    own = [F.col(k) for k in keys if k != partition_col]
    return F.pmod(F.xxhash64(*own), F.lit(buckets)).cast("int") if own else F.lit(0)


def _layout(df: DataFrame, partition_col: str, keys: Sequence[str]) -> DataFrame:
    """One task a (partition value, bucket), rows in the order of the key: a hash exchange, so the input is computed
    once, a large partition value has as many writers as buckets, and every folder gets one file."""
    order = [partition_col, BUCKET_COL, *[k for k in keys if k != partition_col]]
    return df.repartition(partition_col, BUCKET_COL).sortWithinPartitions(*order)


def full_refresh(df: DataFrame, path: str, partition_col: str, keys: Sequence[str] = (), buckets: int = BUCKETS) -> None:
    """Rebuild the whole table (static overwrite: every old partition is removed)."""
    spark = df.sparkSession
    rows = df.withColumn(BUCKET_COL, _bucket(keys, partition_col, buckets))
    (_layout(rows, partition_col, keys).write.mode("overwrite").option("partitionOverwriteMode", "static")
     .partitionBy(partition_col, BUCKET_COL).parquet(path))
    _write_meta(spark, path, _nullable(df.schema), partition_col, keys, buckets)


def upsert(spark: SparkSession, path: str, src: DataFrame, keys: Sequence[str],
           partition_col: str, buckets: int = BUCKETS, audit: Sequence[str] = ()) -> None:
    """MERGE ``src`` into the table at ``path`` on ``keys`` (first run: create it with ``buckets`` key buckets).

    ``audit``: columns that do not count as a change (a build time); a row
    keeps its old value of them until another column of it changes.
    """
    if partition_col not in keys:
        raise ValueError("the partition column must be part of the key")
    if BUCKET_COL in src.columns:
        raise ValueError(f"the source must not have a column {BUCKET_COL!r}")
    src, src_path = stage(src, "upsert-source")
    try:
        _merge(spark, path, src, keys, partition_col, buckets, audit)
    finally:
        drop_path(spark, src_path)


def touched_partitions(src: DataFrame, keys: Sequence[str], partition_col: str) -> list:
    """Partition values present in ``src``; raises on a NULL or duplicate key.

    One action: key counts (partial aggregate), then the largest count per
    partition value -- one row per partition value reaches the driver.
    """
    per_key = src.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    null = F.lit(False)
    for k in keys:
        null = null | F.col(k).isNull()
    rows = (per_key.groupBy(partition_col)
            .agg(F.max("_n").alias("_max"), F.max(null).alias("_null")).collect())
    if any(r["_null"] for r in rows):
        raise NullKeyError(f"NULL in the source keys ({', '.join(keys)})")
    bad = [r[0] for r in rows if r["_max"] > 1]
    if bad:
        raise DuplicateKeyError(f"duplicate source keys in {partition_col}={bad[0]}")
    return [r[0] for r in rows]


def _adopted(spark: SparkSession, path: str, keys: Sequence[str], partition_col: str, buckets: int) -> dict:
    """The meta of a table; one without it (another writer's) is rewritten in buckets first."""
    meta = read_meta(spark, path)
    if meta is None:
        rows, staged = stage(spark.read.option("mergeSchema", "true").parquet(path).drop(BUCKET_COL), "upsert-adopted")
        full_refresh(rows, path, partition_col, keys, buckets)
        drop_path(spark, staged)
        meta = read_meta(spark, path)
    return meta


def changed_rows(src: DataFrame, stored: DataFrame, keys: Sequence[str], audit: Sequence[str] = ()) -> DataFrame:
    """The rows of ``src`` that ``stored`` lacks or holds with another value in any column (NULL equals NULL).

    A column that one side lacks counts as NULL there.
    """
    values = [c for c in dict.fromkeys([*stored.columns, *src.columns]) if c not in keys and c not in audit]
    old = stored.select(*[F.col(k).alias(f"_o_{k}") for k in keys], F.lit(True).alias("_stored"),
                        *[F.col(c).alias(f"_o_{c}") for c in values if c in stored.columns])
    on = F.lit(True)
    for k in keys:
        on = on & (F.col(k) == F.col(f"_o_{k}"))
    same = F.col("_stored").isNotNull()
    for c in values:
        new = F.col(c) if c in src.columns else F.lit(None)
        same = same & (new.eqNullSafe(F.col(f"_o_{c}")) if c in stored.columns else new.isNull())
    return src.join(old, on, "left").where(~same).select(*src.columns)


def _merge(spark: SparkSession, path: str, src: DataFrame, keys: Sequence[str], partition_col: str, buckets: int,
           audit: Sequence[str]) -> None:
    touched = touched_partitions(src, keys, partition_col)
    if not touched:
        return  # empty source: nothing to merge, and no empty table is created
    if not table_exists(spark, path):
        full_refresh(src, path, partition_col, keys, buckets)
        return
    meta = _adopted(spark, path, keys, partition_col, buckets)
    known = T.StructType.fromJson(meta["schema"])
    new = [f for f in _nullable(src.schema).fields if f.name not in known.names]
    if new:  # readers may see the column before its first row, never a row whose column they don't know
        known = T.StructType([*known.fields, *new])
        _write_meta(spark, path, known, partition_col, meta["keys"], meta["buckets"])
        meta = read_meta(spark, path)
    types = {f.name: f.dataType for f in known.fields}
    rows = (src.select(*[F.col(c).cast(types[c]).alias(c) for c in src.columns])
            .withColumn(BUCKET_COL, _bucket(keys, partition_col, meta["buckets"])))
    # only the folders of the source's partition values are listed and read
    parts = folders(spark, path, partition_col, touched)
    if not parts:  # only new partitions: the staged source is the whole slice
        _overwrite(rows, path, partition_col, keys)
        return
    match = [*keys, BUCKET_COL]
    changed, changed_path = stage(changed_rows(rows, _read(spark, path, meta, parts), match, audit), "upsert-changed")
    try:
        found: dict = {}
        for r in changed.select(partition_col, BUCKET_COL).distinct().collect():  # a row a folder at most
            found.setdefault(r[0], set()).add(r[1])
        if not found:
            return
        old = folders(spark, path, partition_col, found, found)
        merged = changed
        if old:
            keep = _read(spark, path, meta, old).join(changed.select(*match), match, "left_anti")
            merged = keep.unionByName(changed, allowMissingColumns=True)
        _overwrite(merged, path, partition_col, keys)
    finally:
        drop_path(spark, changed_path)


def _overwrite(df: DataFrame, path: str, partition_col: str, keys: Sequence[str]) -> None:
    """Replace only the (partition value, bucket) folders present in ``df`` (dynamic partition overwrite)."""
    (_layout(df, partition_col, keys).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(partition_col, BUCKET_COL).parquet(path))

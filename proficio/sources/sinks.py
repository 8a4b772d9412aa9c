"""Table writers: full rebuild, clustered layout, CSV extract."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from proficio.session import drop_path, read_text, stage, write_text

#: Slices of the sort key in a clustered table, hence files of a partition value: about its bytes / 256 MB.
SLICES = 8
#: Rows whose keys are kept to find the cut points.
SKETCH_ROWS = 10_000
CUTS = "_table/cuts.json"


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Full rebuild of a table (Parquet, static overwrite: the old files are removed when
    the write starts, so readers must not read the table during a rebuild)."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def cut_points(df: DataFrame, col: str, slices: int, sketch_rows: int = SKETCH_ROWS) -> list[str]:
    """Up to ``slices - 1`` values, as text, that cut the rows' ``col`` into slices of about equal rows.

    The sketch is the keys of rows drawn at random, about ``sketch_rows`` of
    them however many there are; no more reach the driver.  ``df`` is read
    twice, so it should be a written table.
    """
    key = F.col(col)
    share = min(1.0, sketch_rows / max(df.count(), 1))
    kept = df.where((F.rand(7) <= share) & key.isNotNull()).select(key.alias("k")).orderBy("k")
    kept = kept.select(F.col("k").cast("string").alias("k"))
    keys = [r["k"] for r in kept.collect()]
    return list(dict.fromkeys(keys[len(keys) * i // slices] for i in range(1, slices))) if keys else []


def _slice_of(col: str, kind: T.DataType, points: Sequence[str]) -> Column:
    """How many cut points are at or below the value (0 for NULL)."""
    if not points:
        return F.lit(0)
    below = F.filter(F.array(*[F.lit(p).cast(kind) for p in points]), lambda x: x <= F.col(col))
    return F.greatest(F.size(below), F.lit(0))


def write_clustered(df: DataFrame, path: str, partition_col: str,
                    sort_cols: Sequence[str], files_per_partition: int = SLICES) -> None:
    """Clustered layout: one folder per ``partition_col`` value, rows sorted inside.

    A folder's rows are dealt by slices of the first sort column, so even a
    large partition value has several writers and few files, and min/max
    statistics on the sort columns let readers skip files and row groups.
    The slices' cut points are stored beside the table and used again by
    later writes to it, whose input is computed once; the first write stages
    its input, takes the cut points from there and writes from there.
    """
    spark = df.sparkSession
    place = f"{path.rstrip('/')}/{CUTS}"
    stored = json.loads(read_text(spark, place) or "null")
    column, staged = sort_cols[0], None
    kind = df.schema[column].dataType
    if not stored or (stored["column"], stored["slices"]) != (column, files_per_partition):
        df, staged = stage(df, "clustered-input")
        stored = {"column": column, "slices": files_per_partition, "points": cut_points(df, column, files_per_partition)}
    slice_col = "_slice"
    while slice_col in df.columns:
        slice_col = "_" + slice_col
    try:
        (df.withColumn(slice_col, _slice_of(column, kind, stored["points"]))
           .repartition(partition_col, slice_col).sortWithinPartitions(partition_col, *sort_cols).drop(slice_col)
           .write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(partition_col).parquet(path))
        write_text(spark, place, json.dumps(stored))
    finally:
        if staged:
            drop_path(spark, staged)


def write_csv_extract(df: DataFrame, path: str, drop: Sequence[str] = ()) -> None:
    """Publication extract: CSV with header, written by the executors."""
    (df.drop(*drop).write.mode("overwrite").option("header", "true")
       .option("quote", '"').option("escape", '"').csv(path))

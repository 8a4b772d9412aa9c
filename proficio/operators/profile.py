"""Table profile (column types and non-NULL counts), head / tail, column selection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def table_profile(df: DataFrame) -> DataFrame:
    """One row per column: (position, column_name, data_type, non_null, rows).

    All counts come from one aggregation pass (partial counts per task,
    one row to the final stage).
    """
    fields = df.schema.fields
    counts = df.agg(F.count(F.lit(1)).alias("_rows"),
                    *[F.count(F.col(f"`{f.name}`")).alias(f"_c{i}") for i, f in enumerate(fields)])
    rows = F.array(*[F.struct(F.lit(i + 1).cast("long").alias("position"),
                              F.lit(f.name).alias("column_name"),
                              F.lit(f.dataType.simpleString()).alias("data_type"),
                              F.col(f"_c{i}").alias("non_null"))
                     for i, f in enumerate(fields)])
    return counts.select(F.inline(rows), F.col("_rows").alias("rows"))


def head_tail(df: DataFrame, order_by: Sequence[str], n: int = 5) -> DataFrame:
    """First and last ``n`` rows by ``order_by`` (DataFrame rows have no order of their own).

    Each side is a top-n (TakeOrderedAndProject): every task keeps its own n
    rows, so only n rows per task reach the final merge.
    """
    first = df.orderBy(*[F.col(c).asc() for c in order_by]).limit(n).withColumn("part", F.lit("head"))
    last = df.orderBy(*[F.col(c).desc() for c in order_by]).limit(n).withColumn("part", F.lit("tail"))
    return first.unionByName(last)


def select_filter(df: DataFrame, columns: Sequence[str], keep: Column | None = None) -> DataFrame:
    """Keep the listed columns, and only rows where ``keep`` is true."""
    out = df if keep is None else df.filter(keep)
    return out.select(*columns)

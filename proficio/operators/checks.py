"""Data-quality checks.  Each returns the failing rows: an empty result passes.

NULL rules follow the usual test semantics: ``accepted_values`` and
``accepted_range`` let NULL pass, ``unique`` ignores NULL keys,
``orphans`` fails a NULL key (it can never match a parent).
``check_summary`` evaluates many row-level checks of one table in a single
aggregation pass and reports the failing count of each; a ``Watcher`` counts
them as metrics of the job that writes the table anyway, without a pass of
their own.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def not_null(df: DataFrame, col: str) -> DataFrame:
    return df.filter(F.col(col).isNull())


def unique(df: DataFrame, cols: str | Sequence[str]) -> DataFrame:
    """Key values that occur more than once, with their count (``n_records``)."""
    keys = [cols] if isinstance(cols, str) else list(cols)
    present = F.lit(True)
    for k in keys:
        present = present & F.col(k).isNotNull()
    return (df.filter(present).groupBy(*keys).agg(F.count(F.lit(1)).alias("n_records"))
              .filter(F.col("n_records") > 1))


def accepted_values(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    return df.filter(~F.col(col).isin(*values))


def accepted_range(df: DataFrame, col: str, lo=None, hi=None) -> DataFrame:
    c = F.col(col)
    cond = F.lit(False)
    if lo is not None:
        cond = cond | (c < lo)
    if hi is not None:
        cond = cond | (c > hi)
    return df.filter(cond)


def orphans(child: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None) -> DataFrame:
    """Child rows whose key has no parent (NULL keys included)."""
    pk = parent_key or key
    p = parent.select(F.col(pk).alias("_pk"))
    return child.join(p, F.col(key) == F.col("_pk"), "left_anti")


def conditional_range(df: DataFrame, pairs: Sequence[tuple[str, str]], lo=0, hi=100) -> DataFrame:
    """Rows where an unsuppressed value lies outside [lo, hi].

    pairs: (value column, suppression flag column).
    """
    return df.filter(conditional_range_check("", pairs, lo, hi).fails)


@dataclass(frozen=True)
class RowCheck:
    """A row-level test: ``fails`` is true on a failing row (NULL = pass)."""
    name: str
    column: str
    fails: Column


def not_null_check(col: str) -> RowCheck:
    return RowCheck(f"not_null_{col}", col, F.col(col).isNull())


def accepted_values_check(col: str, values: Sequence) -> RowCheck:
    return RowCheck(f"accepted_values_{col}", col, ~F.col(col).isin(*values))


def accepted_range_check(col: str, lo=None, hi=None) -> RowCheck:
    c = F.col(col)
    cond = F.lit(False)
    if lo is not None:
        cond = cond | (c < lo)
    if hi is not None:
        cond = cond | (c > hi)
    return RowCheck(f"accepted_range_{col}", col, cond)


def conditional_range_check(name: str, pairs: Sequence[tuple[str, str]], lo=0, hi=100) -> RowCheck:
    """:func:`conditional_range` as a row-level test of several columns."""
    cond = F.lit(False)
    for value, flag in pairs:
        v = F.col(value)
        cond = cond | (~F.col(flag) & ((v < lo) | (v > hi)))
    return RowCheck(name, ", ".join(value for value, _ in pairs), cond)


def check_summary(df: DataFrame, model: str, checks: Sequence[RowCheck]) -> DataFrame:
    """(model, test_name, column_name, failures) for all checks, one pass over ``df``."""
    counts = df.agg(*[F.count_if(F.coalesce(c.fails, F.lit(False))).alias(f"_c{i}")
                      for i, c in enumerate(checks)])
    rows = F.array(*[F.struct(F.lit(c.name).alias("test_name"), F.lit(c.column).alias("column_name"),
                              F.col(f"_c{i}").cast("long").alias("failures"))
                     for i, c in enumerate(checks)])
    return counts.select(F.lit(model).alias("model"), F.inline(rows))


SUMMARY = "model string, test_name string, column_name string, failures bigint"


class Watcher:
    """Row checks counted while tables are written.

    ``watch`` returns the table with its failing rows counted on the way, as
    observed metrics: one number a check reaches the driver when the first
    job over the returned DataFrame has ended.  Watch a table right where it
    is written, above every shuffle of its plan: metrics of a result stage
    count each partition once, however often its tasks were run; those below
    a shuffle may count a lost and repeated task twice.
    """

    def __init__(self):
        self._watched: list[tuple[str, Sequence[RowCheck], Observation]] = []

    def watch(self, df: DataFrame, model: str, checks: Sequence[RowCheck]) -> DataFrame:
        if not checks:
            return df
        seen = Observation()
        self._watched.append((model, checks, seen))
        return df.observe(seen, *[F.count_if(F.coalesce(c.fails, F.lit(False))).alias(f"c{i}") for i, c in enumerate(checks)])

    def rows(self) -> list[tuple[str, str, str, int]]:
        """(model, test_name, column_name, failures) of every watched check; each table must have been written."""
        return [(model, c.name, c.column, int(seen.get[f"c{i}"]))
                for model, checks, seen in self._watched for i, c in enumerate(checks)]

    def summary(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.rows(), SUMMARY)


def run_through(df: DataFrame) -> None:
    """Compute every row of ``df`` and keep none (for a watched table that nobody reads)."""
    df.write.format("noop").mode("overwrite").save()

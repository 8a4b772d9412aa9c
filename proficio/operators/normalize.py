"""Min-max normalisation against bounds of the whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def minmax_bounds(df: DataFrame, col: str) -> DataFrame:
    """One row (min_<col>, max_<col>): a global partial aggregate."""
    return df.agg(F.min(col).alias("_lo"), F.max(col).alias("_hi"))


def minmax_normalize(df: DataFrame, col: str, out: str) -> DataFrame:
    """``(x - min) / (max - min)`` as DOUBLE; NULL when max == min.

    The bounds are a one-row aggregate joined to every row (broadcast nested
    loop join of exactly one row), so they are never collected to the driver.
    """
    b = minmax_bounds(df, col)
    x = F.col(col).cast("double")
    rng = F.nullif(F.col("_hi").cast("double") - F.col("_lo").cast("double"), F.lit(0.0))
    return (df.crossJoin(F.broadcast(b))
              .withColumn(out, (x - F.col("_lo").cast("double")) / rng)
              .drop("_lo", "_hi"))

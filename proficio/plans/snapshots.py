"""History snapshots: school directory names, and any checked attribute over releases."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from proficio.operators.scd2 import snapshot_run


def school_directory_snapshot(spark: SparkSession, path: str, dim: DataFrame, run_at) -> DataFrame:
    """One run of the school directory history (key school_id, checks school_name)."""
    return snapshot_run(spark, path, dim.select("school_id", "school_name"), ["school_id"],
                        ["school_name"], run_at)


def release_history(spark: SparkSession, path: str, releases: Sequence[tuple[DataFrame, object]],
                    keys: Sequence[str], check_cols: Sequence[str]) -> DataFrame:
    """Apply snapshot runs in release order; return the final history.

    releases: (snapshot DataFrame, run time) pairs -- one run per yearly release.
    """
    state = None
    for snap, at in releases:
        state = snapshot_run(spark, path, snap, keys, check_cols, F.lit(at))
    return state

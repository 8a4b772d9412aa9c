"""Runs of the incremental enrollment fact (first run, merge runs, full refresh)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession

from proficio.operators import upsert
from proficio.plans.build import Models
from proficio.plans.marts import AUDIT_COL

KEYS = ["school_id", "school_year"]
PARTITION = "school_year"


def run_enrollment_trends(spark: SparkSession, path: str, m: Models, full_refresh: bool = False,
                          extra: Sequence[str] = ()) -> None:
    """One run of ``fct_enrollment_trends``.

    First run or ``full_refresh``: every year is rebuilt (old partitions removed).
    Later runs: only the current school year is computed and MERGEd on
    (school_id, school_year); rows missing from the source stay, new columns
    are appended (older rows read them as NULL).  A row's audit time is that
    of the run that last changed it.
    """
    if full_refresh or not upsert.table_exists(spark, path):
        upsert.full_refresh(m.enrollment_trends(extra=extra), path, PARTITION, KEYS)
    else:
        upsert.upsert(spark, path, m.enrollment_trends(incremental=True, extra=extra), KEYS,
                      PARTITION, audit=[AUDIT_COL])

"""A full project build: every model in dependency order, the snapshot, then the tests.

Each mart is written to ``target/<model>``; downstream models read the
written table (as a reference to a table model does), so no upstream plan is
recomputed.  The staging rows and the YoY intermediate, which several models
read, are written once to the shared folder, so each extract is scanned once.
The declared row tests are counted by the jobs that write the tables; the
build returns the written paths and their summary.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from proficio.operators.checks import run_through
from proficio.operators.upsert import is_committed, read_table
from proficio.params import Params
from proficio.plans import quality
from proficio.plans.build import Models
from proficio.plans.incremental import run_enrollment_trends
from proficio.plans.snapshots import school_directory_snapshot
from proficio.session import materialize
from proficio.sources.catalog import Catalog
from proficio.sources.sinks import write_table


# model name -> Models attribute
TABLE_MODELS = {
    "dim_schools": "dim_schools",
    "fct_school_performance": "school_performance",
    "fct_school_improvement": "school_improvement",
    "fct_school_improvement_yoy": "school_improvement_yoy",
}
TRENDS = "fct_enrollment_trends"
SEEDS = ("school_regions", "school_locations")


def use_seeds(m: Models, target: str) -> None:
    """Point the catalog at the seeds loaded under ``target``, where there are any."""
    for name in SEEDS:
        path = f"{target.rstrip('/')}/seeds/{name}"
        if is_committed(m.catalog.spark, path):
            m.catalog.point(name, path)


def use_built(m: Models, target: str, skip: Sequence[str] = ()) -> dict[str, DataFrame]:
    """Let the models stand for their built tables under ``target``, where these are committed.

    Returns the tables that are no attribute of the models (the trends fact)
    under the names of the declared tests.  ``skip``: models to be computed.
    """
    spark, base = m.catalog.spark, target.rstrip("/")
    for name, attribute in TABLE_MODELS.items():
        if name not in skip and is_committed(spark, f"{base}/{name}"):
            setattr(m, attribute, spark.read.parquet(f"{base}/{name}"))
    if TRENDS in skip or not is_committed(spark, f"{base}/{TRENDS}"):
        return {}
    return {"enrollment_trends": read_table(spark, f"{base}/{TRENDS}")}


@dataclass
class BuildResult:
    paths: dict[str, str] = field(default_factory=dict)
    tests: DataFrame | None = None


def build(spark: SparkSession, catalog: Catalog, params: Params, target: str,
          snapshot_at: Column | None = None, full_refresh: bool = False,
          audit: bool = True) -> BuildResult:
    """Build dimension, facts and snapshot under ``target``; run the declared tests."""
    m = Models(catalog, params, audit=audit)
    use_seeds(m, target)
    res = BuildResult()
    base = target.rstrip("/")
    tests = quality.TestRun(m)

    def write(name: str, df: DataFrame) -> DataFrame:
        path = f"{base}/{name}"
        write_table(tests.watch(df, TABLE_MODELS[name]), path)
        res.paths[name] = path
        return spark.read.schema(df.schema).parquet(path)

    tests.stage_extracts()
    m.dim_schools = write("dim_schools", m.dim_schools)
    trends = f"{base}/{TRENDS}"
    run_enrollment_trends(spark, trends, m, full_refresh=full_refresh)
    res.paths[TRENDS] = trends
    m.school_performance = write("fct_school_performance", m.school_performance)
    m.assessment_yoy = materialize(m.assessment_yoy, "assessment-yoy")
    m.school_improvement_yoy = write("fct_school_improvement_yoy", m.school_improvement_yoy)
    m.school_improvement = write("fct_school_improvement", m.school_improvement)
    snap = f"{base}/scd_school_directory"
    school_directory_snapshot(spark, snap, m.dim_schools,
                              snapshot_at if snapshot_at is not None else F.current_timestamp())
    res.paths["scd_school_directory"] = snap
    # a merge run writes one year of the fact; its tests are about all of them
    fact = read_table(spark, trends)
    run_through(tests.watch(fact, "enrollment_trends"))
    res.tests = tests.summary(m.dim_schools, fact)
    return res

"""The data tests declared on the models and sources, as check operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from proficio.operators import checks as C
from proficio.plans import marts, staging
from proficio.plans.build import Models
from proficio.session import materialize

# Accepted labels of the declared tests.
TIERS = ["Low", "Moderate", "High", "Critical"]
CATEGORIES = ["Consistently Improving", "Consistent but Flat", "Big Gains", "Mixed Progress",
              "Needs Attention"]
DIRECTIONS = ["Up", "Down", "Flat"]
YEAR_RANGE = (2015, 2030)
RATE_RANGE = (0, 100)


# The declared row-level tests: model -> (kind, column, *args); plain data so
# other code (docs, the oracle) can read them without a session.
DECLARED: dict[str, list[tuple]] = {
    "source_demographic": [("not_null", "organization_code"), ("not_null", "school_name"),
                           ("not_null", "accountability_year")],
    "source_assessment": [("not_null", "organization_code"), ("not_null", "school_name"),
                          ("not_null", "school_year")],
    "source_absenteeism": [("not_null", "organization_code"), ("not_null", "school_name"),
                           ("not_null", "accountability_year")],
    "stg_enrollment": [("not_null", "school_id"), ("not_null", "school_year"),
                       ("accepted_range", "school_year", *YEAR_RANGE),
                       ("not_null", "total_enrolled")],
    "stg_attendance": [("not_null", "school_id"), ("not_null", "school_year"),
                       ("accepted_range", "chronic_absenteeism_rate", *RATE_RANGE),
                       ("accepted_values", "absenteeism_tier", TIERS)],
    "stg_assessment_scores": [("not_null", "school_id"), ("not_null", "school_year"),
                              ("not_null", "math_suppressed"), ("not_null", "ela_suppressed")],
    "dim_schools": [("not_null", "school_id"), ("not_null", "school_name")],
    "enrollment_trends": [("not_null", "school_id"), ("not_null", "school_year")],
    "school_performance": [("not_null", "school_id"), ("not_null", "school_year")],
    "school_improvement": [("not_null", "school_id"),
                           ("accepted_values", "improvement_category", CATEGORIES)],
    "school_improvement_yoy": [("not_null", "school_id"), ("not_null", "school_year"),
                               ("accepted_values", "ela_direction", DIRECTIONS),
                               ("accepted_values", "math_direction", DIRECTIONS)],
}


# The two hand-written tests: unsuppressed percentages lie in RATE_RANGE, and every
# enrollment fact row has its school in the dimension.
PERCENTAGES = [("math_pct_proficient", "math_suppressed"), ("ela_pct_proficient", "ela_suppressed")]
CHILD, PARENT, CHILD_KEY = "enrollment_trends", "dim_schools", "school_id"


def _row_check(kind: str, col: str, *args) -> C.RowCheck:
    if kind == "not_null":
        return C.not_null_check(col)
    if kind == "accepted_values":
        return C.accepted_values_check(col, args[0])
    return C.accepted_range_check(col, *args)


def declared_row_checks() -> dict[str, list[C.RowCheck]]:
    """model -> row-level tests (not_null, accepted_values, accepted_range)."""
    checks = {m: [_row_check(*t) for t in tests] for m, tests in DECLARED.items()}
    checks["stg_assessment_scores"].append(
        C.conditional_range_check("conditional_range_pct_proficient", PERCENTAGES, *RATE_RANGE))
    return checks


def model_table(m: Models, name: str, tables: dict[str, DataFrame] | None = None) -> DataFrame:
    if tables and name in tables:
        return tables[name]
    if name.startswith("source_"):
        return m.catalog.table(name[len("source_"):])
    if name == "enrollment_trends":
        return m.enrollment_trends()
    return getattr(m, name)


# extract -> (staging model, its plan)
STAGED = {
    "demographic": ("stg_enrollment", staging.stg_enrollment),
    "absenteeism": ("stg_attendance", staging.stg_attendance),
    "assessment": ("stg_assessment_scores", staging.stg_assessment_scores),
}


class TestRun:
    """The declared tests of a build, counted by the jobs that write its tables.

    Every extract is scanned once: its staging rows are written to the shared
    folder, with the tests of the source and of the staging model counted on
    the way, and all models read them there.
    """

    def __init__(self, m: Models, select: str | None = None):
        self.m, self.select = m, select
        self.checks = declared_row_checks()
        self.watcher = C.Watcher()
        if select and select not in self.checks:
            raise ValueError(f"no declared tests for {select!r}; one of {sorted(DECLARED)}")

    def watch(self, df: DataFrame, model: str) -> DataFrame:
        """``df`` with the model's row tests counted when it is written."""
        return self.watcher.watch(df, model, self.checks.get(model, ()) if self.select in (None, model) else ())

    def stage_extracts(self, tables: dict[str, DataFrame] | None = None) -> None:
        """Write the staging models once, counting the tests of sources and staging; the models read them from now on.

        ``tables`` stand for their models as they are, and are only counted.
        """
        for extract, (model, plan) in STAGED.items():
            raw = self.watch(self.m.catalog.table(extract), f"source_{extract}")
            if tables and model in tables:
                C.run_through(raw)
                C.run_through(self.watch(tables[model], model))
            else:
                setattr(self.m, model, materialize(self.watch(plan(raw, self.m.p), model), model))

    def summary(self, dim: DataFrame | None, child: DataFrame | None) -> DataFrame:
        """(model, test_name, column_name, failures) of every test; all watched tables have been written.

        The two tests across rows, unique and orphans, read the written dimension and fact.
        """
        def counted(bad: DataFrame, model: str, test: str, column: str) -> DataFrame:
            return (bad.agg(F.count(F.lit(1)).cast("long").alias("failures"))
                    .select(F.lit(model).alias("model"), F.lit(test).alias("test_name"),
                            F.lit(column).alias("column_name"), "failures"))

        out = self.watcher.summary(self.m.catalog.spark)
        if self.select in (None, PARENT):
            out = out.unionByName(counted(C.unique(dim, "school_id"), PARENT, "unique_school_id", "school_id"))
        if self.select in (None, CHILD):
            bad = C.orphans(child.select(CHILD_KEY), dim, CHILD_KEY)
            out = out.unionByName(counted(bad, CHILD, f"orphans_{CHILD_KEY}", CHILD_KEY))
        return out


def test_summary(m: Models, tables: dict[str, DataFrame] | None = None,
                 select: str | None = None) -> DataFrame:
    """(model, test_name, column_name, failures) for every declared test, without building anything.

    Runs jobs: each extract is scanned once and its staging rows are written
    to the shared folder; the other models are computed from these (or read
    where ``tables`` or the models already stand for built tables) and only
    counted.  ``select``: the tests of one model alone.
    """
    run = TestRun(m, select)
    given = set(tables or ())
    if select is None:
        run.stage_extracts(tables)
        m.assessment_yoy = materialize(marts.assessment_yoy(m.stg_assessment_scores), "assessment-yoy")
        dim = materialize(run.watch(model_table(m, PARENT, tables), PARENT), PARENT)
        tables = {**(tables or {}), PARENT: dim}
        if PARENT not in given:
            m.dim_schools = dim
        done = {"dim_schools"} | {model for model, _ in STAGED.values()} | {f"source_{x}" for x in STAGED}
    else:
        done = set()
    for model in run.checks:
        if model not in done and select in (None, model):
            C.run_through(run.watch(model_table(m, model, tables), model))
    dim = model_table(m, PARENT, tables) if select in (None, PARENT, CHILD) else None
    child = model_table(m, CHILD, tables) if select in (None, CHILD) else None
    return run.summary(dim, child)

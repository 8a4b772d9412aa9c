"""Marts: school dimension and the four facts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from proficio.functions.metrics import (
    composite_change, composite_mean, rounded, rule_category, safe_ratio,
    weighted_score,
)
from proficio.operators.counts import updown_aggs
from proficio.operators.endpoints import first_last_aggs
from proficio.operators.normalize import minmax_normalize
from proficio.operators.ranking import ROW, RankSpec, dedupe_precedence, latest_per_key, numbered, rank_columns
from proficio.operators.yoy import add_yoy
from proficio.params import Params
from proficio.plans.staging import ENROLLMENT_COUNTS

AUDIT_COL = "updated_at"

# Fixed values of the reference models:
# the region that wins when a school is listed twice, and the label of a school without one
PRIORITY_REGION = "Transformation Network"
UNKNOWN_REGION = "Unknown"
# improvement score = 0.6 * consistency + 0.4 * min-max normalised overall change
SCORE_WEIGHTS = (0.6, 0.4)
# improvement categories, first matching rule wins
CONSISTENT = 0.75
CONSISTENT_GAIN = 5
BIG_GAIN = 10
CATEGORY_LABELS = ("Consistently Improving", "Consistent but Flat", "Big Gains", "Mixed Progress",
                   "Needs Attention")


def _audit(df: DataFrame, audit: bool) -> DataFrame:
    return df.withColumn(AUDIT_COL, F.current_timestamp()) if audit else df


def school_regions(raw_regions: DataFrame) -> DataFrame:
    """One region per school: the priority region first, then the smallest name."""
    r = raw_regions.select(F.col("organization_code").cast("string").alias("school_id"), "region")
    prec = F.when(F.col("region") == PRIORITY_REGION, 1).otherwise(2)
    return dedupe_precedence(r, ["school_id"], prec, ["region"])


def school_locations(raw_locations: DataFrame) -> DataFrame:
    """Locations keyed by school (not deduplicated, like the source)."""
    return raw_locations.select(F.col("organization_code").cast("string").alias("school_id"),
                                "address", "city", "state", "zip_code")


def dim_schools(enrollment: DataFrame, raw_regions: DataFrame, raw_locations: DataFrame,
                audit: bool = True) -> DataFrame:
    """One row per school in the enrollment data: latest name, region, address."""
    latest = latest_per_key(enrollment, ["school_id"], "school_year", ["school_name"],
                            tie_break=["school_name"])
    d = (latest.join(school_regions(raw_regions), "school_id", "left")
               .join(school_locations(raw_locations), "school_id", "left")
               .select("school_id", "school_name",
                       F.coalesce(F.col("region"), F.lit(UNKNOWN_REGION)).alias("region"),
                       "address", "city", "state", "zip_code"))
    return _audit(d, audit)


def enrollment_trends(enrollment: DataFrame, dim: DataFrame, p: Params,
                      incremental: bool = False, audit: bool = True,
                      extra: Sequence[str] = ()) -> DataFrame:
    """Enrollment with demographic split, school x year.

    ``incremental=True`` keeps only the current school year (the slice an
    incremental run merges, see :mod:`proficio.operators.upsert`);
    ``extra`` adds further staging columns (a later model version).
    """
    e = enrollment
    if incremental:
        e = e.filter(F.col("school_year") == p.current_year)
    s = dim.select("school_id", "school_name", "region")
    out = (e.drop("school_name").join(s, "school_id", "left")
            .select("school_id", "school_year", "school_name", "region", "total_enrolled",
                    *ENROLLMENT_COUNTS[:15], *extra))
    return _audit(out, audit)


def school_performance(dim: DataFrame, enrollment: DataFrame, attendance: DataFrame,
                       assessment: DataFrame, audit: bool = True) -> DataFrame:
    """Scorecard, school x year; a school-year needs an attendance row.

    The three facts are stacked and dealt once, by school: the window over a
    school-year and the join to the dimension, which comes last, both work on
    that partitioning.  Attendance rows drive: each passes through the window
    on its own (a repeated one stays repeated, a hot school-year is streamed,
    not collected) and picks up the school-year's enrollment sum and its
    assessment rows, of which the grain allows one; were there more, the row
    is repeated for each, as a left join would.
    """
    scores = ["math_pct_proficient", "ela_pct_proficient", "math_suppressed", "ela_suppressed"]
    rates = ["chronic_absenteeism_rate", "absenteeism_tier"]

    def part(df: DataFrame, **kept) -> DataFrame:
        return df.select("school_id", "school_year", *[c.alias(n) for n, c in kept.items()])

    stacked = (
        part(attendance, _drives=F.lit(True), **{c: F.col(c) for c in rates})
        .unionByName(part(enrollment, _enrolled=F.col("total_enrolled")), allowMissingColumns=True)
        .unionByName(part(assessment, _scores=F.struct(*scores)), allowMissingColumns=True))
    w = Window.partitionBy("school_id", "school_year")
    seen = (stacked.repartition("school_id")
            .withColumns({"total_enrollment": F.sum("_enrolled").over(w), "_all": F.collect_list("_scores").over(w)})
            # a NULL key matches nothing in a join, so neither sum nor scores are its own
            .filter(F.col("_drives"))
            .withColumn("_keyed", F.col("school_year").isNotNull())
            .select("school_id", "school_year", *rates, F.when(F.col("_keyed"), F.col("total_enrollment")).alias("total_enrollment"),
                    F.explode_outer(F.when(F.col("_keyed"), F.col("_all"))).alias("_score")))
    out = (dim.select("school_id", "school_name", "region").join(seen, "school_id", "inner")
              .select("school_id", "school_year", "school_name", "region", "total_enrollment", *rates,
                      F.col("_score.ela_pct_proficient").alias("ela_pct_proficient"),
                      F.col("_score.ela_suppressed").alias("ela_suppressed"),
                      F.col("_score.math_pct_proficient").alias("math_pct_proficient"),
                      F.col("_score.math_suppressed").alias("math_suppressed")))
    return _audit(out, audit)


def assessment_yoy(assessment: DataFrame) -> DataFrame:
    """Unsuppressed ELA / Math / composite per school-year with YoY lags.

    Shared by the summary and the detail fact (one window node, one shuffle).
    """
    a = assessment.select(
        "school_id", "school_name", "school_year",
        F.when(~F.col("ela_suppressed"), F.col("ela_pct_proficient")).alias("ela_pct"),
        F.when(~F.col("math_suppressed"), F.col("math_pct_proficient")).alias("math_pct"))
    a = a.withColumn("composite_pct", composite_mean(["ela_pct", "math_pct"], 1))
    return add_yoy(a, ["school_id"], "school_year",
                   {"ela_pct": "ela", "math_pct": "math", "composite_pct": "composite"},
                   digits=1, prior=("ela", "math"), directions=("ela", "math"))


def school_improvement_yoy(yoy: DataFrame, dim: DataFrame) -> DataFrame:
    """Detail fact, school x year, for schools in the dimension."""
    d = dim.select("school_id", F.col("school_name").alias("_dname"), "region")
    return (yoy.join(d, "school_id", "inner")
               .filter(F.col("school_year").isNotNull())
               .select("school_id", F.col("_dname").alias("school_name"), "region", "school_year",
                       "ela_pct", F.col("ela_prior").alias("ela_prior_year"), "ela_yoy_change",
                       "ela_direction", "math_pct", F.col("math_prior").alias("math_prior_year"),
                       "math_yoy_change", "math_direction", "composite_pct",
                       "composite_yoy_change"))


IMPROVEMENT_RANKS = [
    RankSpec("ela_overall_rank", "ela_overall_change"),
    RankSpec("math_overall_rank", "math_overall_change"),
    RankSpec("composite_overall_rank", "composite_overall_change"),
    RankSpec("consistency_rank", "consistency_score"),
    RankSpec("ela_peak_rank", "ela_peak_yoy"),
    RankSpec("math_peak_rank", "math_peak_yoy"),
    RankSpec("composite_peak_rank", "composite_peak_yoy"),
    RankSpec("overall_improvement_rank", "improvement_score"),
    RankSpec("regional_improvement_rank", "improvement_score", partition_by=("region",)),
]


def improvement_summary(yoy: DataFrame, dim: DataFrame, p: Params) -> DataFrame:
    """Per school: endpoints, overall change, up/down counts, peaks, consistency.

    Endpoints (all years >= start) and the counts (years > start) come from
    one aggregation over the window's output, which is already partitioned
    by school, so no further shuffle is needed for it.
    """
    after = F.col("school_year") > p.start_year
    s = yoy.groupBy("school_id").agg(
        *first_last_aggs("school_year", {"ela_pct": "ela", "math_pct": "math"}),
        *updown_aggs({"ela_yoy_change": "ela", "math_yoy_change": "math",
                      "composite_yoy_change": "composite"}, rows=after, measured=("ela", "math")),
        F.count(F.when(after, F.lit(1))).alias("_rows_after"))
    s = s.filter((F.col("_rows_after") > 0) & F.col("ela_first_pct").isNotNull()
                 & F.col("math_first_pct").isNotNull() & F.col("ela_latest_pct").isNotNull()
                 & F.col("math_latest_pct").isNotNull())
    d = dim.select("school_id", "school_name", "region")
    return s.join(d, "school_id", "inner").select(
        "school_id", "school_name", "region",
        "ela_first_year", "ela_latest_year", "ela_first_pct", "ela_latest_pct",
        rounded(F.col("ela_latest_pct") - F.col("ela_first_pct"), 1).alias("ela_overall_change"),
        "math_first_year", "math_latest_year", "math_first_pct", "math_latest_pct",
        rounded(F.col("math_latest_pct") - F.col("math_first_pct"), 1).alias("math_overall_change"),
        composite_change([("ela_first_pct", "ela_latest_pct"), ("math_first_pct", "math_latest_pct")],
                         1).alias("composite_overall_change"),
        "ela_years_improved", "ela_years_declined", "ela_years_measured",
        "math_years_improved", "math_years_declined", "math_years_measured",
        "composite_years_improved", "composite_years_declined",
        "ela_peak_yoy", "math_peak_yoy", "composite_peak_yoy",
        safe_ratio("composite_years_improved",
                   F.col("composite_years_improved") + F.col("composite_years_declined"),
                   2).alias("consistency_score"))


def improvement_category(consistency: str = "consistency_score",
                         change: str = "composite_overall_change"):
    c, x = F.col(consistency), F.col(change)
    ci, cf, bg, mp, na = CATEGORY_LABELS
    return rule_category([
        ((c >= CONSISTENT) & (x >= CONSISTENT_GAIN), ci),
        (c >= CONSISTENT, cf),
        (x >= BIG_GAIN, bg),
        (x >= 0, mp),
    ], na)


def school_improvement(yoy: DataFrame, dim: DataFrame, p: Params) -> DataFrame:
    """Summary fact, one row per school: growth, consistency, score, nine ranks.

    Building it runs jobs: the summary, the distinct values of the measures
    and their ranks are written (the bounds, the score and the ranking passes
    read the summary again instead of computing it again).  Two joins follow
    the summary, and the one-row bounds.
    """
    combined = numbered(improvement_summary(yoy, dim, p), "improvement-summary")
    scored = minmax_normalize(combined, "composite_overall_change", "_norm")
    scored = scored.withColumn(
        "improvement_score",
        weighted_score([("consistency_score", SCORE_WEIGHTS[0]), ("_norm", SCORE_WEIGHTS[1])],
                       3)).drop("_norm")
    ranked = rank_columns(scored, IMPROVEMENT_RANKS, row_id=ROW)
    cols = [c for c in combined.columns if c != ROW] + ["improvement_score"] + [s.out for s in IMPROVEMENT_RANKS[:7]]
    return ranked.select(*cols, improvement_category().alias("improvement_category"),
                         "overall_improvement_rank", "regional_improvement_rank")

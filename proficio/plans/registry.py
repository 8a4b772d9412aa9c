"""Named queries over the driver's test tables (``(spark, sf_dir) -> DataFrame``).

Each query builds the raw school tables from the test tables through the
adaptors, runs the library's own plan on them, and returns the result with
portable column types (integers BIGINT, fractions DOUBLE) so it can be
compared with the DuckDB oracle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from proficio.functions.cleaning import academic_year, clean_numeric, suppression_flag, tier_label
from proficio.functions.metrics import rounded
from proficio.operators import checks as C
from proficio.operators import upsert as U
from proficio.operators.counts import consistency, updown_aggs
from proficio.operators.endpoints import distinct_rows, first_last
from proficio.operators.normalize import minmax_normalize
from proficio.operators.profile import head_tail, select_filter, table_profile
from proficio.operators.ranking import RankSpec, latest_per_key, rank_columns, topn_per_group
from proficio.params import TEST_PARAMS
from proficio.plans import quality, stories
from proficio.plans.build import Models
from proficio.plans.incremental import run_enrollment_trends
from proficio.plans.marts import AUDIT_COL, improvement_summary, school_regions
from proficio.plans.snapshots import release_history, school_directory_snapshot
from proficio.session import materialize, new_table_path
from proficio.sources.catalog import test_table_catalog
from proficio.sources.seeds import LOCATIONS_SCHEMA, REGIONS_SCHEMA, read_seed, write_seed
from proficio.sources.sinks import write_clustered, write_csv_extract
from proficio.streaming.releases import RELEASE_COL, merge_releases

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def portable(df: DataFrame) -> DataFrame:
    """Integers -> BIGINT, whole decimals -> BIGINT, other decimals/floats -> DOUBLE,
    timestamps -> 'yyyy-MM-dd HH:mm:ss' text (no time-zone or precision ambiguity)."""
    cols = []
    for f in df.schema.fields:
        t = f.dataType
        c = F.col(f"`{f.name}`")
        if isinstance(t, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        elif isinstance(t, T.DecimalType):
            c = c.cast("bigint") if t.scale == 0 else c.cast("double")
        elif isinstance(t, T.FloatType):
            c = c.cast("double")
        elif isinstance(t, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def models(spark: SparkSession, sf_dir: str, cutoff: str | None = None, revised: bool = False,
           shared: bool = False) -> Models:
    year = TEST_PARAMS.current_year if revised else None
    shared_from = TEST_PARAMS.start_year if shared else None
    return Models(test_table_catalog(spark, sf_dir, cutoff, year, shared_from), TEST_PARAMS, audit=False)


def query(name: str):
    def deco(fn):
        REGISTRY[name] = lambda spark, sf_dir: portable(fn(spark, sf_dir))
        REGISTRY[name].__doc__ = fn.__doc__
        return fn
    return deco


# ----------------------------------------------------------- staging / marts
@query("stg_enrollment")
def _stg_enrollment(spark, d):
    """Cleaned enrollment counts (positive totals, years >= start)."""
    return models(spark, d).stg_enrollment


@query("stg_attendance")
def _stg_attendance(spark, d):
    """Absenteeism rate and tier."""
    return models(spark, d).stg_attendance


@query("stg_assessment_scores")
def _stg_assessment(spark, d):
    """D3: proficiency bands and suppression flags."""
    return models(spark, d).stg_assessment_scores


@query("dim_schools")
def _dim(spark, d):
    """Latest name per school, region precedence, address."""
    return models(spark, d).dim_schools


@query("enrollment_trends")
def _trends(spark, d):
    """D5 (full refresh): enrollment fact with school name and region."""
    return models(spark, d).enrollment_trends()


@query("school_performance")
def _perf(spark, d):
    """Scorecard; attendance drives, enrollment and assessment optional."""
    return models(spark, d, shared=True).school_performance


@query("school_improvement")
def _imp(spark, d):
    """D7 (flagship): growth, consistency, improvement score and nine ranks per school."""
    return models(spark, d).school_improvement


@query("school_improvement_yoy")
def _imp_yoy(spark, d):
    """YoY detail fact (prior, change, direction)."""
    return models(spark, d).school_improvement_yoy


# -------------------------------------------------------------------- stories
for _name in ("story_yoy_trends", "story_consistency_top5", "story_single_group",
              "story_breakthroughs_top3", "story_needs_support"):
    def _story(spark, d, _n=_name):
        return models(spark, d).story(_n)
    _story.__doc__ = getattr(stories, _name).__doc__
    query(_name)(_story)




# ------------------------------------------------------- functions on raw text
@query("clean_numeric")
def _clean(spark, d):
    """dirty proficiency text -> whole numbers; tokens and junk -> NULL."""
    raw = models(spark, d).catalog.table("assessment")
    return raw.select("organization_code", F.col("school_year").alias("school_year_label"),
                      F.col("math_pct_proficient").alias("math_raw"),
                      clean_numeric("math_pct_proficient").alias("math_clean"),
                      F.col("ela_pct_proficient").alias("ela_raw"),
                      clean_numeric("ela_pct_proficient").alias("ela_clean"))


@query("suppression_flag")
def _suppressed(spark, d):
    """Suppression flags from the raw text (NULL, '<5', '>95')."""
    raw = models(spark, d).catalog.table("assessment")
    return raw.select("organization_code", F.col("school_year").alias("school_year_label"),
                      F.col("math_pct_proficient").alias("math_raw"),
                      suppression_flag("math_pct_proficient").alias("math_suppressed"),
                      F.col("ela_pct_proficient").alias("ela_raw"),
                      suppression_flag("ela_pct_proficient").alias("ela_suppressed"))


@query("academic_year")
def _academic_year(spark, d):
    """distinct school-year labels of the three extracts and their start year."""
    c = models(spark, d).catalog
    labels = (c.table("demographic").select(F.col("accountability_year").alias("label"))
              .unionByName(c.table("assessment").select(F.col("school_year").alias("label")))
              .unionByName(c.table("absenteeism").select(F.col("accountability_year").alias("label")))
              .distinct())
    return labels.withColumn("school_year", academic_year("label"))


# ------------------------------------------------------------ growth blocks
@query("yoy_change")
def _yoy(spark, d):
    """Prior value, rounded YoY change and direction per school (composite included)."""
    return models(spark, d).assessment_yoy


ENDPOINTS = {"ela_pct": "ela", "math_pct": "math"}


@query("first_last_value")
def _first_last(spark, d):
    """First and latest measured year and value per school (min_by / max_by)."""
    return first_last(models(spark, d).assessment_yoy, ["school_id"], "school_year", ENDPOINTS)


@query("distinct_endpoints")
def _distinct_endpoints(spark, d):
    """The distinct pairs of end points; many schools share theirs."""
    fl = first_last(models(spark, d).assessment_yoy, ["school_id"], "school_year", ENDPOINTS)
    return distinct_rows(fl.drop("school_id"))


CHANGES = {"ela_yoy_change": "ela", "math_yoy_change": "math", "composite_yoy_change": "composite"}


@query("updown_counts")
def _updown(spark, d):
    """A3-A5: years up / down / measured and peak change per school (years after start)."""
    m = models(spark, d)
    y = m.assessment_yoy.filter(F.col("school_year") > m.p.start_year)
    return y.groupBy("school_id").agg(*updown_aggs(CHANGES))


@query("consistency_no_flat")
def _cons_no_flat(spark, d):
    """Rises / (rises + falls) of the composite change (flat years ignored)."""
    m = models(spark, d)
    y = m.assessment_yoy.filter(F.col("school_year") > m.p.start_year)
    return consistency(y, ["school_id"], "composite_yoy_change", include_flat=False)


@query("consistency_with_flat")
def _cons_flat(spark, d):
    """Rises / measured years of the composite change (flat years count)."""
    m = models(spark, d)
    y = m.assessment_yoy.filter(F.col("school_year") > m.p.start_year)
    return consistency(y, ["school_id"], "composite_yoy_change", include_flat=True)


@query("minmax_normalize")
def _minmax(spark, d):
    """Overall composite change scaled by the bounds of all schools."""
    m = models(spark, d)
    s = improvement_summary(m.assessment_yoy, m.dim_schools, m.p)
    return minmax_normalize(s.select("school_id", "composite_overall_change"),
                            "composite_overall_change", "normalized_change")


@query("enrollment_by_school_year")
def _enr_sum(spark, d):
    """A1: total enrollment per school and year (pre-aggregation of the scorecard)."""
    return (models(spark, d).stg_enrollment.groupBy("school_id", "school_year")
            .agg(F.sum("total_enrolled").alias("total_enrollment")))


# ---------------------------------------------------------- ranking blocks
@query("dedupe_precedence")
def _dedupe(spark, d):
    """One region per school, 'Transformation Network' first."""
    return school_regions(models(spark, d).catalog.table("school_regions"))


@query("latest_per_key")
def _latest(spark, d):
    """Name of the latest year per school."""
    return latest_per_key(models(spark, d).stg_enrollment, ["school_id"], "school_year",
                          ["school_name"], tie_break=["school_name"])


@query("global_rank")
def _global_rank(spark, d):
    """rank() of every school-year by composite proficiency, desc, NULLs last."""
    y = models(spark, d).assessment_yoy.select("school_id", "school_year", "composite_pct")
    return rank_columns(y, [RankSpec("composite_rank", "composite_pct")])


@query("regional_rank")
def _regional_rank(spark, d):
    """rank() of school-years within region by composite change, desc, NULLs last."""
    y = models(spark, d).school_improvement_yoy.select("region", "school_id", "school_year",
                                                        "composite_yoy_change")
    return rank_columns(y, [RankSpec("regional_rank", "composite_yoy_change", ("region",))])


@query("topn_per_group")
def _topn(spark, d):
    """Top-3 school-years per region by composite proficiency (ties kept)."""
    y = models(spark, d).school_improvement_yoy.select("region", "school_id", "school_year",
                                                        "composite_pct")
    return topn_per_group(y, 3, ["region"], [F.col("composite_pct").desc_nulls_last()], "rank")


# ------------------------------------------------------------------- checks
@query("check_summary")
def _check_summary(spark, d):
    """Q1-Q4: failing-row count of every declared test (row tests fused per model)."""
    return quality.test_summary(models(spark, d))


# The single checks below are asked what part of the rows, but not all, fails.
@query("check_accepted_range")
def _check_range(spark, d):
    """Q4: enrollment rows whose school year lies outside 1998-2000 (both bounds are crossed)."""
    return C.accepted_range(models(spark, d).stg_enrollment, "school_year", 1998, 2000)


@query("check_accepted_values")
def _check_values(spark, d):
    """Q3: attendance rows with a tier other than Low, Moderate and High."""
    return C.accepted_values(models(spark, d).stg_attendance, "absenteeism_tier", ["Low", "Moderate", "High"])


@query("check_not_null")
def _check_nn(spark, d):
    """Q1: assessment rows whose math percentage did not clean to a number."""
    return C.not_null(models(spark, d).stg_assessment_scores, "math_pct_proficient")


@query("check_unique")
def _check_unique(spark, d):
    """Q2: schools with more than one row in the region seed."""
    return C.unique(models(spark, d).catalog.table("school_regions"), "organization_code")


@query("check_unique_grain")
def _check_grain(spark, d):
    """Q2 on a grain: schools that were in one absenteeism tier in more than one year."""
    return C.unique(models(spark, d).stg_attendance, ["school_id", "absenteeism_tier"])


@query("check_orphans")
def _check_orphans(spark, d):
    """Q5: enrollment rows whose school is not in the dimension of an early extract."""
    dim = models(spark, d, f"{TEST_PARAMS.start_year}-07-01").dim_schools
    rows = models(spark, d).enrollment_trends().select("school_id", "school_year", "total_enrolled")
    return C.orphans(rows, dim, "school_id")


@query("check_conditional_range")
def _check_cond(spark, d):
    """Unsuppressed proficiency outside 10-60."""
    a = models(spark, d).stg_assessment_scores
    bad = C.conditional_range(a, [("math_pct_proficient", "math_suppressed"),
                                  ("ela_pct_proficient", "ela_suppressed")], 10, 60)
    return bad.select("school_id", "school_year", "math_pct_proficient", "ela_pct_proficient")


# ------------------------------------------------- incremental loads, layout
KEY = ["school_id", "school_year"]


def early_cutoff() -> str:
    """An earlier extract of the demographic source: orders before mid current year."""
    return f"{TEST_PARAMS.current_year}-07-01"


@query("incremental_upsert")
def _upsert(spark, d):
    """First run on an early extract (all years), then a run on a later release that
    MERGEs the current-year slice; rows withdrawn from that release are kept."""
    path = new_table_path(spark, "enrollment_trends")
    run_enrollment_trends(spark, path, models(spark, d, early_cutoff()))
    run_enrollment_trends(spark, path, models(spark, d, revised=True))
    return U.read_table(spark, path)


@query("upsert_new_column")
def _upsert_new_col(spark, d):
    """As S6, but the second run's model has a new column (older rows read NULL)."""
    path = new_table_path(spark, "enrollment_trends")
    run_enrollment_trends(spark, path, models(spark, d, early_cutoff()))
    run_enrollment_trends(spark, path, models(spark, d, revised=True), extra=("num_kindergarten",))
    return U.read_table(spark, path)


@query("incremental_full_refresh")
def _full_refresh(spark, d):
    """First run on an early extract, then a full refresh on the full extract."""
    path = new_table_path(spark, "enrollment_trends")
    run_enrollment_trends(spark, path, models(spark, d, early_cutoff()))
    run_enrollment_trends(spark, path, models(spark, d), full_refresh=True)
    return U.read_table(spark, path)


@query("clustered_write_readback")
def _clustered(spark, d):
    """Fact written partitioned by year, sorted by school inside; read back."""
    path = new_table_path(spark, "enrollment_trends_clustered")
    write_clustered(models(spark, d).enrollment_trends(), path, "school_year", ["school_id"])
    return spark.read.parquet(path)


# ------------------------------------------------------------------ history
def _run_at(year: int) -> str:
    return f"{year}-07-01 00:00:00"


@query("scd2_check_snapshot")
def _scd2(spark, d):
    """Yearly releases of attendance tiers applied as SCD-2 snapshot runs."""
    m = models(spark, d)
    years = range(m.p.start_year, m.p.current_year + 2)
    # the staged extract is written once; each yearly release is a slice of it
    att = materialize(m.stg_attendance.select("school_id", "school_year", "absenteeism_tier"),
                      "stg-attendance")
    releases = [(att.filter(F.col("school_year") == y).select("school_id", "absenteeism_tier"),
                 _run_at(y)) for y in years]
    path = new_table_path(spark, "attendance_tier_history")
    return release_history(spark, path, releases, ["school_id"], ["absenteeism_tier"])


@query("scd_school_directory")
def _directory(spark, d):
    """School directory history over two extracts (early, then one with new, renamed and closed schools)."""
    path = new_table_path(spark, "school_directory")
    y = TEST_PARAMS.current_year
    school_directory_snapshot(spark, path, models(spark, d, early_cutoff()).dim_schools,
                              F.lit(_run_at(y)))
    return school_directory_snapshot(spark, path, models(spark, d, revised=True).dim_schools,
                                     F.lit(_run_at(y + 1)))


# ---------------------------------------------------------------- files, profile
@query("seed_csv_roundtrip")
def _seed_roundtrip(spark, d):
    """Locations written as seed CSV and read back with the typed schema."""
    path = new_table_path(spark, "school_locations_csv")
    write_seed(models(spark, d).catalog.table("school_locations"), path)
    return read_seed(spark, path, LOCATIONS_SCHEMA)


@query("typed_key_load")
def _typed_key(spark, d):
    """Region seed read with the key typed as text (no inference)."""
    path = new_table_path(spark, "school_regions_csv")
    write_seed(models(spark, d).catalog.table("school_regions"), path)
    return read_seed(spark, path, REGIONS_SCHEMA)


@query("scorecard_extract")
def _extract(spark, d):
    """Scorecard published as CSV without the audit column; read back typed."""
    m = Models(test_table_catalog(spark, d, shared_from=TEST_PARAMS.start_year), TEST_PARAMS, audit=True)
    df = m.school_performance
    path = new_table_path(spark, "scorecard_extract")
    write_csv_extract(df, path, drop=[AUDIT_COL])
    return spark.read.schema(df.drop(AUDIT_COL).schema).option("header", "true").csv(path)


@query("table_profile")
def _profile(spark, d):
    """Column types and non-NULL counts of the raw assessment extract."""
    return table_profile(models(spark, d).catalog.table("assessment"))


@query("head_tail")
def _head_tail(spark, d):
    """First and last five enrollment rows by (school_id, school_year)."""
    return head_tail(models(spark, d).stg_enrollment, ["school_id", "school_year"], 5)


# Participation that a school must meet in both subjects.  In the test tables a row is
# tested in one of the two subjects, so the two rates add up to 1.
PARTICIPATION = 0.4


@query("ratings_prepare")
def _ratings_prepare(spark, d):
    """Key rating columns of schools meeting the participation in Math and ELA."""
    a = models(spark, d).stg_assessment_scores
    n = F.col("num_students_enrolled")
    met = ((F.col("math_num_tested") >= n * PARTICIPATION)
           & (F.col("ela_num_tested") >= n * PARTICIPATION))
    return select_filter(a, ["school_id", "school_name", "school_year", "num_students_enrolled",
                             "math_pct_proficient", "ela_pct_proficient"], met)




# ---------------------------------------------------------------- streaming
@query("stream_release_upsert")
def _stream(spark, d):
    """S6 as a stream: two releases of the demographic extract land as files; a Structured
    Streaming query loads the first and MERGEs the second over it."""
    from proficio.plans import marts, staging

    landing = new_table_path(spark, "demographic_landing")
    early = models(spark, d, early_cutoff()).catalog.table("demographic")
    full_m = models(spark, d)
    early.withColumn("release", F.lit(1)).write.parquet(f"{landing}/r1")
    full_m.catalog.table("demographic").withColumn("release", F.lit(2)).write.parquet(f"{landing}/r2")
    schema = spark.read.parquet(f"{landing}/r1").schema
    dim = full_m.dim_schools
    target = new_table_path(spark, "enrollment_trends_stream")

    def to_rows(raw):
        stg = staging.stg_enrollment(raw, full_m.p)
        return marts.enrollment_trends(stg, dim, full_m.p, audit=False)

    merge_releases(spark, f"{landing}/*", schema, to_rows, target,
                   ["organization_code", "accountability_year"], KEY, "school_year")
    return U.read_table(spark, target).drop(RELEASE_COL)




# ---------------------------------------------------- filters, labels, means
@query("filter_start_year")
def _filter_start(spark, d):
    """Assessment rows whose school year (from the text label) is >= the start year."""
    m = models(spark, d)
    raw = m.catalog.table("assessment")
    return (raw.select("organization_code", F.col("school_year").alias("school_year_label"),
                       academic_year("school_year").alias("school_year"))
               .filter(F.col("school_year") >= m.p.start_year))


@query("filter_positive_count")
def _filter_positive(spark, d):
    """Demographic rows whose cleaned enrollment parses and is positive."""
    raw = models(spark, d).catalog.table("demographic")
    n = clean_numeric("num_enrolled")
    return (raw.select("organization_code", "accountability_year",
                       F.col("num_enrolled").alias("num_enrolled_raw"), n.alias("total_enrolled"))
               .filter(F.col("total_enrolled").isNotNull() & (F.col("total_enrolled") > 0)))


@query("tier_label")
def _tiers(spark, d):
    """F8: absenteeism tier of every distinct cleaned rate (NULL -> Critical)."""
    raw = models(spark, d).catalog.table("absenteeism")
    rate = clean_numeric("chronic_absenteeism_rate")
    return (raw.select(rate.alias("chronic_absenteeism_rate")).distinct()
               .withColumn("absenteeism_tier", tier_label("chronic_absenteeism_rate")))


@query("avg_change")
def _avg_change(spark, d):
    """Mean YoY change per region and school, rounded to one decimal."""
    y = models(spark, d).school_improvement_yoy
    return y.groupBy("region", "school_name").agg(
        *[rounded(F.avg(c), 1).alias(f"avg_{c}") for c in
          ("ela_yoy_change", "math_yoy_change", "composite_yoy_change")])




# ------------------------------------------------------------- full build
@query("project_build")
def _project_build(spark, d):
    """Full build (dimension, four facts, snapshot) into a fresh target folder, then every declared
    test over it; returns what was written: model, school, year, text and measure of every row, and
    each test's failures."""
    from proficio.plans.project import build
    res = build(spark, test_table_catalog(spark, d), TEST_PARAMS, new_table_path(spark, "build"),
                snapshot_at=F.lit(_run_at(TEST_PARAMS.current_year)))
    none = F.lit(None)
    shown = {"dim_schools": (none, F.col("region"), none),
             "fct_enrollment_trends": (F.col("school_year"), F.col("region"), F.col("total_enrolled")),
             "fct_school_performance": (F.col("school_year"), F.col("absenteeism_tier"), F.col("total_enrollment")),
             "fct_school_improvement": (none, F.col("improvement_category"), F.col("improvement_score")),
             "fct_school_improvement_yoy": (F.col("school_year"), F.col("math_direction"), F.col("composite_pct"))}
    out = res.tests.select(F.col("model").alias("model"), none.cast("string").alias("school_id"),
                           none.cast("bigint").alias("school_year"), F.col("test_name").alias("shown"),
                           F.col("failures").cast("double").alias("measure"))
    for name, (year, text, measure) in shown.items():
        rows = U.read_table(spark, res.paths[name])
        out = out.unionByName(rows.select(
            F.lit(name).alias("model"), "school_id", year.cast("bigint").alias("school_year"),
            text.cast("string").alias("shown"), measure.cast("double").alias("measure")))
    return out


@query("incremental_slice")
def _incremental_slice(spark, d):
    """The rows an incremental run merges -- the current school year of the fact."""
    return models(spark, d).enrollment_trends(incremental=True)




@query("global_rank_bucketed")
def _global_rank_bucketed(spark, d):
    """W6 with few, wide buckets: the same ranks."""
    y = models(spark, d).assessment_yoy.select("school_id", "school_year", "composite_pct")
    return rank_columns(y, [RankSpec("composite_rank", "composite_pct")], buckets=16)


@query("regional_rank_bucketed")
def _regional_rank_bucketed(spark, d):
    """W7 with few, wide buckets: the same ranks within region."""
    y = models(spark, d).school_improvement_yoy.select("region", "school_id", "school_year",
                                                        "composite_yoy_change")
    return rank_columns(y, [RankSpec("regional_rank", "composite_yoy_change", ("region",))],
                        buckets=16)


def queries() -> dict[str, Query]:
    return dict(REGISTRY)

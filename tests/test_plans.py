"""Physical-plan properties the design relies on."""

from proficio.plans.registry import models

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_yoy_single_window_node(spark):
    y = models(spark, SF).assessment_yoy
    p = optimized(y)
    assert p.count("Window [") == 1, p


def test_topn_uses_window_group_limit(spark):
    from proficio.plans import stories
    df = stories.story_consistency_top5(models(spark, SF).school_improvement_yoy)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        p = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "WindowGroupLimit" in p, p


def test_no_python_udf_anywhere(spark):
    m = models(spark, SF)
    for df in (m.school_improvement_yoy, m.school_performance, m.dim_schools):
        p = plan(df)
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p


def test_ranking_has_no_unpartitioned_window_over_rows(spark):
    """The only global windows run over per-bucket totals, never over the ranked rows."""
    from proficio.operators.ranking import RankSpec, ranked_values
    y = models(spark, SF).assessment_yoy.select("school_id", "school_year", "composite_pct")
    p = optimized(ranked_values(y, [RankSpec("r", "composite_pct")])[0])
    for line in p.splitlines():
        if "Window [" in line:
            assert "_m" in line.split("Window [")[1], line  # every window is partitioned by spec


def test_scan_prunes_columns(spark):
    p = plan(models(spark, SF).stg_attendance)
    scans = [l for l in p.splitlines() if "FileScan parquet" in l and "lineitem" in l]
    assert scans and all("l_extendedprice" not in s for s in scans)


def test_summary_aggregates_on_window_partitioning(spark):
    """The endpoint/up-down aggregation reuses the window's hash partitioning (no exchange
    between them), and the join to the dimension adds no exchange on the summary side."""
    from proficio.plans.marts import improvement_summary
    m = models(spark, SF)
    df = improvement_summary(m.assessment_yoy, m.dim_schools, m.p)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    w = next(i for i, l in enumerate(lines) if "Window [" in l)
    between = lines[:w]
    join = next(i for i, l in enumerate(between) if "SortMergeJoin" in l or "BroadcastHashJoin" in l)
    assert not any("Exchange" in l for l in between[join + 1:]), "\n".join(lines[: w + 3])


def test_no_cross_joins(spark):
    """Only the one-row min/max bounds may use a nested-loop join; nothing is Cartesian."""
    from proficio.plans import stories
    m = models(spark, SF)
    for df in (m.dim_schools, m.school_improvement_yoy, m.school_performance,
               m.enrollment_trends(), stories.story_consistency_top5(m.school_improvement_yoy),
               stories.story_breakthroughs_top3(m.school_improvement_yoy)):
        p = plan(df)
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, p


def test_yoy_single_window_exchange(spark):
    """All lags (ELA, math, composite) and the grain check share one exchange on school_id."""
    y = models(spark, SF).assessment_yoy
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        p = y._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert p.count("Exchange hashpartitioning(school_id") == 1, p


def static_plan(spark, df) -> str:
    """The physical plan without adaptive execution, exchanges reused."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_scorecard_deals_the_facts_once_and_scans_the_lines_once(spark):
    """Stacked facts: one exchange on school_id serves window and dimension join; no exchange on (school, year)."""
    import re
    p = static_plan(spark, models(spark, SF, shared=True).school_performance)
    assert not re.search(r"hashpartitioning\(school_id#\d+, school_year#", p), p
    assert len(re.findall(r"Exchange hashpartitioning\(school_id#\d+, \d+\), REPARTITION_BY_COL", p)) == 1, p
    scans = [line for line in p.splitlines() if "FileScan parquet" in line and "lineitem" in line]
    assert len(scans) == 1 and "ReusedExchange" in p, p
    assert p.count("Window [") == 1, p


def test_all_ranks_come_back_in_two_joins(spark):
    """School improvement: the ranks of nine measures need two joins after the summary, beside the one-row bounds."""
    import re
    df = models(spark, SF).school_improvement
    p = static_plan(spark, df)
    joins = re.findall(r"(SortMergeJoin|BroadcastHashJoin|ShuffledHashJoin|BroadcastNestedLoopJoin|CartesianProduct)", p)
    assert len([j for j in joins if j != "BroadcastNestedLoopJoin"]) == 2 and len(joins) <= 4, p
    assert len(re.findall(r"Exchange hashpartitioning", p)) <= 6, p


def test_checks_scan_each_extract_once(spark, tmp_path):
    """The declared tests are metrics of the jobs that write the staging rows: no extract is read again."""
    from proficio.params import TEST_PARAMS
    from proficio.plans import quality
    from proficio.plans.build import Models
    from proficio.sources.catalog import RAW_TABLES, Catalog, test_table_catalog
    made = test_table_catalog(spark, SF)
    read = {}

    def counted(name):
        rows = spark.sparkContext.accumulator(0)
        path = str(tmp_path / name)
        made.table(name).write.parquet(path)
        df = spark.read.parquet(path)
        read[name] = (rows, df.count())

        def tally(parts):
            for part in parts:
                rows.add(part.num_rows)
                yield part
        return df.mapInArrow(tally, df.schema)

    tables = {name: counted(name) for name in RAW_TABLES}
    m = Models(Catalog(spark, {n: (lambda n=n: tables[n]) for n in RAW_TABLES}), TEST_PARAMS, audit=False)
    assert quality.test_summary(m).count() == 36
    for name in ("demographic", "assessment", "absenteeism"):
        assert read[name][0].value == read[name][1] > 0, name

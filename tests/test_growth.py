"""YoY, endpoints and the improvement summary on literal rows."""

import pytest
from pyspark.sql import functions as F

from proficio.operators import first_last
from proficio.params import Params
from proficio.plans import marts

SCHEMA = ("school_id string, school_name string, school_year int, ela_pct_proficient int, "
          "math_pct_proficient int, ela_suppressed boolean, math_suppressed boolean")


def staged(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    return df.withColumns({c: F.col(c).cast("decimal(38,0)")
                           for c in ("ela_pct_proficient", "math_pct_proficient")})


def test_yoy_cases(spark):
    rows = [
        ("single", "S", 2020, 50, 50, False, False),
        # gap year 2021 is bridged: 2022 compares with 2020
        ("gap", "G", 2020, 40, 40, False, False), ("gap", "G", 2022, 45, 43, False, False),
        # suppressed middle year -> NULL value -> NULL change on both sides
        ("supp", "P", 2020, 40, 40, False, False), ("supp", "P", 2021, None, 41, True, False),
        ("supp", "P", 2022, 44, 44, False, False),
        # equal years -> Flat
        ("flat", "F", 2020, 40, 40, False, False), ("flat", "F", 2021, 40, 40, False, False),
    ]
    y = marts.assessment_yoy(staged(spark, rows))
    got = {(r.school_id, r.school_year): r for r in y.collect()}
    assert got[("single", 2020)].ela_yoy_change is None
    assert got[("gap", 2022)].ela_yoy_change == 5.0 and got[("gap", 2022)].ela_direction == "Up"
    assert got[("gap", 2022)].composite_yoy_change == 4.0
    assert got[("supp", 2021)].ela_yoy_change is None and got[("supp", 2021)].ela_direction is None
    assert got[("supp", 2021)].composite_pct == 41.0
    assert got[("supp", 2022)].ela_yoy_change is None
    assert got[("supp", 2022)].math_yoy_change == 3.0
    assert got[("flat", 2021)].ela_direction == "Flat" and got[("flat", 2021)].ela_yoy_change == 0.0


def test_both_subjects_null_composite(spark):
    rows = [("n", "N", 2020, None, None, True, True), ("n", "N", 2021, 50, None, False, True)]
    got = {r.school_year: r for r in marts.assessment_yoy(staged(spark, rows)).collect()}
    assert got[2020].composite_pct is None
    assert got[2021].composite_pct == 50.0 and got[2021].composite_yoy_change is None


def test_grain_violation_raises(spark):
    rows = [("d", "D", 2020, 50, 50, False, False), ("d", "D", 2020, 51, 50, False, False)]
    with pytest.raises(Exception, match="grain"):
        marts.assessment_yoy(staged(spark, rows)).collect()


def test_first_last_matches_self_join(spark):
    df = spark.createDataFrame(
        [("a", 2019, None), ("a", 2020, 10), ("a", 2021, 12), ("a", 2022, None), ("b", 2020, None)],
        "k string, y int, v int")
    got = {r.k: r for r in first_last(df, ["k"], "y", {"v": "v"}).collect()}
    assert (got["a"].v_first_year, got["a"].v_latest_year) == (2020, 2021)
    assert (got["a"].v_first_pct, got["a"].v_latest_pct) == (10, 12)
    assert got["b"].v_first_year is None and got["b"].v_first_pct is None


def dim(spark, ids, region="R1"):
    return spark.createDataFrame([(i, i.upper(), region) for i in ids],
                                 "school_id string, school_name string, region string")


def test_improvement_rules(spark):
    p = Params(start_year=2019)
    rows = [
        # only in the start year -> no rows after start -> dropped
        ("only", "O", 2019, 40, 40, False, False),
        # up, flat, down: consistency 0.5 (flat ignored)
        ("uf", "U", 2019, 40, 40, False, False), ("uf", "U", 2020, 50, 50, False, False),
        ("uf", "U", 2021, 50, 50, False, False), ("uf", "U", 2022, 45, 45, False, False),
        # no up or down years -> consistency NULL -> score NULL, ranked last
        ("none", "N", 2019, 40, 40, False, False), ("none", "N", 2020, 40, 40, False, False),
    ]
    y = marts.assessment_yoy(staged(spark, rows))
    out = {r.school_id: r for r in marts.school_improvement(y, dim(spark, ["only", "uf", "none"]), p).collect()}
    assert set(out) == {"uf", "none"}
    assert out["uf"].consistency_score == 0.5
    assert out["none"].consistency_score is None and out["none"].improvement_score is None
    assert out["none"].overall_improvement_rank == 2 and out["uf"].overall_improvement_rank == 1
    # uf: change 5.0 is the max of the bounds -> normalised 1.0 -> 0.5*0.6 + 0.4
    assert out["uf"].improvement_score == 0.7
    assert out["uf"].improvement_category == "Mixed Progress"
    assert out["none"].improvement_category == "Mixed Progress"


def test_zero_range_gives_null_score(spark):
    p = Params(start_year=2019)
    rows = [("a", "A", 2019, 40, 40, False, False), ("a", "A", 2020, 50, 50, False, False),
            ("b", "B", 2019, 30, 30, False, False), ("b", "B", 2020, 40, 40, False, False)]
    y = marts.assessment_yoy(staged(spark, rows))
    out = marts.school_improvement(y, dim(spark, ["a", "b"]), p).collect()
    assert all(r.improvement_score is None for r in out)
    assert all(r.overall_improvement_rank == 1 for r in out)  # NULL ties
    assert {r.improvement_category for r in out} == {"Consistently Improving"}


def test_consistency_with_and_without_flat(spark):
    from proficio.operators.counts import consistency
    df = spark.createDataFrame([("s", 1.0), ("s", 0.0), ("s", -1.0)], "k string, c double")
    assert consistency(df, ["k"], "c", include_flat=False).first()[1] == 0.5
    assert consistency(df, ["k"], "c", include_flat=True).first()[1] == 0.33


def test_one_school_per_category(spark):
    p = Params(start_year=2019)
    series = {"ci": [40, 50], "cf": [40, 42], "bg": [40, 70, 60], "mp": [40, 50, 45], "na": [40, 30]}
    rows = [(k, k.upper(), 2019 + i, v, v, False, False) for k, vals in series.items()
            for i, v in enumerate(vals)]
    y = marts.assessment_yoy(staged(spark, rows))
    out = {r.school_id: r for r in marts.school_improvement(y, dim(spark, list(series)), p).collect()}
    assert {k: out[k].improvement_category for k in series} == {
        "ci": "Consistently Improving", "cf": "Consistent but Flat", "bg": "Big Gains",
        "mp": "Mixed Progress", "na": "Needs Attention"}
    assert {k: out[k].composite_overall_rank for k in series} == {
        "bg": 1, "ci": 2, "mp": 3, "cf": 4, "na": 5}
    assert out["bg"].consistency_score == 0.5 and out["ci"].consistency_score == 1.0

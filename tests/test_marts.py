"""Dimension and scorecard rules on literal rows."""

from pyspark.sql import functions as F

from proficio.plans import marts

ENR = "school_id string, school_name string, school_year int, total_enrolled int"


def dec(df, *cols):
    return df.withColumns({c: F.col(c).cast("decimal(38,0)") for c in cols})


def test_dim_schools(spark):
    enr = spark.createDataFrame([("1", "Old Name", 2020, 10), ("1", "New Name", 2022, 12),
                                 ("2", "Two", 2021, 5), ("3", "Three", 2021, 5)], ENR)
    reg = spark.createDataFrame([("1", "Region 1"), ("1", "Transformation Network"),
                                 ("2", "Region 2"), ("2", "Region 2")],
                                "organization_code string, region string")
    loc = spark.createDataFrame([("1", "x", "1 Main St", "LV", "NV", "89101")],
                                "organization_code string, school_name string, address string, "
                                "city string, state string, zip_code string")
    d = {r.school_id: r for r in marts.dim_schools(enr, reg, loc, audit=True).collect()}
    assert d["1"].school_name == "New Name" and d["1"].region == "Transformation Network"
    assert d["1"].address == "1 Main St" and d["1"].updated_at is not None
    assert d["2"].region == "Region 2" and d["3"].region == "Unknown" and d["3"].address is None


def test_scorecard_joins(spark):
    dim = spark.createDataFrame([("1", "One", "R"), ("2", "Two", "R"), ("3", "Three", "R")],
                                "school_id string, school_name string, region string")
    enr = dec(spark.createDataFrame([("1", "One", 2020, 10), ("1", "One", 2020, 5)], ENR),
              "total_enrolled")
    att = spark.createDataFrame([("1", 2020, 12, "Moderate"), ("2", 2020, 35, "Critical")],
                                "school_id string, school_year int, "
                                "chronic_absenteeism_rate int, absenteeism_tier string")
    asm = spark.createDataFrame([("2", 2020, 40, 50, False, False)],
                                "school_id string, school_year int, math_pct_proficient int, "
                                "ela_pct_proficient int, math_suppressed boolean, "
                                "ela_suppressed boolean")
    asm = dec(asm, "math_pct_proficient", "ela_pct_proficient")
    out = {r.school_id: r for r in marts.school_performance(dim, enr, att, asm, audit=False).collect()}
    assert set(out) == {"1", "2"}                      # no attendance -> no row
    assert out["1"].total_enrollment == 15             # two enrollment rows summed
    assert out["1"].math_pct_proficient is None        # no assessment -> NULL
    assert out["2"].total_enrollment is None and out["2"].ela_pct_proficient == 50


def test_scorecard_keeps_repeated_rows(spark):
    """A repeated attendance row and every assessment row of a school-year stay, as the joins of the reference keep them."""
    dim = spark.createDataFrame([("1", "One", "R"), ("2", "Two", "R"), (None, "None", "R")],
                                "school_id string, school_name string, region string")
    enr = dec(spark.createDataFrame([("1", "One", 2020, 10), ("1", "One", None, 7), (None, "x", 2020, 9)], ENR), "total_enrolled")
    att = spark.createDataFrame([("1", 2020, 12, "Moderate"), ("1", 2020, 12, "Moderate"), ("1", None, 5, "Low"),
                                 ("2", 2021, 9, "Low"), (None, 2020, 1, "Low"), ("9", 2020, 1, "Low")],
                                "school_id string, school_year int, chronic_absenteeism_rate int, absenteeism_tier string")
    asm = dec(spark.createDataFrame([("1", 2020, 40, 50, False, False), ("1", 2020, 41, 51, False, True),
                                     ("1", None, 1, 1, False, False), ("2", 2022, 3, 3, False, False)],
                                    "school_id string, school_year int, math_pct_proficient int, ela_pct_proficient int, "
                                    "math_suppressed boolean, ela_suppressed boolean"),
              "math_pct_proficient", "ela_pct_proficient")
    got = marts.school_performance(dim, enr, att, asm, audit=False)
    for df, name in ((dim, "dim"), (enr, "enr"), (att, "att"), (asm, "asm")):
        df.createOrReplaceTempView(name)
    exp = spark.sql("""
        select at.school_id, at.school_year, school_name, region, total_enrollment, chronic_absenteeism_rate, absenteeism_tier,
            ela_pct_proficient, ela_suppressed, math_pct_proficient, math_suppressed
        from dim join att at on dim.school_id = at.school_id
        left join (select school_id, school_year, sum(total_enrolled) as total_enrollment from enr group by 1, 2) e
            on e.school_id = at.school_id and e.school_year = at.school_year
        left join asm a on a.school_id = at.school_id and a.school_year = at.school_year""")
    show = lambda df: sorted(map(str, df.select(*got.columns).collect()))
    assert show(got) == show(exp) and got.count() == 6

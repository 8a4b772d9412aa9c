"""Micro fixtures for the column functions (numbers, years, suppression, tiers, rounding)."""

from decimal import Decimal

import pytest

from proficio.functions import (
    academic_year, clean_numeric, composite_mean, direction, rounded, safe_ratio,
    suppression_flag, tier_label, try_academic_year,
)


def test_clean_numeric_whole_numbers(spark):
    vals = ["45.6", "45.5", "44.5", "-45.5", " 12 ", "", "1,234", "<5", ">95", "-", "1e2", "NaN", None]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    got = [r[0] for r in df.select(clean_numeric("s")).collect()]
    assert got == [Decimal(46), Decimal(46), Decimal(45), Decimal(-46), Decimal(12), None, None,
                   None, None, None, Decimal(100), None, None]


def test_clean_numeric_scale(spark):
    df = spark.createDataFrame([("45.66",)], "s string")
    assert df.select(clean_numeric("s", 1)).first()[0] == Decimal("45.7")


def test_academic_year(spark):
    df = spark.createDataFrame([("2023-2024",), (" 2023-2024 ",), ("2023",)], "s string")
    assert [r[0] for r in df.select(academic_year("s")).collect()] == [2023, 2023, 2023]


def test_academic_year_bad_text_raises(spark):
    df = spark.createDataFrame([("abcd",)], "s string")
    with pytest.raises(Exception):
        df.select(academic_year("s")).collect()
    assert df.select(try_academic_year("s")).first()[0] is None


def test_suppression_reads_raw_text(spark):
    df = spark.createDataFrame([(None,), ("<5",), (">95",), ("-",), ("50",)], "s string")
    assert [r[0] for r in df.select(suppression_flag("s")).collect()] == [True, True, True, False, False]


def test_tiers(spark):
    vals = ["9.4", "9.5", "10", "19.5", "20", "29.5", "30", None]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    got = [r[0] for r in df.select(tier_label(clean_numeric("s"))).collect()]
    # cleaning rounds first: 9.5 -> 10 (Moderate), 19.5 -> 20 (High), 29.5 -> 30 (Critical)
    assert got == ["Low", "Moderate", "Moderate", "High", "High", "Critical", "Critical", "Critical"]


def test_rounding_is_decimal_half_away_from_zero(spark):
    df = spark.createDataFrame([(1.275,), (-1.275,), (2.5,), (0.125,)], "x double")
    got = [r[0] for r in df.select(rounded("x", 2)).collect()]
    assert got == [1.28, -1.28, 2.5, 0.13]


def test_composite_mean_and_ratio(spark):
    df = spark.createDataFrame([(40, 51), (None, 51), (None, None)], "a int, b int")
    got = [r[0] for r in df.select(composite_mean(["a", "b"], 1)).collect()]
    assert got == [45.5, 51.0, None]
    r = spark.createDataFrame([(1, 3), (1, 0), (2, None)], "a int, b int")
    assert [x[0] for x in r.select(safe_ratio("a", "b", 2)).collect()] == [0.33, None, None]


def test_direction(spark):
    df = spark.createDataFrame([(2, 1), (1, 2), (1, 1), (None, 1)], "c int, p int")
    assert [r[0] for r in df.select(direction("c", "p")).collect()] == ["Up", "Down", "Flat", None]

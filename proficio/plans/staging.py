"""Staging: raw text extracts -> typed, cleaned rows (lazy views)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from proficio.functions.cleaning import academic_year, clean_numeric, suppression_flag, tier_label
from proficio.params import Params

# Enrollment count columns of the demographic extract, in output order.
ENROLLMENT_COUNTS = [
    "num_hispanic", "num_black", "num_white", "num_asian", "num_am_indian",
    "num_pacific_islander", "num_two_or_more",
    "num_male", "num_female",
    "num_iep", "num_ell", "num_frl", "num_homeless", "num_foster", "num_military",
    "num_pre_k", "num_kindergarten",
] + [f"num_grade_{i:02d}" for i in range(1, 13)]

# Assessment measure columns, in output order.
ASSESSMENT_MEASURES = ["num_students_enrolled"] + [
    f"{s}_{m}" for s in ("math", "ela")
    for m in ("num_tested", "pct_proficient", "pct_emergent", "pct_approaches", "pct_meets",
              "pct_exceeds")
]


def stg_enrollment(raw: DataFrame, p: Params) -> DataFrame:
    """Cleaned enrollment counts, school x year; rows without a positive total dropped."""
    total = clean_numeric("num_enrolled", p.numeric_scale)
    year = academic_year("accountability_year")
    return (raw.select(
                F.col("organization_code").alias("school_id"),
                F.col("school_name"),
                year.alias("school_year"),
                total.alias("total_enrolled"),
                *[clean_numeric(c, p.numeric_scale).alias(c) for c in ENROLLMENT_COUNTS])
            .filter(F.col("total_enrolled").isNotNull() & (F.col("total_enrolled") > 0)
                    & (F.col("school_year") >= p.start_year)))


def stg_attendance(raw: DataFrame, p: Params) -> DataFrame:
    """Chronic absenteeism rate and tier per school and year."""
    rate = clean_numeric("chronic_absenteeism_rate", p.numeric_scale)
    return (raw.select(
                F.col("organization_code").alias("school_id"),
                F.col("school_name"),
                academic_year("accountability_year").alias("school_year"),
                F.col("district_name"),
                rate.alias("chronic_absenteeism_rate"),
                tier_label(rate).alias("absenteeism_tier"))
            .filter(F.col("school_year") >= p.start_year))


def stg_assessment_scores(raw: DataFrame, p: Params) -> DataFrame:
    """Proficiency bands per school and year plus suppression flags.

    The flags read the raw text (NULL, '<5', '>95'), so they are built in the
    same projection that replaces the text with cleaned numbers.
    """
    return (raw.select(
                F.col("organization_code").alias("school_id"),
                F.col("school_name"),
                academic_year("school_year").alias("school_year"),
                *[clean_numeric(c, p.numeric_scale).alias(c) for c in ASSESSMENT_MEASURES],
                suppression_flag("math_pct_proficient").alias("math_suppressed"),
                suppression_flag("ela_pct_proficient").alias("ela_suppressed"))
            .filter(F.col("school_year") >= p.start_year))

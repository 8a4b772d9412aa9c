"""Report queries over the YoY detail fact (regional comparisons)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from proficio.functions.metrics import count_if_expr, rounded, safe_ratio
from proficio.operators.ranking import topn_per_group

# Fixed values of the reference reports: regions left out of the regional comparisons,
# and the network the single-group report shows.
SPECIAL_REGIONS = ("Alternative", "Charter")
NETWORK = "Transformation Network"


def _regular(yoy: DataFrame, exclude: Sequence[str]) -> DataFrame:
    return yoy.filter(~F.col("region").isin(*exclude))


def story_yoy_trends(yoy: DataFrame, exclude: Sequence[str] = SPECIAL_REGIONS) -> DataFrame:
    """Every school-year of the regular regions, ordered for reading."""
    return (_regular(yoy, exclude)
            .select("region", "school_name", "school_year", "ela_pct", "ela_prior_year",
                    "ela_yoy_change", "ela_direction", "math_pct", "math_prior_year",
                    "math_yoy_change", "math_direction", "composite_pct", "composite_yoy_change")
            .orderBy("region", "school_name", "school_year"))


def _up_down(c: str = "composite_yoy_change"):
    return (F.sum(count_if_expr(F.col(c) > 0)).alias("years_up"),
            F.sum(count_if_expr(F.col(c) < 0)).alias("years_down"))


def _avg(c: str, out: str):
    return rounded(F.avg(c), 1).alias(out)


def story_consistency_top5(yoy: DataFrame, n: int = 5,
                           exclude: Sequence[str] = SPECIAL_REGIONS) -> DataFrame:
    """Top-n schools per region by share of years up (flat years count as measured)."""
    c = F.col("composite_yoy_change")
    g = (_regular(yoy, exclude).filter(c.isNotNull())
         .groupBy("region", "school_name")
         .agg(F.count("school_year").alias("total_years"), *_up_down(),
              F.sum(count_if_expr(c == 0)).alias("years_flat"),
              _avg("ela_yoy_change", "avg_ela_yoy"), _avg("math_yoy_change", "avg_math_yoy"),
              _avg("composite_yoy_change", "avg_composite_yoy"),
              safe_ratio(F.sum(count_if_expr(c > 0)), F.sum(count_if_expr(c.isNotNull())),
                         2).alias("consistency_score")))
    top = topn_per_group(g, n, ["region"], [F.col("consistency_score").desc(),
                                             F.col("avg_composite_yoy").desc()], "regional_rank")
    return (top.select("region", "regional_rank", "school_name", "total_years", "years_up",
                       "years_down", "avg_ela_yoy", "avg_math_yoy", "avg_composite_yoy",
                       "consistency_score")
               .orderBy("region", "regional_rank"))


def story_single_group(yoy: DataFrame, region: str = NETWORK) -> DataFrame:
    """All school-years of one region."""
    return (yoy.filter(F.col("region") == region)
               .select("school_name", "school_year", "ela_pct", "ela_yoy_change", "ela_direction",
                       "math_pct", "math_yoy_change", "math_direction", "composite_pct",
                       "composite_yoy_change")
               .orderBy("school_name", "school_year"))


def story_breakthroughs_top3(yoy: DataFrame, n: int = 3,
                             exclude: Sequence[str] = SPECIAL_REGIONS) -> DataFrame:
    """Biggest single-year composite gains per region (ties kept)."""
    c = F.col("composite_yoy_change")
    top = topn_per_group(_regular(yoy, exclude).filter(c.isNotNull()), n, ["region"],
                         [c.desc_nulls_last()], "peak_rank")
    return (top.select("region", "school_name", F.col("school_year").alias("breakthrough_year"),
                       F.col("ela_yoy_change").alias("ela_gain"),
                       F.col("math_yoy_change").alias("math_gain"),
                       F.col("composite_yoy_change").alias("composite_gain"), "peak_rank")
               .orderBy("region", "peak_rank").drop("peak_rank"))


def story_needs_support(yoy: DataFrame, exclude: Sequence[str] = SPECIAL_REGIONS) -> DataFrame:
    """Schools with more years down than up."""
    c = F.col("composite_yoy_change")
    g = (_regular(yoy, exclude).filter(c.isNotNull())
         .groupBy("region", "school_name")
         .agg(*_up_down(), _avg("composite_yoy_change", "avg_composite_yoy"),
              _avg("ela_yoy_change", "avg_ela_yoy"), _avg("math_yoy_change", "avg_math_yoy")))
    return (g.filter(F.col("years_down") > F.col("years_up"))
             .orderBy(F.col("region").asc(), F.col("avg_composite_yoy").asc()))

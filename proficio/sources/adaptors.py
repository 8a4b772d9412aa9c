"""Adaptors: the driver's test tables reshaped into the raw school schemas.

They only produce input rows (text measures with suppression tokens, junk,
blanks, padded year labels, gaps, duplicates and unmapped keys); none of the
pipeline's work happens here.  The DuckDB oracle spells the same rules out
for itself (``duckdb_inputs.py``).  Counts are
pre-aggregated on the fact table's own key before the join to the
dimension, so the large table is reduced map-side before any shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Per-column count rules of the demographic adaptor (SQL text
# valid in Spark SQL and DuckDB), applied to orders.
DEMOGRAPHIC_COUNTS = {
    "num_hispanic": "o_orderpriority = '1-URGENT'",
    "num_black": "o_orderpriority = '2-HIGH'",
    "num_white": "o_orderpriority = '3-MEDIUM'",
    "num_asian": "o_orderpriority = '4-NOT SPECIFIED'",
    "num_am_indian": "o_orderpriority = '5-LOW'",
    "num_pacific_islander": "o_orderstatus = 'P'",
    "num_two_or_more": "o_orderpriority = '1-URGENT' and o_orderstatus = 'P'",
    "num_male": "o_orderstatus = 'F'",
    "num_female": "o_orderstatus = 'O'",
    "num_iep": "o_totalprice > 150000",
    "num_ell": "o_totalprice < 50000",
    "num_frl": "o_orderpriority in ('4-NOT SPECIFIED', '5-LOW')",
    "num_homeless": "o_orderstatus = 'F' and o_orderpriority = '5-LOW'",
    "num_foster": "o_orderstatus = 'O' and o_orderpriority = '1-URGENT'",
    "num_military": "o_orderstatus = 'P' and o_orderpriority = '2-HIGH'",
}
# Grade columns: orders binned by month of the order date.
GRADE_COLUMNS = ["num_pre_k", "num_kindergarten"] + [f"num_grade_{i:02d}" for i in range(1, 13)]
GRADE_RULES = {c: f"month(o_orderdate) = {i % 12 + 1}" for i, c in enumerate(GRADE_COLUMNS)}

# Proficiency bands of the assessment adaptor (lineitem rules).
ASSESSMENT_BANDS = {
    "math_pct_emergent": "l_quantity <= 12",
    "math_pct_approaches": "l_quantity > 12 and l_quantity <= 25",
    "math_pct_meets": "l_quantity > 25 and l_quantity <= 38",
    "math_pct_exceeds": "l_quantity > 38",
    "ela_pct_emergent": "l_tax <= 0.02",
    "ela_pct_approaches": "l_tax > 0.02 and l_tax <= 0.04",
    "ela_pct_meets": "l_tax > 0.04 and l_tax <= 0.06",
    "ela_pct_exceeds": "l_tax > 0.06",
}
TESTED = {"math_num_tested": "l_linestatus = 'F'", "ela_num_tested": "l_linestatus = 'O'"}
MATH_RULE = "l_returnflag = 'R'"
ELA_RULE = "l_discount > 0.05"


def _sum_if(cond: str, name: str):
    return F.sum(F.when(F.expr(cond), 1).otherwise(0)).alias(name)


def _year_label(y, pad_left: str = "", pad_right: str = ""):
    return F.concat(F.lit(pad_left), y.cast("string"), F.lit("-"), (y + 1).cast("string"),
                    F.lit(pad_right))


def raw_demographic(orders: DataFrame, customer: DataFrame, cutoff: str | None = None) -> DataFrame:
    """One row per (customer, order year): enrollment counts as text."""
    o = orders
    if cutoff:
        o = o.filter(F.col("o_orderdate") < F.lit(cutoff).cast("timestamp_ntz"))
    rules = {**DEMOGRAPHIC_COUNTS, **GRADE_RULES}
    agg = (o.withColumn("_y", F.year("o_orderdate"))
            .groupBy("o_custkey", "_y")
            .agg(F.count(F.lit(1)).alias("_n"), *[_sum_if(c, k) for k, c in rules.items()]))
    j = agg.join(customer.select("c_custkey", "c_name"), F.col("o_custkey") == F.col("c_custkey"))
    n = F.col("_n")
    enrolled = (F.when((n == 1) & (F.col("c_custkey") % 10 == 0), "<5")
                 .when((n == 1) & (F.col("c_custkey") % 10 == 1), "-")
                 .otherwise((n * 100).cast("string")))
    return j.select(
        F.col("c_custkey").cast("string").alias("organization_code"),
        F.col("c_name").alias("school_name"),
        _year_label(F.col("_y"), pad_left=" ").alias("accountability_year"),
        enrolled.alias("num_enrolled"),
        *[F.col(k).cast("string").alias(k) for k in rules],
    )


def revised_demographic(raw: DataFrame, year: int) -> DataFrame:
    """A later release of the demographic extract: some schools are renamed, some have
    closed (no rows at all) and some have withdrawn their rows of ``year``."""
    k = F.col("organization_code").cast("bigint")
    withdrawn = (k % 25 == 3) & F.trim("accountability_year").startswith(str(year))
    return (raw.filter((k % 35 != 7) & ~withdrawn)
            .withColumn("school_name", F.when(k % 40 == 1, F.concat("school_name", F.lit(" Academy")))
                        .otherwise(F.col("school_name"))))


def _pct(p, partkey):
    return (F.when(p < 5, "<5").when(p > 95, ">95")
             .when(partkey % 40 == 3, "-")
             .when(partkey % 40 == 4, F.lit(None).cast("string"))
             .otherwise(F.concat(p.cast("string"), F.lit(".5"))))


def _lineitem_by_part_year(lineitem: DataFrame, rules: dict[str, str]) -> DataFrame:
    return (lineitem.withColumn("_y", F.year("l_shipdate"))
            .groupBy("l_partkey", "_y")
            .agg(F.count(F.lit(1)).alias("_n"), *[_sum_if(c, k) for k, c in rules.items()]))


LINEITEM_RULES = {"_math": MATH_RULE, "_ela": ELA_RULE, **TESTED, **ASSESSMENT_BANDS,
                  "_hi": "l_quantity > 40"}


def lineitem_by_part_year(lineitem: DataFrame) -> DataFrame:
    """Counts per (part, ship year), the input of both lineitem adaptors."""
    return _lineitem_by_part_year(lineitem, LINEITEM_RULES)


def lineitem_shared(lineitem: DataFrame, from_year: int) -> DataFrame:
    """:func:`lineitem_by_part_year` from ``from_year`` on, for a plan that reads both extracts.

    Year and counts travel as one array that neither column pruning nor a
    filter on the year can take apart, so the two extracts share one exchange
    and Spark scans the lines once; the years are cut at the scan instead.
    """
    kept = lineitem.filter(F.col("l_shipdate") >= F.lit(f"{from_year}-01-01").cast("timestamp_ntz"))
    agg = _lineitem_by_part_year(kept, LINEITEM_RULES)
    names = [c for c in agg.columns if c != "l_partkey"]
    # an element of a literal array is simplified to the element; one of a transformed array is not
    packed = agg.select("l_partkey", F.transform(F.array(*[F.col(c).cast("bigint") for c in names]), lambda x: x + 0).alias("_c"))
    return packed.select("l_partkey", *[F.element_at("_c", i + 1).cast(agg.schema[n].dataType).alias(n) for i, n in enumerate(names)])


def raw_assessment(lineitem: DataFrame, part: DataFrame, agg: DataFrame | None = None) -> DataFrame:
    """One row per (part, ship year): proficiency percentages as text."""
    agg = agg if agg is not None else lineitem_by_part_year(lineitem)
    j = agg.join(part.select("p_partkey", "p_name"), F.col("l_partkey") == F.col("p_partkey"))
    n, k = F.col("_n"), F.col("l_partkey")

    def pct_of(c):
        return F.expr(f"(100 * {c}) div _n")

    return j.select(
        k.cast("string").alias("organization_code"),
        F.col("p_name").alias("school_name"),
        _year_label(F.col("_y"), pad_right=" ").alias("school_year"),
        n.cast("string").alias("num_students_enrolled"),
        F.col("math_num_tested").cast("string").alias("math_num_tested"),
        _pct(pct_of("_math"), k).alias("math_pct_proficient"),
        *[pct_of(c).cast("string").alias(c) for c in ASSESSMENT_BANDS if c.startswith("math")],
        F.col("ela_num_tested").cast("string").alias("ela_num_tested"),
        _pct(pct_of("_ela"), k).alias("ela_pct_proficient"),
        *[pct_of(c).cast("string").alias(c) for c in ASSESSMENT_BANDS if c.startswith("ela")],
    )


def raw_absenteeism(lineitem: DataFrame, part: DataFrame, agg: DataFrame | None = None) -> DataFrame:
    """One row per (part, ship year): chronic absenteeism rate as text ('' when one line)."""
    agg = agg if agg is not None else lineitem_by_part_year(lineitem)
    j = agg.join(part.select("p_partkey", "p_name", "p_brand"),
                 F.col("l_partkey") == F.col("p_partkey"))
    rate = (F.when(F.col("_n") == 1, F.lit(""))
             .otherwise(F.expr("(100 * _hi) div _n").cast("string")))
    return j.select(
        F.col("l_partkey").cast("string").alias("organization_code"),
        F.col("p_name").alias("school_name"),
        F.col("p_brand").alias("district_name"),
        _year_label(F.col("_y")).alias("accountability_year"),
        rate.alias("chronic_absenteeism_rate"),
    )


def raw_regions(part: DataFrame, region: DataFrame) -> DataFrame:
    """(organization_code, region) with precedence duplicates and unmapped keys.

    The ``% 97`` / ``% 50`` rules shape the seed (schools with no region,
    special regions); they are input rules, not a sample: every part row is
    read and every row of the result is used by the queries.
    """
    k = F.col("p_partkey")
    plain = (part.filter(k % 97 != 0)
             .join(region, (k % 5) == F.col("r_regionkey"))
             .select(k.cast("string").alias("organization_code"),
                     F.when(k % 50 == 7, "Alternative").when(k % 50 == 8, "Charter")
                      .otherwise(F.col("r_name")).alias("region")))
    network = (part.filter(F.col("p_size") >= 45)
               .select(k.cast("string").alias("organization_code"),
                       F.lit("Transformation Network").alias("region")))
    return plain.unionByName(network)


def raw_locations(part: DataFrame) -> DataFrame:
    """(organization_code, school_name, address, city, state, zip_code).

    ``% 89`` leaves some schools without a location (the left join's NULL case).
    """
    k = F.col("p_partkey")
    return (part.filter(k % 89 != 0)
            .select(k.cast("string").alias("organization_code"),
                    F.col("p_name").alias("school_name"),
                    F.col("p_brand").alias("address"),
                    F.col("p_type").alias("city"),
                    F.lit("NV").alias("state"),
                    F.col("p_size").cast("string").alias("zip_code")))

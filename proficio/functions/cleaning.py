"""Cleaning of dirty text extracts: numbers, school years, suppression, tiers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from proficio.functions.metrics import _col

# Fixed values of the reference data: tokens that mark a suppressed percentage.
SUPPRESSION_TOKENS = ("<5", ">95")

# Fixed values of the reference data: absenteeism tiers, upper bounds exclusive,
# anything else (including NULL) is the last label.
TIER_BOUNDS = ((10, "Low"), (20, "Moderate"), (30, "High"))
TIER_ELSE = "Critical"


def clean_numeric(c: str | Column, scale: int = 0) -> Column:
    """Dirty text -> DECIMAL(38, scale).

    Text that does not parse (``'<5'``, ``'-'``, ``'1,234'``, blank, ``'NaN'``)
    becomes NULL; surrounding blanks are ignored; fractions are rounded half
    away from zero to ``scale`` decimals (45.5 -> 46, -45.5 -> -46).
    """
    return F.trim(_col(c)).try_cast(DecimalType(38, scale))


def academic_year(c: str | Column) -> Column:
    """First four characters of a school-year label as INT ('2023-2024' -> 2023).

    Strict: text that is not a year raises (ANSI cast), like the reference.
    """
    return F.substring(F.trim(_col(c)), 1, 4).cast("int")


def try_academic_year(c: str | Column) -> Column:
    """Like :func:`academic_year` but unparseable text gives NULL."""
    return F.substring(F.trim(_col(c)), 1, 4).try_cast("int")


def suppression_flag(raw: str | Column, tokens: Sequence[str] = SUPPRESSION_TOKENS) -> Column:
    """True when the *raw* text is NULL or one of the suppression tokens.

    Other junk such as ``'-'`` is not suppressed (its cleaned value is NULL).
    Must be applied to the raw column, before it is replaced by its cleaned value.
    """
    r = _col(raw)
    return r.isNull() | r.isin(*tokens)


def tier_label(c: str | Column, bounds=TIER_BOUNDS, otherwise: str = TIER_ELSE) -> Column:
    """Ordered bucket label: first bound the value is below wins; NULL -> ``otherwise``."""
    v = _col(c)
    expr = None
    for bound, label in bounds:
        expr = F.when(v < bound, label) if expr is None else expr.when(v < bound, label)
    return expr.otherwise(otherwise)

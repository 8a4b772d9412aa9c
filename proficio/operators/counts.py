"""Up / down / measured counts, peaks and consistency of change columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from proficio.functions.metrics import count_if_expr, safe_ratio


def updown_aggs(changes: Mapping[str, str], rows: Column | None = None,
                measured: Sequence[str] | None = None) -> list[Column]:
    """Aggregates per change column: ``{p}_years_improved`` / ``_declined`` (sign counts),
    ``{p}_peak_yoy`` (max, may be negative) and ``{p}_years_measured`` (non-NULL count).

    ``rows`` restricts the rows that count (lets several aggregations share one pass);
    ``measured`` limits which prefixes get a measured count (default: all).
    """
    keep = (lambda c: c) if rows is None else (lambda c: F.when(rows, c))
    out = []
    for col, p in changes.items():
        c = F.col(col)
        out += [F.sum(count_if_expr(keep(c > 0))).alias(f"{p}_years_improved"),
                F.sum(count_if_expr(keep(c < 0))).alias(f"{p}_years_declined")]
    for col, p in changes.items():
        out.append(F.max(keep(F.col(col))).alias(f"{p}_peak_yoy"))
    for col, p in changes.items():
        if measured is None or p in measured:
            out.append(F.count(keep(F.col(col))).alias(f"{p}_years_measured"))
    return out


def consistency(df: DataFrame, key: Sequence[str], change: str, include_flat: bool,
                out: str = "consistency_score", digits: int = 2) -> DataFrame:
    """Share of periods with a rise.

    include_flat=False: rises / (rises + falls) -- flat periods ignored;
    include_flat=True:  rises / all measured periods.
    """
    c = F.col(change)
    ups = F.sum(count_if_expr(c > 0))
    den = F.sum(count_if_expr(c.isNotNull())) if include_flat else ups + F.sum(count_if_expr(c < 0))
    return df.groupBy(*key).agg(safe_ratio(ups, den, digits).alias(out))

"""Numeric helpers: rounding, means of optional measures, ratios, labels.

Rounding rule: fractional results are rounded half away from zero on an
exact decimal (``DECIMAL(38,6)``) and returned as DOUBLE, so the result does
not depend on the binary representation of an intermediate double.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

EXACT = "decimal(38,6)"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def rounded(c: str | Column, digits: int) -> Column:
    """Round half away from zero to ``digits`` decimals; DOUBLE result."""
    return F.round(_col(c).cast(EXACT), digits).cast("double")


def count_if_expr(cond: Column) -> Column:
    """1 when ``cond`` is true else 0 (NULL counts as 0); for sum()."""
    return F.when(cond, 1).otherwise(0)


def safe_ratio(num: str | Column, den: str | Column, digits: int | None = 2) -> Column:
    """num / den as DOUBLE, NULL when den is 0 or NULL, optionally rounded."""
    r = _col(num).cast("double") / F.nullif(_col(den).cast("double"), F.lit(0.0))
    return rounded(r, digits) if digits is not None else r


def composite_mean(cols: Sequence[str | Column], digits: int = 1) -> Column:
    """Mean of the non-NULL measures; NULL when all are NULL."""
    cs = [_col(c) for c in cols]
    total = sum((F.coalesce(c.cast("double"), F.lit(0.0)) for c in cs), F.lit(0.0))
    n = sum((count_if_expr(c.isNotNull()) for c in cs), F.lit(0))
    return safe_ratio(total, n, digits)


def composite_change(pairs: Sequence[tuple[str | Column, str | Column]], digits: int = 1) -> Column:
    """Mean of (latest - first) over the pairs where both ends are present."""
    diffs = [(_col(b).cast("double") - _col(a).cast("double")) for a, b in pairs]
    total = sum((F.coalesce(d, F.lit(0.0)) for d in diffs), F.lit(0.0))
    n = sum((count_if_expr(d.isNotNull()) for d in diffs), F.lit(0))
    return safe_ratio(total, n, digits)


def direction(cur: str | Column, prior: str | Column,
              labels: tuple[str, str, str] = ("Up", "Down", "Flat")) -> Column:
    """Up / Down / Flat from the unrounded comparison; NULL if either side is NULL."""
    c, p = _col(cur), _col(prior)
    return (F.when(c > p, labels[0]).when(c < p, labels[1]).when(c == p, labels[2])
            .otherwise(F.lit(None).cast("string")))


def weighted_score(parts: Sequence[tuple[str | Column, float]], digits: int = 3) -> Column:
    """Rounded weighted sum of DOUBLE parts; NULL when any part is NULL."""
    total = None
    for c, w in parts:
        term = _col(c).cast("double") * F.lit(float(w))
        total = term if total is None else total + term
    return rounded(total, digits)


def rule_category(rules: Sequence[tuple[Column, str]], otherwise: str) -> Column:
    """First matching rule wins (a NULL condition does not match)."""
    expr = None
    for cond, label in rules:
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(otherwise)

"""Column expressions (JVM-side, whole-stage-codegen friendly)."""

from proficio.functions.cleaning import (
    academic_year, clean_numeric, suppression_flag, tier_label, try_academic_year,
)
from proficio.functions.metrics import (
    composite_mean, composite_change, count_if_expr, direction, rounded, rule_category,
    safe_ratio, weighted_score,
)

__all__ = [
    "academic_year", "try_academic_year", "clean_numeric", "suppression_flag", "tier_label",
    "composite_mean", "composite_change", "count_if_expr", "direction", "rounded",
    "rule_category", "safe_ratio", "weighted_score",
]

"""Reusable table operators (each works on any table of a suitable shape)."""

from proficio.operators import checks, scd2, upsert
from proficio.operators.endpoints import distinct_rows, first_last, first_last_aggs
from proficio.operators.normalize import minmax_bounds, minmax_normalize
from proficio.operators.profile import head_tail, select_filter, table_profile
from proficio.operators.ranking import (
    RankSpec, dedupe_precedence, latest_per_key, rank_columns, ranked_values,
    topn_per_group,
)
from proficio.operators.yoy import add_yoy

__all__ = [
    "checks", "scd2", "upsert",
    "add_yoy", "distinct_rows", "first_last", "first_last_aggs", "minmax_bounds",
    "minmax_normalize", "head_tail", "select_filter", "table_profile",
    "RankSpec", "dedupe_precedence", "latest_per_key", "rank_columns",
    "ranked_values", "topn_per_group",
]

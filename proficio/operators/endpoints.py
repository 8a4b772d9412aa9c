"""First / latest measured period and value per key, in one aggregation.

Replaces four self-joins (key, first year) / (key, latest year) with
``min_by`` / ``max_by`` over the periods where the value is present.  These
are ordinary partial aggregates: rows are combined map-side, so a key with
very many rows is reduced before the shuffle.  Requires one row per
(key, period), which :func:`proficio.operators.yoy.add_yoy` enforces.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_last_aggs(order: str, measures: Mapping[str, str], rows: Column | None = None) -> list[Column]:
    """Aggregate expressions ``{p}_first_year``, ``{p}_latest_year``, ``{p}_first_pct``, ``{p}_latest_pct``.

    ``rows`` optionally restricts which rows count.
    """
    out = []
    for value, p in measures.items():
        present = F.col(value).isNotNull() if rows is None else (F.col(value).isNotNull() & rows)
        when_year = F.when(present, F.col(order))
        out += [
            F.min(when_year).alias(f"{p}_first_year"),
            F.max(when_year).alias(f"{p}_latest_year"),
            F.min_by(F.col(value), when_year).alias(f"{p}_first_pct"),
            F.max_by(F.col(value), when_year).alias(f"{p}_latest_pct"),
        ]
    return out


def first_last(df: DataFrame, key: Sequence[str], order: str, measures: Mapping[str, str]) -> DataFrame:
    """One row per key with first / latest period and value of each measure."""
    return df.groupBy(*key).agg(*first_last_aggs(order, measures))


def distinct_rows(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """``select distinct`` (map-side partial dedupe, then one shuffle)."""
    return (df.select(*cols) if cols else df).distinct()

"""Year-over-year: prior value, rounded change and direction per key.

All measures share one window spec, so Catalyst evaluates every lag in a
single Window node after a single hash exchange on the key.  A key holds one
row per period (the grain); the frame ``RANGE CURRENT ROW`` counts rows of
the same period in that same Window node, and a duplicate stops the job
instead of producing an order-dependent lag.  The grain bound also bounds
the rows a single key can bring into one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from proficio.functions.metrics import direction, rounded


def _grain_guard(w, key: Sequence[str], order: str) -> Column:
    dup = F.count(F.lit(1)).over(w.rangeBetween(Window.currentRow, Window.currentRow))
    msg = f"grain violated: more than one row per ({', '.join(key)}, {order})"
    return dup > 1, F.raise_error(F.lit(msg))


def add_yoy(df: DataFrame, key: Sequence[str], order: str, measures: Mapping[str, str],
            digits: int = 1, prior: Sequence[str] = (), directions: Sequence[str] = (),
            check_grain: bool = True) -> DataFrame:
    """Add ``{p}_yoy_change`` (and optionally ``{p}_prior``, ``{p}_direction``).

    measures   value column -> output prefix
    prior      prefixes that also get the lagged value
    directions prefixes that also get Up/Down/Flat
    The lag is by row order, not by ``order - 1``: a missing period is
    bridged, a NULL prior value gives a NULL change.
    """
    w = Window.partitionBy(*key).orderBy(order)
    bad, err = _grain_guard(w, key, order) if check_grain else (None, None)
    cols: dict[str, Column] = {}
    for value, p in measures.items():
        lag = F.lag(value).over(w)
        if bad is not None:
            lag = F.when(bad, err).otherwise(lag)
        if p in prior:
            cols[f"{p}_prior"] = lag
        cols[f"{p}_yoy_change"] = rounded(F.col(value) - lag, digits)
        if p in directions:
            cols[f"{p}_direction"] = direction(F.col(value), lag)
    return df.withColumns(cols)

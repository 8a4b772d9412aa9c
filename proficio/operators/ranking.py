"""Ranking, top-n per group, latest row per key, precedence dedupe.

``rank_columns`` computes SQL ``rank()`` (ties share a rank, gaps follow)
for many measures without a single-partition window.  A window with no
PARTITION BY sends every row to one task; here the work is split three ways,
in the same way at every size:

1. rows collapse to distinct (group, value) pairs with a count -- a partial
   aggregate, so a value carried by a third of all rows becomes one row
   before the shuffle -- written once to the shared folder;
2. the distinct values of every group are cut into ``buckets`` ordered ranges
   by approximate quantiles of that group; per (group, bucket) totals give
   each bucket's offset (a window over at most buckets + 2 rows per group),
   and a running sum inside a bucket gives the count of strictly better
   values;
3. the ranked distinct values, written once, meet the stacked keys of the rows
   in one join for all measures; the planner picks the join by the written
   table's size.

Order keys must be numeric and are compared in their own type (cut points
alone are approximate), so BIGINT and DECIMAL keys rank exactly.
"""

from __future__ import annotations

from collections.abc import Sequence
import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from proficio.session import materialize


@dataclass(frozen=True)
class RankSpec:
    out: str
    order_by: str
    partition_by: tuple[str, ...] = ()
    ascending: bool = False
    nulls_last: bool = True


_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
            T.DecimalType)


def _key_type(df: DataFrame, s: RankSpec) -> T.DataType:
    """The type the order key is compared in: its own, integers as BIGINT, floats as DOUBLE."""
    t = {f.name: f.dataType for f in df.schema.fields}.get(s.order_by)
    if not isinstance(t, _NUMERIC):
        raise TypeError(f"rank_columns needs a numeric order key; {s.order_by!r} is {t} "
                        "(use a window rank for text keys)")
    if isinstance(t, (T.ByteType, T.ShortType, T.IntegerType)):
        return T.LongType()
    return T.DoubleType() if isinstance(t, T.FloatType) else t


def _group_key(s: RankSpec) -> Column:
    return (F.array(*[F.col(c).cast("string") for c in s.partition_by]) if s.partition_by
            else F.array().cast("array<string>"))


def _stack(df: DataFrame, specs: Sequence[tuple[int, RankSpec]], key: T.DataType) -> DataFrame:
    """(_m, _g, _v): spec, group and value of every row, for specs of one key type."""
    items = [F.struct(F.lit(i).alias("_m"), _group_key(s).alias("_g"), F.col(s.order_by).cast(key).alias("_v"))
             for i, s in specs]
    return df.select(F.inline(F.array(*items)))


def _stride(buckets: int) -> int:
    return max(2, math.isqrt(max(buckets - 1, 1)) + 1)


def _with_bucket(dv: DataFrame, buckets: int, ascending: bool, nulls_last: bool) -> DataFrame:
    """Add ``_b``, the bucket in rank order (0 holds the best values).

    Every (spec, group) has cut points of its own, approximate quantiles of
    its distinct values, so a group of any size is split evenly however
    narrow its values are.  The number of cut points below (ascending) or
    at-or-below (descending) a value is found in two levels, with about
    2*sqrt(buckets) comparisons.  NULLs go to the last (or first) bucket.
    """
    stride = _stride(buckets)
    fracs = F.array(*[F.lit(i / buckets) for i in range(1, buckets)])
    cuts = (dv.groupBy("_m", "_g")
            .agg(F.percentile_approx("_v", fracs, max(10_000, 10 * buckets)).alias("_cuts"))
            .withColumn("_k", F.filter("_cuts", lambda x, i: (i + 1) % stride == 0)))
    v = F.col("_v")

    def prefix(points):
        below = F.filter(points, (lambda x: x < v) if ascending else (lambda x: x <= v))
        return F.coalesce(F.size(below), F.lit(0))

    found = (dv.join(cuts, ["_m", "_g"]).withColumn("_j", prefix(F.col("_k")))
             .withColumn("_lo", F.col("_j") * stride + prefix(F.slice("_cuts", F.col("_j") * stride + 1, stride - 1))))
    b = F.col("_lo") if ascending else F.coalesce(F.size("_cuts"), F.lit(0)) - F.col("_lo")
    return (found.withColumn("_b", F.when(v.isNull(), F.lit(buckets + 1 if nulls_last else -1)).otherwise(b))
            .drop("_cuts", "_k", "_j", "_lo"))


def _ranked(dv: DataFrame, buckets: int, ascending: bool, nulls_last: bool) -> DataFrame:
    """(_m, _g, _v, _rank) by bucket offsets plus a running sum inside each (spec, group, bucket)."""
    v = F.col("_v")
    order = ((v.asc_nulls_last() if nulls_last else v.asc_nulls_first()) if ascending else
             (v.desc_nulls_last() if nulls_last else v.desc_nulls_first()))
    dv = _with_bucket(dv, buckets, ascending, nulls_last)
    tot = dv.groupBy("_m", "_g", "_b").agg(F.sum("_n").alias("_t"))
    w_off = Window.partitionBy("_m", "_g").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    off = tot.withColumn("_off", F.coalesce(F.sum("_t").over(w_off), F.lit(0))).drop("_t")
    w_in = Window.partitionBy("_m", "_g", "_b").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    inside = dv.withColumn("_cum", F.sum("_n").over(w_in))
    return (inside.join(off, ["_m", "_g", "_b"])
            .select("_m", "_g", "_v", (F.col("_off") + F.col("_cum") - F.col("_n") + 1).cast("long").alias("_rank")))


def _classes(df: DataFrame, specs: Sequence[RankSpec]) -> list[tuple[T.DataType, bool, bool, list]]:
    """Specs by key type and direction: those of one class are ranked in one pass."""
    found: dict = {}
    for i, s in enumerate(specs):
        key = _key_type(df, s)
        found.setdefault((key.simpleString(), s.ascending, s.nulls_last), (key, []))[1].append((i, s))
    return [(key, asc, last, own) for (_, asc, last), (key, own) in found.items()]


def ranked_values(df: DataFrame, specs: Sequence[RankSpec], buckets: int = 1024) -> list[DataFrame]:
    """(_m, _g, _v, _rank) tables, one per key type and direction: the rank of every distinct value.

    The distinct (spec, group, value) counts are written once per class.
    """
    return [_ranked(materialize(_stack(df, own, key).groupBy("_m", "_g", "_v").agg(F.count(F.lit(1)).alias("_n")),
                                "rank-values"), buckets, asc, last)
            for key, asc, last, own in _classes(df, specs)]


ROW = "_row"


def numbered(df: DataFrame, name: str = "numbered-rows") -> DataFrame:
    """``df`` written once with a number of its own for every row (``ROW``)."""
    return materialize(df.withColumn(ROW, F.monotonically_increasing_id()), name)


def rank_columns(df: DataFrame, specs: Sequence[RankSpec], buckets: int = 1024, row_id: str | None = None) -> DataFrame:
    """Add one ``rank()`` column per spec (BIGINT).

    Building it runs jobs: the distinct values, then their ranks, are
    written.  Two joins bring back the ranks of all specs, however many: the
    rows' keys, stacked as (row, spec, group, value), meet the ranked values,
    one aggregate folds a row's ranks into one row, and that joins the rows
    on their number.  ``row_id``: a column of a written ``df`` that is unique;
    without one the rows are numbered and written first.
    """
    kept = df.columns
    if row_id is None:
        df, row_id = numbered(df), ROW
    classes = _classes(df, specs)
    ranks, keys = None, []
    for c, ((key, _, _, own), ranked) in enumerate(zip(classes, ranked_values(df, specs, buckets), strict=True)):
        part = ranked.withColumnRenamed("_v", f"_v{c}")
        ranks = part if ranks is None else ranks.unionByName(part, allowMissingColumns=True)
        keys += [F.struct(F.lit(i).alias("_m"), _group_key(s).alias("_g"),
                          *[(F.col(s.order_by) if k == c else F.lit(None)).cast(other[0]).alias(f"_v{k}")
                            for k, other in enumerate(classes)]) for i, s in own]
    ranks = materialize(ranks, "ranks")
    stacked = df.select(F.col(row_id).alias("_id"), F.inline(F.array(*keys)))
    found = ranks.select(*[F.col(c).alias(f"_r{c}") for c in ranks.columns])
    same = (F.col("_m") == F.col("_r_m")) & (F.col("_g") == F.col("_r_g"))
    for c in range(len(classes)):
        same = same & F.col(f"_v{c}").eqNullSafe(F.col(f"_r_v{c}"))
    wide = (stacked.join(found, same).groupBy("_id")
            .agg(*[F.max(F.when(F.col("_m") == i, F.col("_r_rank"))).alias(s.out) for i, s in enumerate(specs)]))
    out = df.join(wide, F.col(row_id) == F.col("_id"))
    return out.select(*kept, *[s.out for s in specs])


def topn_per_group(df: DataFrame, n: int, partition_by: Sequence[str], order_by: Sequence[Column],
                   rank_col: str = "rank") -> DataFrame:
    """Rows whose ``rank()`` within the group is <= n (ties kept).

    The filter right above the window lets Catalyst insert a partial
    WindowGroupLimit before the shuffle: each map task keeps only its own
    top-n (with ties) per group, so a hot group ships at most n rows per task.
    """
    w = Window.partitionBy(*partition_by).orderBy(*order_by)
    return df.withColumn(rank_col, F.rank().over(w)).filter(F.col(rank_col) <= n)


def latest_per_key(df: DataFrame, key: Sequence[str], order: str, values: Sequence[str],
                   tie_break: Sequence[str] = ()) -> DataFrame:
    """Value columns of the row with the greatest ``order`` per key.

    ``max(struct(order, tie_break..., values...))`` is a partial aggregate,
    so a key with many rows is reduced map-side.  Ties on ``order`` go to
    the greatest tie-break, then the greatest values: repeatable.
    """
    fields = [order, *tie_break, *[v for v in values if v not in tie_break]]
    best = F.max(F.struct(*[F.col(c) for c in fields])).alias("_best")
    return df.groupBy(*key).agg(best).select(*key, *[F.col("_best")[v].alias(v) for v in values])


def dedupe_precedence(df: DataFrame, key: Sequence[str], precedence: Column, values: Sequence[str],
                      tie_break: Sequence[str] = ()) -> DataFrame:
    """One row per key: lowest ``precedence``, then the smallest tie-break/values.

    Same partial-aggregate shape as :func:`latest_per_key`.
    """
    tb = list(tie_break) or list(values)
    fields = [precedence.alias("_prec"), *[F.col(c) for c in tb],
              *[F.col(v) for v in values if v not in tb]]
    best = F.min(F.struct(*fields)).alias("_best")
    return df.groupBy(*key).agg(best).select(*key, *[F.col("_best")[v].alias(v) for v in values])

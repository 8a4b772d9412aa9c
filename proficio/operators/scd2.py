"""SCD type 2 history with the 'check' strategy.

A version row carries the key, the checked columns, ``scd_id``,
``updated_at``, ``valid_from`` and ``valid_to`` (NULL = current).  A run
compares the current versions with the new snapshot on the key (full outer
join, NULL-safe comparison of the checked columns):

* changed values close the current version and open a new one;
* a key missing from the snapshot is closed (hard delete invalidation);
* a new or re-appearing key opens a version;
* unchanged keys and closed versions pass through untouched.

Only current versions take part in the join (one full outer join; each
joined row emits the old version and the one it opens); closed history is a
plain union.

``snapshot_run`` keeps a log of changes: a run is the folder
``snapshot_run=<n>`` with the versions it opened (``state=open``) and those it
closed (``state=closed``), and nothing of what stayed.  The current version of
a key is the newest in the log, if that is an opened one, found by an
aggregate on the key that the comparison's join is partitioned by as well;
the history is these and all closed versions.  So a run writes what changed,
and an unchanged snapshot writes no row.  ``compact`` puts down the whole
current state of a run (``state=base``), from where later reads start.  A run
counts once its one write job has left its ``_SUCCESS`` marker; a torn run is
ignored and replaced by the next attempt.  NULL and duplicate keys stop that
job: the check is a count over PARTITION BY key evaluated inside it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from proficio.operators.upsert import DuplicateKeyError, NullKeyError, _children, is_committed
from proficio.session import drop_path

META = ["scd_id", "updated_at", "valid_from", "valid_to"]
RUN_COL = "snapshot_run"


def _scd_id(keys: Sequence[str], at: Column) -> Column:
    """A digest of the keys and the time, as JSON: no two keys or times read alike."""
    return F.sha2(F.to_json(F.array(*[F.col(k).cast("string") for k in keys],
                                    F.date_format(at, "yyyy-MM-dd HH:mm:ss.SSSSSS"))), 256)


DUP_MSG = "duplicate snapshot key"
NULL_MSG = "NULL in the snapshot key"
STATE_COL = "state"


def _unique_marker(keys: Sequence[str]) -> Column:
    """TRUE on every row, but stops the job when the row's key is NULL or occurs twice.

    A count over PARTITION BY key: same hash partitioning as the comparison's
    join on the key, so the check adds no shuffle and no separate job.
    """
    n = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    null = F.lit(False)
    for k in keys:
        null = null | F.col(k).isNull()
    return (F.when(null, F.raise_error(F.lit(f"{NULL_MSG} ({', '.join(keys)})")))
            .when(n > 1, F.raise_error(F.lit(f"{DUP_MSG} ({', '.join(keys)})"))).otherwise(F.lit(True)))


def _first(snapshot: DataFrame, keys: Sequence[str], check_cols: Sequence[str], at: Column) -> DataFrame:
    """Every snapshot row opens a version (first run)."""
    cols = [*keys, *check_cols]
    snapshot = (snapshot.withColumn("_ok", _unique_marker(keys)).filter(F.col("_ok"))
                .drop("_ok"))
    return snapshot.select(*cols, _scd_id(keys, at).alias("scd_id"), at.alias("updated_at"),
                           at.alias("valid_from"), F.lit(None).cast("timestamp_ntz").alias("valid_to"))


def scd2_apply(history: DataFrame | None, snapshot: DataFrame, keys: Sequence[str],
               check_cols: Sequence[str], run_at: Column,
               invalidate_hard_deletes: bool = True) -> DataFrame:
    """New history = old history + this snapshot (pure DataFrame function).

    One full outer join of the current versions with the snapshot on the key;
    each joined row emits up to two version rows (the old one, kept or
    closed, and the one it opens), so both sides are shuffled once.
    """
    cols = [*keys, *check_cols]
    snap = snapshot.select(*cols)
    at = run_at.cast("timestamp_ntz")
    if history is None:
        return _first(snap, keys, check_cols, at)
    hist = history.select(*cols, *META)
    closed = hist.filter(F.col("valid_to").isNotNull())
    cur = hist.filter(F.col("valid_to").isNull())
    return closed.unionByName(_versions(cur, snap, keys, check_cols, at, invalidate_hard_deletes, unchanged=True))


def _versions(cur: DataFrame, snap: DataFrame, keys: Sequence[str], check_cols: Sequence[str], at: Column,
              invalidate_hard_deletes: bool, unchanged: bool) -> DataFrame:
    """The versions that the snapshot closes and opens, and with ``unchanged`` those that stay open."""
    cols = [*keys, *check_cols]
    o = cur.select(*[F.col(c).alias(f"_o_{c}") for c in cur.columns])
    n = snap.select(*[F.col(c).alias(f"_n_{c}") for c in cols])
    # the duplicate check partitions by the join key itself: one shuffle serves both
    n = n.withColumn("_n_here", _unique_marker([f"_n_{k}" for k in keys]))
    on = None
    for k in keys:
        e = F.col(f"_o_{k}") == F.col(f"_n_{k}")
        on = e if on is None else on & e
    j = o.join(n, on, "full_outer")
    old_here = F.col("_o_scd_id").isNotNull()
    new_here = F.col("_n_here").isNotNull()
    same = F.lit(True)
    for c in check_cols:
        same = same & F.col(f"_o_{c}").eqNullSafe(F.col(f"_n_{c}"))
    changed = old_here & new_here & ~same
    gone = old_here & ~new_here if invalidate_hard_deletes else F.lit(False)
    no_end = F.lit(None).cast("timestamp_ntz")
    # the current version: kept open, or closed at this run
    old_row = F.when(old_here if unchanged else changed | gone, F.struct(
        *[F.col(f"_o_{c}").alias(c) for c in cols],
        F.col("_o_scd_id").alias("scd_id"), F.col("_o_updated_at").alias("updated_at"),
        F.col("_o_valid_from").alias("valid_from"),
        F.when(changed | gone, at).otherwise(no_end).alias("valid_to")))
    # the version this run opens (new key, re-appearing key, or changed values)
    new_cols = [F.col(f"_n_{c}").alias(c) for c in cols]
    new_row = F.when(new_here & (~old_here | changed), F.struct(
        *new_cols,
        _scd_id([f"_n_{k}" for k in keys], at).alias("scd_id"), at.alias("updated_at"),
        at.alias("valid_from"), no_end.alias("valid_to")))
    return (j.select(F.explode(F.array(old_row, new_row)).alias("_r"))
             .filter(F.col("_r").isNotNull()).select("_r.*"))


def _runs(spark: SparkSession, path: str) -> list[int]:
    """Committed run numbers at ``path``: ``snapshot_run=<n>`` folders with a ``_SUCCESS`` marker."""
    base = path.rstrip("/")
    runs = [int(n.split("=", 1)[1]) for n in _children(spark, base) if n.startswith(RUN_COL + "=")]
    return sorted(n for n in runs if is_committed(spark, f"{base}/{RUN_COL}={n}"))


def _parts(spark: SparkSession, path: str, runs: Sequence[int], state: str) -> list[str]:
    base = path.rstrip("/")
    found = [f"{base}/{RUN_COL}={n}" for n in runs]
    found = [f"{f}/{STATE_COL}={state}" for f in found if f"{STATE_COL}={state}" in _children(spark, f)]
    # a base is written after its run, by a job with a marker of its own
    return [f for f in found if is_committed(spark, f)] if state == "base" else found


def _run_of(folder: str) -> int:
    return int(folder.split(f"/{RUN_COL}=")[-1].split("/")[0])


def _read(spark: SparkSession, path: str, paths: list[str]) -> DataFrame | None:
    """Versions of some folders, with ``RUN_COL`` and ``STATE_COL``."""
    return spark.read.option("basePath", path.rstrip("/")).parquet(*paths) if paths else None


def current(spark: SparkSession, path: str, n: int, keys: Sequence[str] | None = None) -> DataFrame | None:
    """The open versions after run ``n``: of every key the newest version in the log, unless that is a closed one.

    ``keys``: the key columns; without them (a reader that knows none) an open
    version is one whose ``scd_id`` has not been closed since.
    """
    runs = [k for k in _runs(spark, path) if k <= n]
    bases = _parts(spark, path, runs, "base")
    since = [k for k in runs if not bases or k > _run_of(bases[-1])]
    opened = _read(spark, path, bases[-1:] + _parts(spark, path, since, "open"))
    closed = _read(spark, path, _parts(spark, path, since, "closed"))
    if opened is None:
        return None
    rows = opened.drop(RUN_COL, STATE_COL)
    if closed is None:
        return rows
    if keys is None:
        return rows.join(closed.select("scd_id"), "scd_id", "left_anti").select(*rows.columns)
    log = opened.unionByName(closed)
    newest = F.max_by(F.struct(*rows.columns), F.struct(F.col(RUN_COL), F.col("valid_to").isNull()))
    return (log.groupBy(*[F.col(k).alias(f"_k_{k}") for k in keys]).agg(newest.alias("_v")).select("_v.*")
            .where("valid_to is null"))


def read_run(spark: SparkSession, path: str, n: int) -> DataFrame:
    """The state after run ``n``: its open versions and all versions closed up to it."""
    runs = [k for k in _runs(spark, path) if k <= n]
    closed = _read(spark, path, _parts(spark, path, runs, "closed"))
    both = [d for d in (current(spark, path, n), closed.drop(RUN_COL, STATE_COL) if closed is not None else None)
            if d is not None]
    if not both:
        raise ValueError(f"run {n} of {path} holds no version")
    return both[0] if len(both) == 1 else both[0].unionByName(both[1])


def _is_empty(spark: SparkSession, path: str, runs: Sequence[int]) -> bool:
    return not any(_parts(spark, path, runs, s) for s in ("open", "closed", "base"))


def latest(spark: SparkSession, path: str) -> tuple[int, DataFrame | None]:
    """(run number, state) of the newest committed run stored at ``path``."""
    runs = _runs(spark, path)
    if _is_empty(spark, path, runs):
        return (runs[-1] if runs else 0), None
    return runs[-1], read_run(spark, path, runs[-1])


def compact(spark: SparkSession, path: str, keys: Sequence[str], keep_runs: int = 1) -> None:
    """Write the open versions of the oldest of the newest ``keep_runs`` runs as its base, then drop what it replaces.

    Runs before it can no longer be read as they were; closed history stays.
    A base counts once its job has left its marker, and only then are the
    older open versions dropped.
    """
    runs = _runs(spark, path)
    if len(runs) <= keep_runs:
        return
    first = runs[-keep_runs]
    base = path.rstrip("/")
    if not _parts(spark, path, [first], "base"):
        rows = current(spark, path, first, keys)
        if rows is None:
            return
        rows.write.mode("overwrite").parquet(f"{base}/{RUN_COL}={first}/{STATE_COL}=base")
    for state in ("open", "base"):
        for folder in _parts(spark, path, [n for n in runs if n < first], state):
            drop_path(spark, folder)


def snapshot_run(spark: SparkSession, path: str, snapshot: DataFrame, keys: Sequence[str],
                 check_cols: Sequence[str], run_at: Column,
                 invalidate_hard_deletes: bool = True, keep_runs: int | None = None) -> DataFrame:
    """Apply one snapshot run to the history stored at ``path``; return the new state.

    One write action, of the changes alone: the comparison and the key checks
    run inside it; a bad key aborts the job, so the run is not committed.
    ``keep_runs`` (optional) compacts the log after the commit, so that the
    newest runs alone can be read as they were; closed history stays.
    """
    runs = _runs(spark, path)
    n = runs[-1] if runs else 0
    at = run_at.cast("timestamp_ntz")
    open_before = current(spark, path, n, keys) if runs else None
    changes = (_first(snapshot, keys, check_cols, at) if open_before is None else
               _versions(open_before, snapshot.select(*keys, *check_cols), keys, check_cols, at, invalidate_hard_deletes,
                         unchanged=False))
    base = path.rstrip("/")
    try:
        (changes.withColumn(STATE_COL, F.when(F.col("valid_to").isNull(), "open").otherwise("closed"))
         .write.mode("overwrite").option("partitionOverwriteMode", "static")
         .partitionBy(STATE_COL).parquet(f"{base}/{RUN_COL}={n + 1}"))
    except Exception as e:  # the in-job key checks surface as a job failure
        if DUP_MSG in str(e):
            raise DuplicateKeyError(f"{DUP_MSG} in snapshot for {path}") from e
        if NULL_MSG in str(e):
            raise NullKeyError(f"{NULL_MSG} for {path}") from e
        raise
    if _is_empty(spark, path, _runs(spark, path)):
        return spark.createDataFrame([], changes.schema)
    if keep_runs:
        compact(spark, path, keys, keep_runs)
    return read_run(spark, path, n + 1)

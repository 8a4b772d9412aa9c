"""Yearly releases arriving as files, merged into a fact table by a stream.

``merge_releases`` runs a Structured Streaming query over a landing folder:
every micro-batch holds the newly arrived release files; release by release,
rows are reduced to one per raw key (a partial aggregate), turned into model
rows by ``to_rows`` (staging + model, plain DataFrame code) and MERGEd into
the partitioned table with :func:`proficio.operators.upsert.upsert`.

The checkpoint (in the shared folder) records which files were processed,
so each file is merged once; a batch that fails after its write is rerun,
and the MERGE of the same rows is idempotent.  The target keeps each row's
release in ``RELEASE_COL``; a row merges only over a row of the same or an
older release, so releases may land in any order.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from proficio.operators.ranking import latest_per_key
from proficio.operators.upsert import folders, read_table, table_exists, upsert
from proficio.session import shared_dir


RELEASE_COL = "_release"


def not_older(spark: SparkSession, target: str, rows: DataFrame, keys: Sequence[str],
              partition_col: str) -> DataFrame:
    """The rows whose release is no older than the target's row of the same key."""
    if not table_exists(spark, target):
        return rows
    touched = [r[0] for r in rows.select(partition_col).distinct().collect()]
    parts = folders(spark, target, partition_col, touched)
    if not parts:
        return rows
    stored = read_table(spark, target, parts).select(*keys, F.col(RELEASE_COL).alias("_stored"))
    newer = stored.join(rows.select(*keys, RELEASE_COL), list(keys)).where(F.col("_stored") > F.col(RELEASE_COL))
    return rows.join(newer.select(*keys), list(keys), "left_anti")


def newest_release(df: DataFrame, raw_keys: Sequence[str], release_col: str) -> DataFrame:
    """The row of the highest release per raw key."""
    values = [c for c in df.columns if c not in raw_keys and c != release_col]
    return latest_per_key(df, raw_keys, release_col, values)


def merge_releases(spark: SparkSession, landing: str, schema: StructType,
                   to_rows: Callable[[DataFrame], DataFrame], target: str,
                   raw_keys: Sequence[str], keys: Sequence[str], partition_col: str,
                   release_col: str = "release", checkpoint: str | None = None,
                   max_files_per_trigger: int | None = None) -> None:
    """Process every release file available now under ``landing``, then stop.

    The default checkpoint is derived from the target path, so repeated runs
    for the same target resume where the previous one stopped.
    """
    if checkpoint is None:
        digest = hashlib.sha1(target.rstrip("/").encode()).hexdigest()[:16]
        checkpoint = f"{shared_dir(spark).rstrip('/')}/proficio/release-stream-{digest}"
    ckpt = checkpoint

    def merge_batch(batch: DataFrame, batch_id: int) -> None:
        # one MERGE per release of the batch, oldest first (a batch holds few releases)
        for r in sorted(x[0] for x in batch.select(release_col).distinct().collect()):
            rows = to_rows(newest_release(batch.where(F.col(release_col) == F.lit(r)), raw_keys, release_col))
            rows = rows.withColumn(RELEASE_COL, F.lit(r))
            upsert(batch.sparkSession, target, not_older(batch.sparkSession, target, rows, keys, partition_col),
                   keys, partition_col)

    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    q = (reader.parquet(landing).writeStream.foreachBatch(merge_batch)
         .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    q.awaitTermination()

"""Exact dedup by a heavy-hitter split.

Every text becomes a SHA-256 digest once, in a small written table.  A
Misra-Gries summary per task finds the digests that may be frequent; their
exact group size and winner are then verified, and these few rows (at most
``counters + 1``) are broadcast, so copies in a hot group are judged without
moving them.  All other digests go through an ordinary shuffle, where one
group holds at most ``2 / (counters + 1)`` of the rows.

Defined cases: a null text counts as the empty text; the row with the largest
doc_id of a group stays (nulls are smallest); of rows repeated with the same
doc_id and text exactly one stays; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from proficio.llm._util import fresh, lower_ascii
from proficio.session import materialize

COUNTERS = 256


def text_digest(text):
    """SHA-256 (lowercase hex) of a text column after lower-casing A-Z only."""
    return F.sha2(lower_ascii(F.coalesce(text, F.lit(""))), 256)


def misra_gries(counters: int):
    """A mapInArrow function: at most ``counters`` (digest, count) rows a task.

    Batches are counted and merged into the summary; whenever it holds more
    than ``counters`` keys, the (counters + 1)-th largest count is subtracted
    from all of them.  A digest's count falls short by at most
    rows / (counters + 1).
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, int] = {}
        for batch in batches:
            for pair in batch.column(0).value_counts().to_pylist():
                held[pair["values"]] = held.get(pair["values"], 0) + pair["counts"]
            if len(held) > counters:
                cut = int(np.partition(np.fromiter(held.values(), np.int64, len(held)),
                                       -(counters + 1))[-(counters + 1)])
                held = {k: v - cut for k, v in held.items() if v > cut}
        yield pa.RecordBatch.from_pydict(
            {"digest": pa.array(list(held), pa.string()),
             "n": pa.array(list(held.values()), pa.int64())})
    return run


def frequent_winners(per_doc: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """(digest, keep_id, group_size) of the verified heavy digests; at most ``counters + 1`` rows.

    ``per_doc`` must be a written table of (digest, doc_id, n).  The summaries
    fall short by at most N / (counters + 1) in all, so every digest with over
    2 N / (counters + 1) documents passes the filter, and at most
    ``counters + 1`` digests can.
    """
    total = per_doc.count()
    held = per_doc.select("digest").mapInArrow(misra_gries(counters), "digest string, n bigint")
    candidates = (held.groupBy("digest").agg(F.sum("n").alias("n"))
                  .where(F.col("n") > max(1.0, total / (counters + 1)))
                  .select("digest"))
    candidates = materialize(candidates.coalesce(1), "dedup-candidates")
    exact = (per_doc.join(F.broadcast(candidates), "digest")
             .groupBy("digest").agg(F.max("doc_id").alias("keep_id"), F.sum("n").alias("group_size")))
    return materialize(exact.coalesce(1), "dedup-winners")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                counters: int = COUNTERS) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256, copies.

    ``copies`` is the number of rows with this doc_id and text.  The result
    stands on a written table of (digest, doc_id) rows in the shared folder.
    """
    return _judged(docs, id_col, text_col, counters)[0]


def _judged(docs: DataFrame, id_col: str, text_col: str, counters: int) -> tuple[DataFrame, DataFrame]:
    """The rows of :func:`exact_dedup` and the winners of the heavy digests."""
    per_doc = materialize(
        docs.select(text_digest(F.col(text_col)).alias("digest"), F.col(id_col).alias("doc_id"))
            .groupBy("digest", "doc_id").agg(F.count("*").alias("n")), "dedup-digests")
    winners = frequent_winners(per_doc, counters)
    heavy = per_doc.join(F.broadcast(winners), "digest")
    rest = per_doc.join(F.broadcast(winners.select("digest")), "digest", "left_anti")
    groups = rest.groupBy("digest").agg(F.max("doc_id").alias("keep_id"),
                                        F.sum("n").alias("group_size"))
    judged = heavy.unionByName(rest.join(groups, "digest"))
    rows = (judged.select("doc_id", "keep_id", "group_size", "digest", F.col("n").alias("copies"),
                          F.explode(F.sequence(F.lit(1).cast("bigint"), "n")).alias("copy"))
            .select("doc_id", "keep_id", "group_size",
                    (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"),
                    F.col("digest").alias("text_sha256"), "copies"))
    return rows, winners


def drop_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    counters: int = COUNTERS) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    Copies of heavy digests are removed map-side by the broadcast winners;
    the others by an anti join with the dropped (digest, doc_id) rows.
    """
    rows, winners = _judged(docs, id_col, text_col, counters)
    judged = materialize(rows, "dedup-judged")
    digest, w_digest, w_keep, d_digest, d_id = (
        fresh(docs, c) for c in ("text_digest", "w_digest", "w_keep", "d_digest", "d_id"))
    heavy = F.broadcast(winners.select(F.col("digest").alias(w_digest), F.col("keep_id").alias(w_keep)))
    keyed = docs.withColumn(digest, text_digest(F.col(text_col)))
    dropped = (judged.where(~F.col("kept") & ~F.col("doc_id").eqNullSafe(F.col("keep_id")))
               .select(F.col("text_sha256").alias(d_digest), F.col("doc_id").alias(d_id))
               .join(heavy, F.col(d_digest) == F.col(w_digest), "left_anti").distinct())
    light = keyed.join(heavy, (keyed[digest] == F.col(w_digest))
                       & ~keyed[id_col].eqNullSafe(F.col(w_keep)), "left_anti")
    kept = light.join(dropped, (light[digest] == F.col(d_digest))
                      & light[id_col].eqNullSafe(F.col(d_id)), "left_anti")
    if not judged.where("copies > 1").isEmpty():  # rows repeated with the same doc_id and text
        kept = kept.dropDuplicates([digest, id_col])
    return kept.drop(digest)

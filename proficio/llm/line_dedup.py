"""Removal of boilerplate lines that are spread over many sites.

Every line becomes a 128-bit key.  A HyperLogLog sketch of the sites is built
per key and merged by aggregation, so a line that is in a third of all
documents costs one small sketch a task.  Keys whose estimate is near the
threshold get an exact distinct count.  Lines on at least ``min_sites`` sites
are removed everywhere.  The lines are cut from the texts anew for each of
these steps; only the few keys near or over the threshold are written.

Defined cases: a null text has no lines and stays null; blank lines are never
removed; a null site is no site; documents repeated under one doc_id are each
cleaned; lines are compared exactly, without their leading and trailing
blanks.  A document whose lines all go keeps an empty text.  Columns that the
input has may not be named like those that are added: that raises an error.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from proficio.llm._util import fresh
from proficio.session import materialize

MIN_SITES = 10
LG_K = 12


def line_key(line: Column) -> Column:
    return F.unhex(F.md5(F.trim(line)))


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def line_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               site_col: str = "source") -> DataFrame:
    """(doc_id, site, key) of every line that is not blank."""
    return (docs.select(F.col(id_col).alias("doc_id"), F.col(site_col).alias("site"),
                        F.explode(_lines(F.col(text_col))).alias("line"))
            .where(F.trim("line") != "")
            .select("doc_id", "site", line_key(F.col("line")).alias("key")))


def boilerplate(lines: DataFrame, min_sites: int = MIN_SITES, lg_k: int = LG_K) -> DataFrame:
    """The keys on at least ``min_sites`` sites.

    Estimates further than four standard errors (and one site) from the
    threshold decide by themselves, the others are counted exactly.
    """
    margin = 1 + 4 * 1.04 / 2 ** (lg_k / 2) * min_sites
    spread = materialize(
        lines.where("site is not null").groupBy("key")
        .agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(lg_k))).alias("sites"))
        .where(F.col("sites") >= min_sites - margin), "line-spread")
    sure = spread.where(F.col("sites") > min_sites + margin).select("key")
    near = spread.where(F.col("sites") <= min_sites + margin).select("key")
    counted = (lines.where("site is not null").join(near, "key", "left_semi")
               .select("key", "site").distinct()
               .groupBy("key").count().where(F.col("count") >= min_sites).select("key"))
    return sure.unionByName(counted)


def drop_boilerplate(docs: DataFrame, min_sites: int = MIN_SITES, lg_k: int = LG_K,
                     id_col: str = "doc_id", text_col: str = "text", site_col: str = "source",
                     kept_col: str = "kept_text") -> DataFrame:
    """``docs`` with ``kept_col``, ``n_lines`` and ``n_removed`` added.

    Only each document's own boilerplate keys are gathered (a set no larger
    than the document), then joined back on the document's id.
    """
    clash = {c.lower() for c in docs.columns} & {c.lower() for c in (kept_col, "n_lines", "n_removed")}
    if clash:
        raise ValueError(f"the documents have columns named like results: {sorted(clash)}")
    lines = line_table(docs, id_col, text_col, site_col)
    spread = materialize(boilerplate(lines, min_sites, lg_k), "boilerplate-keys")
    hits = (lines.join(spread, "key", "left_semi")
            .groupBy("doc_id").agg(F.collect_set("key").alias("gone")))
    gone, hit_id = fresh(docs, "gone_keys"), fresh(docs, "hit_doc_id")
    hits = hits.select(F.col("doc_id").alias(hit_id), F.col("gone").alias(gone))
    joined = docs.join(hits, docs[id_col].eqNullSafe(F.col(hit_id)), "left")
    all_lines = _lines(F.col(text_col))
    kept = F.when(F.col(gone).isNull(), all_lines).otherwise(
        F.filter(all_lines, lambda x: (F.trim(x) == "") | ~F.array_contains(F.col(gone), line_key(x))))
    kept_arr = fresh(joined, "kept_lines")
    return (joined.withColumn(kept_arr, kept)
            .withColumn(kept_col, F.array_join(kept_arr, "\n"))
            .withColumn("n_lines", F.coalesce(F.size(all_lines), F.lit(0)).cast("bigint"))
            .withColumn("n_removed", F.coalesce(F.size(all_lines) - F.size(kept_arr), F.lit(0)).cast("bigint"))
            .drop(kept_arr, gone, hit_id))

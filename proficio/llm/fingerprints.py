"""Merkle fingerprints of documents over sections, paragraphs and sentences.

Leaves are the sentences of a paragraph (line), hashed by MD5; a paragraph's
node hashes its leaves, a section's node its paragraphs, and the root its
sections.  A section ends after a paragraph whose hash starts with 0 or 1, so
an inserted paragraph moves no later boundary.  Roots are equal when texts
are equal; where roots differ, the branches that differ locate the edits.

The fingerprint string is ``root:section;section...`` with each section
``node=paragraph,paragraph...`` and each paragraph ``node/leaf8leaf8...``.
The likeness of two fingerprints is 1 for equal roots, else the Dice
coefficient of their sets of leaves.

Defined cases: a null text counts as empty and has one empty leaf; documents
are ordered by doc_id (nulls first), ties by text; the one document of a
one-row table is its own next; an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from proficio.llm._util import shuffle_partitions


def paragraph_leaves(text: Column) -> Column:
    """array<array<leaf>>: MD5 hex of each sentence of each paragraph."""
    return F.transform(F.split(text, "\n", -1),
                       lambda p: F.transform(F.split(p, r"\. ", -1), lambda s: F.md5(s)))


def paragraphs(leaves: Column) -> Column:
    """array<struct<node, leaves>>; node is the MD5 over the full leaf hashes."""
    return F.transform(leaves, lambda p: F.struct(
        F.md5(F.array_join(p, "")).alias("node"),
        F.array_join(F.transform(p, lambda h: F.left(h, F.lit(8))), "").alias("leaves")))


def sections(pars: Column) -> Column:
    """array<string>: each section as ``node/leaves,node/leaves...`` with full paragraph nodes."""
    marked = F.transform(pars, lambda p: F.concat(
        p.node, F.lit("/"), p.leaves, F.when(p.node < "2", F.lit(";")).otherwise(F.lit(","))))
    return F.split(F.regexp_replace(F.array_join(marked, ""), "[,;]$", ""), ";", -1)


def section_nodes(secs: Column) -> Column:
    return F.transform(secs, lambda s: F.md5(F.regexp_replace(s, "/[0-9a-f]*,?", "")))


def fingerprint(secs: Column) -> Column:
    nodes = section_nodes(secs)
    shown = F.transform(secs, lambda s: F.concat(
        F.left(F.md5(F.regexp_replace(s, "/[0-9a-f]*,?", "")), F.lit(8)), F.lit("="),
        F.regexp_replace(s, "([0-9a-f]{8})[0-9a-f]{24}/", "$1/")))
    return F.concat(F.md5(F.array_join(nodes, "")), F.lit(":"), F.array_join(shown, ";"))


def leaf_set(fp: Column) -> Column:
    """The distinct leaves in a fingerprint string."""
    leaves = F.regexp_replace(F.substring_index(fp, ":", -1), "[0-9a-f]{8}[=/]|[,;]", "")
    return F.array_distinct(F.regexp_extract_all(leaves, F.lit("([0-9a-f]{8})"), 1))


def likeness(fp_a: Column, leaves_a: Column, fp_b: Column, leaves_b: Column) -> Column:
    """0 to 1: 1 for equal fingerprints, else Dice over the leaf sets."""
    shared = F.size(F.array_intersect(leaves_a, leaves_b))
    return F.when(fp_a == fp_b, F.lit(1.0)).otherwise(
        2.0 * shared / (F.size(leaves_a) + F.size(leaves_b)))


def with_fingerprint(df: DataFrame, text_col: str, fp_col: str, leaves_col: str) -> DataFrame:
    """Adds the fingerprint of a text column and its distinct leaves (8 hex digits each)."""
    return (df.withColumn("_pars", paragraphs(paragraph_leaves(F.coalesce(text_col, F.lit("")))))
            .withColumn("_secs", sections(F.col("_pars")))
            .withColumn(fp_col, fingerprint(F.col("_secs")))
            .withColumn(leaves_col, leaf_set(F.col(fp_col)))
            .drop("_pars", "_secs"))


def differing_paragraphs(fp_a: Column, fp_b: Column) -> Column:
    """0-based positions of paragraphs of ``a`` whose branch is not in ``b``.

    Sections with equal nodes are skipped without looking below them.
    """
    cut = lambda fp: F.split(F.substring_index(fp, ":", -1), ";", -1)
    other = cut(fp_b)
    pars_b = F.flatten(F.transform(other, lambda s: F.split(F.substring_index(s, "=", -1), ",", -1)))
    flags = F.flatten(F.transform(cut(fp_a), lambda s: F.when(
        F.array_contains(other, s),
        F.transform(F.split(F.substring_index(s, "=", -1), ",", -1), lambda p: F.lit(False))).otherwise(
        F.transform(F.split(F.substring_index(s, "=", -1), ",", -1),
                    lambda p: ~F.array_contains(pars_b, p)))))
    numbered = F.transform(flags, lambda f, i: F.struct(f.alias("f"), i.alias("i")))
    return F.transform(F.filter(numbered, lambda x: x.f), lambda x: x.i)


def range_bucket(key: Column, bounds: list[int]) -> Column:
    """How many of the sorted ``bounds`` are <= key (0 for null), by a two-level search."""
    if not bounds:
        return F.lit(0)
    step = max(1, math.isqrt(len(bounds)))
    groups = [bounds[i:i + step] for i in range(0, len(bounds), step)]
    long_array = lambda xs: "array(" + ",".join(f"{x}L" if x > -2**63 else f"bigint('{x}')" for x in xs) + ")"
    heads = F.expr(long_array([g[0] for g in groups]))
    nested = F.expr("array(" + ",".join(long_array(g) for g in groups) + ")")
    coarse = F.size(F.filter(heads, lambda b: b <= key))
    fine = F.size(F.filter(F.get(nested, coarse - 1), lambda b: b <= key))
    return F.when(key.isNull() | (coarse == 0), F.lit(0)).otherwise((coarse - 1) * step + fine)


def with_next(docs: DataFrame, id_col: str, carried: list[str], buckets: int) -> DataFrame:
    """Adds ``next_<c>`` of the next row by ``id_col`` (nulls first, ties by ``carried``), cyclically.

    The ids are cut into ranges by an approximate quantile sketch whose bounds
    are ids of the table; each bound's row also goes to the range before it,
    as that range's last next row.  One shuffle of the rows, no global sort.
    """
    row = docs.agg(
        F.percentile_approx(id_col, [i / buckets for i in range(1, buckets)] or [0.5], 20 * buckets).alias("b"),
        F.min(id_col).alias("lo"), F.count(F.when(F.col(id_col).isNull(), 1)).alias("nulls")).first()
    bounds = sorted(set(row.b or []))
    first = F.col(id_col).isNull() if row.nulls else F.col(id_col) == F.lit(row.lo)
    bucket = range_bucket(F.col(id_col), bounds)
    known = docs.withColumn("_bucket", bucket)
    is_bound = F.col(id_col).isin(bounds) if len(bounds) <= 1 else \
        F.col(id_col) == F.get(F.expr("array(" + ",".join(f"bigint('{x}')" for x in bounds) + ")"), F.col("_bucket") - 1)
    own = F.struct(F.col("_bucket").alias("bucket"), F.lit(0).alias("tail"))
    before = F.struct((F.col("_bucket") - 1).alias("bucket"), F.lit(1).alias("tail"))
    around = F.struct(F.lit(len(bounds)).alias("bucket"), F.lit(2).alias("tail"))
    places = F.filter(F.array(own, F.when(F.coalesce(is_bound, F.lit(False)), before),
                              F.when(F.coalesce(first, F.lit(False)), around)), lambda x: x.isNotNull())
    placed = (known.withColumn("_place", F.explode(places)).drop("_bucket")
              .withColumn("_bucket", F.col("_place.bucket")).withColumn("_tail", F.col("_place.tail"))
              .drop("_place"))
    w = W.partitionBy("_bucket").orderBy("_tail", id_col, *carried)
    led = placed.select("*", *[F.lead(c).over(w).alias(f"next_{c}") for c in carried])
    return led.where("_tail = 0").drop("_bucket", "_tail")


def fingerprint_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       buckets: int | None = None) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    buckets = buckets or 4 * shuffle_partitions(docs.sparkSession)
    base = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(text_col, F.lit("")).alias("text"))
    base = with_fingerprint(base, "text", "fingerprint", "_leaves").drop("_leaves")
    led = with_next(base, "doc_id", ["text", "fingerprint"], buckets)
    half = F.floor(F.length("text") / 2).cast("int")
    edited = led.withColumn("edited", F.concat(F.left("text", F.length("text") - half), F.left("next_text", half)))
    edited = with_fingerprint(edited, "edited", "edited_fingerprint", "_edited_leaves")
    full = (edited.withColumn("_leaves", leaf_set(F.col("fingerprint")))
            .withColumn("_next_leaves", leaf_set(F.col("next_fingerprint"))))
    like = lambda fp, leaves: likeness(F.col("fingerprint"), F.col("_leaves"), F.col(fp), F.col(leaves))
    return full.select("doc_id", F.length("text").cast("bigint").alias("n_chars"),
                       F.sha2("edited", 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint",
                       like("edited_fingerprint", "_edited_leaves").alias("near_edited"),
                       like("next_fingerprint", "_next_leaves").alias("near_next"))

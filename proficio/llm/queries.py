"""The registered queries of the numbered operators: each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from proficio.llm import (
    chat_format,
    conversation_repair,
    exact_dedup,
    fingerprints,
    language_id,
    line_dedup,
    packing,
    sentencepiece_codec,
    simhash,
    substring_dedup,
    token_alignment,
    toxicity,
    url_filters,
)
from proficio.llm._util import table

Query = Callable[[SparkSession, str], DataFrame]


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]] | None = None) -> DataFrame:
    """A rule table (host, path, verdict) from a short list."""
    rows = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in (url_filters.RULES if rules is None else rules))
    if not rows:
        return spark.sql("SELECT '' AS host, '' AS path, '' AS verdict").where("false")
    return spark.sql(f"SELECT * FROM VALUES {rows} AS rules(host, path, verdict)")


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict, rule, host and path of every page's URL."""
    return url_filters.filter_urls(table(spark, sf_dir, "pages"), rule_table(spark))


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token count, checksum of the ids and digest of the decoded text of every document."""
    pieces = sentencepiece_codec.read_pieces("piece_bpe_32k.model")
    encoded = sentencepiece_codec.encode(table(spark, sf_dir, "documents"), pieces, how="merge")
    keyed = encoded.select("doc_id", "n_tokens", F.crc32("ids").alias("ids_crc32"), "ids")
    return (sentencepiece_codec.decode(keyed, pieces)
            .select("doc_id", "n_tokens", "ids_crc32", F.sha2("text", 256).alias("decoded_sha256")))


def learnable(docs: DataFrame) -> DataFrame:
    """The labelled documents outside the held-out quarter: crc32(doc_id as text) mod 4 is not 2."""
    return docs.where("lang is not null and crc32(cast(doc_id as string)) % 4 <> 2").select("doc_id", "text", "lang")


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document, learned on the documents that are not held out."""
    docs = table(spark, sf_dir, "documents")
    judged = language_id.identify(docs, language_id.train_model(learnable(docs)))
    return judged.select("doc_id", (F.crc32(F.col("doc_id").cast("string")) % 4 == 2).alias("held_out"),
                         "lang_pred", "score", "accepted")


def op4_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation rendered from every speaker's perspective, with loss masks; large parts in numbered pieces."""
    return chat_format.chat_views(table(spark, sf_dir, "conversations"))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Group, winner and verdict of every document among the equal texts."""
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents")).drop("copies")


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprint (4-word shingles) and component (4 bits or fewer apart) of every document."""
    return (simhash.simhash_groups(table(spark, sf_dir, "documents"), shingle=4, max_bits=4)
            .select("doc_id", "fingerprint", "component_id"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's token pieces with their places in sequences of at most 2048 tokens."""
    return packing.pack_documents(table(spark, sf_dir, "documents"), "word_bpe_49k.json", capacity=2048)


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text without the lines that are on ten or more sites, as a digest."""
    return (line_dedup.drop_boilerplate(table(spark, sf_dir, "documents"))
            .select("doc_id", "n_lines", "n_removed",
                    F.sha2(F.coalesce("kept_text", F.lit("")), 256).alias("kept_sha256")))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document before and after the removal of repeated 50-word passages."""
    return substring_dedup.repeated_words(table(spark, sf_dir, "documents"), window=50)


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merkle fingerprints of every document and of its edited text, with likenesses."""
    return fingerprints.fingerprint_report(table(spark, sf_dir, "documents"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cheapest repair and digest of every conversation after the test damage."""
    return conversation_repair.damage_report(table(spark, sf_dir, "conversations"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token, group and link counts of every document under two tokenizers, and the digest of its groups."""
    found = token_alignment.alignment_report(table(spark, sf_dir, "documents"), digest=True)
    return found.withColumnRenamed("groups", "groups_sha256")


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from the labels of documents that are not held out."""
    docs = table(spark, sf_dir, "documents")
    labels = (table(spark, sf_dir, "labels").where("crc32(cast(doc_id as string)) % 4 <> 2")
              .select("doc_id", "toxic"))
    scored = toxicity.score_documents(docs, toxicity.train_model(docs, labels))
    return scored.select("doc_id", (F.crc32(F.col("doc_id").cast("string")) % 4 == 2).alias("held_out"),
                         "score", "predicted", "n_sentences", "n_offending", "worst_begin")


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in (op1_url_filters, op2_sentencepiece, op3_language_id, op4_chat_formatting, op5_exact_dedup, op6_simhash,
                                    op7_packing, op8_line_dedup, op9_substring_dedup, op10_fingerprints,
                                    op11_conversation_repair, op12_token_alignment, op13_toxicity)}

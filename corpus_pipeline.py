"""The corpus pipeline: the documents that a model would be trained on, packed.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept
and returns a DataFrame that is written as Parquet and read again as the next
stage's ``docs``.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from proficio.llm import exact_dedup, language_id, packing, simhash, substring_dedup
from proficio.llm.queries import learnable
from proficio.session import materialize

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language of the table's own labels stay; those the language models reject go."""
    model = language_id.train_model(learnable(docs))
    return docs.where(language_id.judged(F.col("text"), model)["accepted"])


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (A-Z lower-cased) only the row with the largest doc_id stays."""
    return exact_dedup.drop_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays, the one with the smallest doc_id."""
    return simhash.drop_near_duplicates(docs, shingle=4, max_bits=4)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words in 50-word passages that a document with a smaller doc_id also has are cut; n_chars follows the text."""
    cut = substring_dedup.drop_repeated_passages(docs, window=50)
    return cut.withColumn("n_chars", F.length("text").cast("bigint"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The places of every remaining document's token pieces in sequences of at most 2048 tokens."""
    return packing.pack_documents(docs, "word_bpe_49k.json", capacity=2048)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", keep_known_languages),
    ("exact_dedup", drop_exact_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("substring_dedup", cut_repeated_passages),
    ("best_fit_packing", pack),
]

#: Language models, fingerprints and token ids are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply every stage to the whole ``documents`` table, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

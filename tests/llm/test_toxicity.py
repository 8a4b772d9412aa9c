"""Multiple-instance toxicity: held-out labels, located sentences, a brute-force noisy-or and the defined cases."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from proficio.llm import toxicity

DOCS = "doc_id bigint, text string"
BAD = ["zorgblat", "frumpnik", "zorgblatter"]


def made(n, seed):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(400)]
    rows, labels, where = [], [], {}
    for i in range(n):
        sentences = [" ".join(rng.choices(words, k=rng.randint(3, 9))) + "." for _ in range(rng.randint(1, 12))]
        toxic = i % 5 == 0
        if toxic:
            at = rng.randrange(len(sentences))
            sentences[at] = "You " + rng.choice(BAD) + " " + sentences[at]
            where[i] = at
        rows.append((i, " ".join(sentences)))
        labels.append((i, int(toxic)))
    return rows, labels, where


@pytest.fixture(scope="module")
def learned(spark):
    rows, labels, where = made(400, 1)
    docs = spark.createDataFrame(rows, DOCS)
    known = spark.createDataFrame(labels, "doc_id bigint, toxic int")
    return rows, dict(labels), where, docs, toxicity.train_model(docs.where("doc_id < 300"), known)


def test_held_out_documents_are_told_apart_and_sentences_located(spark, learned):
    rows, labels, where, docs, model = learned
    got = {r.doc_id: r for r in toxicity.score_documents(docs, model).collect()}
    assert [got[i].predicted for i, _ in rows if i >= 300] == [labels[i] for i, _ in rows if i >= 300]
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got.values())
    found = toxicity.offending_sentences(docs.where("doc_id >= 300"), model).collect()
    assert {r.doc_id for r in found} == {i for i in where if i >= 300}
    texts = dict(rows)
    for r in found:
        assert r.sentence == texts[r.doc_id][r.begin:r.begin + r.length]
        assert any(b in r.sentence for b in BAD)
        assert got[r.doc_id].worst_begin in {x.begin for x in found if x.doc_id == r.doc_id}


def test_scores_equal_a_brute_force_noisy_or(learned):
    rows, _, _, docs, model = learned
    got = {r.doc_id: r for r in toxicity.score_documents(docs.where("doc_id < 40"), model).collect()}
    for i, text in rows[:40]:
        clean = 1.0
        sentences = [s for s in text.split(".") if any(c.isalpha() for c in s)]
        for s in sentences:
            z = model.bias
            for w in s.lower().split():
                parts = {"^" + w + "$"} | {"^" + w[:n] for n in range(3, min(9, len(w)))} | {w[-n:] + "$" for n in range(3, min(9, len(w)))}
                z += sum(model.weights.get(p, 0.0) for p in parts)
            clean *= 1 - 1 / (1 + math.exp(-z))
        odds = min(max(math.log((1 - clean) / clean) if clean < 1 else -15, -15), 15)
        assert got[i].score == pytest.approx(1 / (1 + math.exp(-(model.slope * odds + model.offset))), abs=1e-6)
        assert got[i].n_sentences == len(sentences)


def test_defined_cases(spark, learned):
    model = learned[-1]
    odd = [(0, None), (1, ""), (2, "123 !!! \n"), (3, "fine words. You zorgblat there"), (3, "fine words. You zorgblat there"),
           (4, "calm " * 200_000 + ". you frumpnik."), (None, "İstanbul\x00 zorgblat")]
    df = spark.createDataFrame(odd, DOCS).withColumn("score", F.lit("x")).withColumn("d_id", F.lit(1)).withColumn("t_id", F.lit(2))
    got = toxicity.score_documents(df, model).collect()
    assert len(got) == len(odd)
    by_id = {r.doc_id: r for r in got}
    lowest = by_id[0].score
    assert [by_id[i].score for i in (1, 2)] == [lowest, lowest] and by_id[0].n_sentences == 0 and by_id[0].worst_begin is None
    assert lowest < 0.05
    assert [by_id[i].predicted for i in (3, 4, None)] == [1, 1, 1]
    assert by_id[4].worst_begin > 900_000
    assert toxicity.score_documents(df.limit(0), model).count() == 0
    assert toxicity.offending_sentences(df.limit(0), model).count() == 0


def test_labels_of_one_class_or_none_give_no_model(spark, learned):
    docs = learned[3]
    for labels in ([], [(0, 1), (5, 1)], [(1, 0)], [(1, None), (2, None)], [(None, 1), (None, 0)], [(10_000, 1), (10_001, 0)]):
        known = spark.createDataFrame(labels, "doc_id bigint, toxic int")
        model = toxicity.train_model(docs, known)
        assert model is None
    scored = toxicity.score_documents(docs, None)
    assert {(r.score, r.predicted) for r in scored.collect()} == {(0.0, 0)} and scored.count() == 400
    assert toxicity.offending_sentences(docs, None).count() == 0


def test_the_sample_is_bounded_and_a_label_of_toxic_wins(spark, learned):
    docs = learned[3].withColumn("t_toxic", F.lit(1)).withColumn("toxic", F.lit(0))
    known = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(400)] + [(1, 1), (1, 0), (2, None)], "doc_id bigint, toxic int")
    sample = toxicity.training_sample(docs.unionAll(docs), known, train_docs=30, max_train_chars=50).toPandas()
    assert sample["toxic"].value_counts().to_dict() == {0: 30, 1: 30}
    assert sample["text"].str.len().max() <= 50
    whole = toxicity.training_sample(docs, known)
    assert whole.count() == 400 and whole.where("toxic = 1").count() == 81
    one, two = toxicity.train_model(docs, known), toxicity.train_model(docs.repartition(7), known)
    assert one.weights == two.weights and (one.bias, one.slope, one.offset) == (two.bias, two.slope, two.offset)
    assert one.weights and np.isfinite(one.bias)

"""The corpus pipeline on a small table, stage by stage."""

import random
import re

import corpus_pipeline
from proficio.llm import simhash

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def table(spark, path):
    rnd = random.Random(11)
    words = {"en": [f"{a}{b}" for a in ("the", "ing", "er") for b in ("on", "at", "sh", "is")],
             "de": [f"{a}{b}" for a in ("ün", "sch", "ge") for b in ("er", "ich", "tz", "ei")]}
    text = lambda lang, n: " ".join(rnd.choice(words[lang]) for _ in range(n))
    rows = [(i, text(lang, rnd.randint(20, 200)), lang) for i in range(120) for lang in [("en", "de")[i % 2]]]
    passage = text("en", 70)
    rows += [(200, rows[4][1], "en"), (201, rows[4][1].upper().lower(), "en"), (202, None, "en"), (203, "123", None),
             (204, text("en", 30) + " " + passage, "en"), (205, passage + " " + text("en", 40), None),
             (206, rows[6][1] + " once", "en")]
    spark.createDataFrame([(d, t, x, f"s{d % 3}", len(t) if t else None) for d, t, x in rows], DOCS) \
        .write.parquet(f"{path}/documents.parquet")
    return {d: t for d, t, _ in rows}, passage


def test_stages(spark, tmp_path):
    texts, passage = table(spark, tmp_path)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    seen = {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, str(tmp_path))
        out.write.parquet(f"{tmp_path}/{k}")
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns and out.dtypes == docs.dtypes
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        seen[name] = {r.doc_id: r for r in docs.collect()}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "simhash_near_dedup",
                                                      "substring_dedup", "best_fit_packing"]
    assert set(seen["language_id"]) == set(texts) - {202, 203}
    last = {}
    for d in seen["language_id"]:
        last[texts[d].lower()] = max(d, last.get(texts[d].lower(), -1))
    assert set(seen["exact_dedup"]) == set(last.values()) and 201 in seen["exact_dedup"]
    least = {}
    fps = {d: simhash.simhash(texts[d]) for d in seen["exact_dedup"]}
    for d in sorted(fps):
        least[d] = next((least[e] for e in least if (fps[d] ^ fps[e]).bit_count() <= 4), d)
    assert set(seen["simhash_near_dedup"]) == set(least.values())
    cut = seen["substring_dedup"]
    assert set(cut) == set(seen["simhash_near_dedup"]) and all(r.n_chars == len(r.text) for r in cut.values())
    assert passage in re.sub(r"\s+", " ", cut[204].text) and passage[:100] not in cut[205].text
    assert set(seen["best_fit_packing"]) == set(cut)
    whole = corpus_pipeline.run(spark, str(tmp_path))
    assert {(r.doc_id, r.ids_crc32) for r in whole.collect()} == \
        {(r.doc_id, r.ids_crc32) for r in seen["best_fit_packing"].values()}

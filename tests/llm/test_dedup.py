"""Exact dedup, SimHash near-dedup, components and substring dedup against brute force."""

import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from proficio.llm import exact_dedup, simhash, substring_dedup
from proficio.llm.components import components
from proficio.llm.windows import gram_hashes, sliding_argmin

DOCS = "doc_id bigint, text string"


def lower(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")


def exact_rows():
    rnd = random.Random(1)
    rows = [(i, rnd.choice(["Hot Text", "hot text", "É", "é", "", None, f"t{rnd.randint(0, 30)}"])) for i in range(300)]
    return rows + [(None, "alone"), (None, "hot text"), (5, rows[5][1]), (5, rows[5][1]), (999, "x" * 100_000)]


@pytest.mark.parametrize("counters", [1, 3, 256])
def test_exact_dedup_matches_brute_force(spark, counters):
    rows = exact_rows()
    df = spark.createDataFrame(rows, DOCS).repartition(7).withColumn("digest", F.lit("mine")).withColumn("n", F.lit(1))
    groups = defaultdict(list)
    for d, t in rows:
        groups[hashlib.sha256(lower(t).encode()).hexdigest()].append(d)
    got = exact_dedup.exact_dedup(df, counters=counters).collect()
    assert len(got) == len(rows)
    kept = defaultdict(int)
    for r in got:
        own = groups[r.text_sha256]
        assert r.group_size == len(own) and r.doc_id in own
        assert r.keep_id == max((d for d in own if d is not None), default=None)
        assert not r.kept or r.doc_id == r.keep_id
        kept[r.text_sha256] += r.kept
    assert set(kept) == set(groups) and set(kept.values()) == {1}


def test_drop_duplicates_keeps_columns(spark):
    rows = exact_rows()
    df = spark.createDataFrame(rows, DOCS).withColumn("text_digest", F.lit("mine")).withColumn("kept", F.lit(2))
    got = exact_dedup.drop_duplicates(df, counters=2)
    assert got.columns == df.columns
    best = {}
    for d, t in rows:
        best[lower(t)] = max(best.get(lower(t), -1), -1 if d is None else d)
    assert sorted((-1 if r.doc_id is None else r.doc_id, lower(r.text)) for r in got.collect()) == \
        sorted((d, t) for t, d in best.items())
    none = spark.createDataFrame([], DOCS)
    assert exact_dedup.drop_duplicates(none).count() == exact_dedup.exact_dedup(none).count() == 0


def test_heavy_copies_are_removed_before_the_shuffle(spark):
    rows = [(i, "hot" if i % 3 else f"t{i // 6}") for i in range(600)] + [(None, "hot"), (599, "hot")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    kept = exact_dedup.drop_duplicates(df, counters=4)
    last = {}
    for d, t in rows:
        last[t] = max(last.get(t, -1), -1 if d is None else d)
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == sorted((d, t) for t, d in last.items())
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    removed = [x for x in plan.split("\n") if "Join LeftAnti" in x and "w_keep" in x]
    assert removed and all("strategy=broadcast" in x for x in removed)
    judged = exact_dedup.exact_dedup(df, counters=4)
    assert judged.where("kept").count() == len(last)


def test_misra_gries_bound():
    rnd = random.Random(2)
    words = [rnd.choice(["a", "b"] + [str(rnd.randint(0, 500))] * 3) for _ in range(4000)]
    batches = [pa.RecordBatch.from_pydict({"digest": words[i:i + 300]}) for i in range(0, 4000, 300)]
    out = list(exact_dedup.misra_gries(9)(iter(batches)))[0].to_pydict()
    held = dict(zip(out["digest"], out["n"], strict=True))
    assert len(held) <= 9
    for w in ("a", "b"):
        assert words.count(w) - 4000 / 10 <= held[w] <= words.count(w)


def brute_simhash(t, shingle=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", lower(t))
    grams = [" ".join(words[i:i + shingle]) for i in range(max(1, len(words) - shingle + 1))] if words else []
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps, bits):
    label = {i: i for i in range(len(fps))}

    def find(a):
        while label[a] != a:
            a = label[a]
        return a
    f = np.array(fps, np.uint64)
    for i in range(len(fps)):
        for j in np.nonzero(np.bitwise_count(f ^ f[i]) <= bits)[0]:
            a, b = sorted((find(i), find(int(j))))
            label[b] = a
    return [find(i) for i in range(len(fps))]


def near_rows():
    rnd = random.Random(4)
    base = [" ".join(f"w{rnd.randint(0, 400)}" for _ in range(n)) for n in (3, 4, 60, 300, 300, 900)]
    rows = []
    for i in range(200):
        words = rnd.choice(base).split()
        for _ in range(rnd.randint(0, 2)):
            words[rnd.randrange(len(words))] = f"x{rnd.randint(0, 50)}"
        rows.append((i, " ".join(words)))
    return rows + [(300, None), (301, ""), (302, " \t\n"), (303, "one"), (304, "ONE"), (304, "ONE"), (None, "one"),
                   (305, "a\x1fb é\xa0c d"), (306, "w " * 70_000)]


def test_simhash_matches_brute_force(spark):
    rows = near_rows()
    df = spark.createDataFrame(rows, DOCS).withColumn("fp", F.lit("mine"))
    fps = [brute_simhash(t) for _, t in rows]
    roots = brute_components(fps, 4)
    least = defaultdict(lambda: None)
    for (d, _), r in zip(rows, roots, strict=True):
        if d is not None:
            least[r] = d if least[r] is None else min(d, least[r])
    expected = sorted((str(d), f"{f:016x}", str(least[r])) for (d, _), f, r in zip(rows, fps, roots, strict=True))
    for run_rows in (2048, 8):  # 8: long runs go through the slices
        got = simhash.simhash_groups(df, run_rows=run_rows).collect()
        assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in got) == expected
    kept = simhash.drop_near_duplicates(df)
    assert kept.columns == df.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(d) for d in least.values())


def test_links_connect_dense_and_sparse_fingerprints(spark):
    rnd = random.Random(6)
    center = [rnd.getrandbits(64) for _ in range(20)]
    fps = {c ^ sum(1 << rnd.randrange(64) for _ in range(rnd.randint(0, 5))) & (2**64 - 1) for c in center
           for _ in range(40)} | {rnd.getrandbits(64) for _ in range(100)}
    fps = sorted(fps)
    df = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp bigint")
    for bits, blocks, run_rows in ((4, 7, 2048), (4, 7, 8), (2, 4, 16), (0, 1, 4)):
        links = simhash.fingerprint_links(df, blocks, bits, run_rows)
        roots = {r.a: r.b for r in components(links).collect()}
        group = defaultdict(set)
        for f in fps:
            s = f - (1 << 64) if f >> 63 else f
            group[roots.get(s, s)].add(f)
        expected = defaultdict(set)
        for f, r in zip(fps, brute_components(fps, bits), strict=True):
            expected[r].add(f)
        assert sorted(map(sorted, group.values())) == sorted(map(sorted, expected.values()))


def test_components_of_a_chain_and_of_nothing(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 90), (7, 7)], "a bigint, b bigint")
    assert {r.a: r.b for r in components(chain).collect()} == {**{i: 0 for i in range(1, 41)}, 100: 90}
    assert components(chain.limit(0)).count() == 0
    none = spark.createDataFrame([], DOCS)
    assert simhash.simhash_groups(none).count() == simhash.drop_near_duplicates(none).count() == 0


def brute_removal(rows, window):
    words = [(d, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for d, t in rows]
    first = {}
    for d, w in words:
        if d is not None:
            for i in range(len(w) - window + 1):
                key = tuple(w[i:i + window])
                first[key] = min(d, first.get(key, d))
    out = []
    for d, w in words:
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            least = first.get(tuple(w[i:i + window]))
            if least is not None and (d is None or least < d):
                gone[i:i + window] = [True] * window
        out.append((d, len(w), sum(gone), [x for x, g in zip(w, gone, strict=True) if not g]))
    return out


def passage_rows():
    rnd = random.Random(8)
    words = lambda n: [f"v{rnd.randint(0, 3000)}" for _ in range(n)]
    shared = [words(n) for n in (10, 11, 14, 40, 300)]
    rows = []
    for i in range(90):
        w = []
        for _ in range(rnd.randint(0, 3)):
            part = rnd.choice(shared)
            a = rnd.randint(0, len(part) - 10)
            w += words(rnd.randint(0, 15)) + part[a:rnd.randint(a + 10, len(part))]
        rows.append((i * 3 + 1, rnd.choice([" ", "\n", " \t"]).join(w)))
    rows += [(500, None), (501, ""), (502, "short text"), (None, rows[3][1]), (None, rows[3][1]), (503, rows[4][1]),
             (503, rows[5][1]), (504, rows[7][1]), (504, rows[7][1]), (0, "é " * 30), (505, "é " * 2000)]
    return rows


def test_substring_dedup_matches_brute_force(spark):
    rows = passage_rows()
    df = spark.createDataFrame(rows, DOCS).withColumn("key", F.lit("mine")).withColumn("anchors", F.lit(1))
    expected = brute_removal(rows, 10)
    for shard_words, block_bytes in ((1_000_000, 4 << 20), (60, 900)):
        got = substring_dedup.repeated_words(df, window=10, gram=4, shard_words=shard_words, block_bytes=block_bytes)
        assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in got.collect()) == \
            sorted((str(d), n, k, hashlib.sha256(" ".join(w).encode()).hexdigest()) for d, n, k, w in expected)
    cut = substring_dedup.drop_repeated_passages(df, window=10, gram=4)
    assert cut.columns == df.columns
    assert sorted((str(r.doc_id), re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for r in cut.collect()) == \
        sorted((str(d), w) for d, _, _, w in expected)
    assert {r.text for r in cut.where("doc_id = 502 or doc_id = 500").collect()} == {"short text", None}


@pytest.mark.parametrize(("shard_words", "codes"), [(1_000_000, 900_000), (40, 900_000), (40, 7)])
def test_documents_of_a_block_are_put_into_characters_once(monkeypatch, shard_words, codes):
    rnd = random.Random(11)
    rows = [(i, [f"w{rnd.randint(0, 400)}" for _ in range(60)]) for i in range(40)]
    rows += [(100 + i, sum((rnd.choice(rows)[1][a:a + 14] for a in (0, 20, 40)), ["own"])) for i in range(40)]
    docs = pd.DataFrame([(k, k, " ".join(w)) for k, w in rows], columns=["key", "text_hash", "text"])
    passages = pd.DataFrame([(k, " ".join(w[a:a + 16])) for k, w in rows[:40] for a in (0, 20, 40)], columns=["owner", "words"])
    made, streamed = [], substring_dedup._mark_all
    monkeypatch.setattr(substring_dedup, "_CODES", codes)
    monkeypatch.setattr(substring_dedup, "_mark_all", lambda *a: made.append(len(a[4])) or streamed(*a))
    got = substring_dedup._locate(10, shard_words)(docs, passages)
    expected = {}
    for key, words in rows:
        gone = {p for owner, text in passages.itertuples(index=False) for at in range(len(words) - 9)
                if owner < key and any(text.split()[b:b + 10] == words[at:at + 10] for b in range(7)) for p in range(at, at + 10)}
        if gone:
            expected[key] = (len(gone), hashlib.sha256(" ".join(w for i, w in enumerate(words) if i not in gone).encode()).hexdigest())
    assert expected and {r.key: (r.n_removed, r.kept_sha) for r in got.itertuples()} == expected
    assert (len(made) == 1) == (codes > 400) and sum(made) >= (1 if shard_words > 40 else 40)


def test_no_state_of_a_passage_automaton_has_a_branch_for_most_words():
    words = [substring_dedup._char(i + 1) for i in range(4000)]
    passages = [(1, "".join(words[at:at + 20])) for at in range(0, 4000, 20)]
    automaton = substring_dedup.PassageAutomaton(passages, 10, 64)
    assert len({k[0] for k in automaton.automaton.keys()}) <= 64
    text = "".join(words[5:17] + words[:9])
    gone = np.zeros(len(text), bool)
    automaton.mark(2, text, substring_dedup._spelled(text, 64), gone)
    assert gone.tolist() == [True] * 12 + [False] * 9
    gone[:] = False
    automaton.mark(1, text, substring_dedup._spelled(text, 64), gone)
    assert not gone.any()


def test_substring_dedup_of_nothing(spark):
    none = spark.createDataFrame([], DOCS)
    assert substring_dedup.repeated_words(none).count() == substring_dedup.drop_repeated_passages(none).count() == 0


def test_window_hashes():
    x = np.array([random.Random(9).getrandbits(64) for _ in range(100)], np.uint64)
    for size in (1, 2, 3, 7, 50):
        got = gram_hashes(x, size, 0x9E3779B97F4A7C15)
        assert len(got) == 101 - size
        assert gram_hashes(x[5:5 + size], size, 0x9E3779B97F4A7C15)[0] == got[5]
    for width in (1, 2, 5, 31):
        got = sliding_argmin(x, width)
        assert list(got) == [i + int(np.argmin(x[i:i + width] >> np.uint64(20))) for i in range(101 - width)]

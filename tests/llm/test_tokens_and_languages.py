"""SentencePiece encoding, packing and language identification against libraries and brute force."""

import marshal
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from proficio.llm import language_id, packing, sentencepiece_codec

DOCS = "doc_id bigint, text string"
TEXTS = ["Hello  world 123", "", None, " ", "   lead  ", "a      b", "é中\U0001F600\n\tx", "ﬁ Å①", "▁x ▁▁y", "aaaaaaaaaaaa " * 50,
         "x" * 300, "a b\xa0c　d\x00e\x1ff", "The quick brown fox's tail; {\r\n  return 'ok';\r\n}", "Hello  world 123",
         "Straße İstanbul ΣΑΣ née", "中文字符没有空格的一句话" * 20, "word " * 20000]


@pytest.fixture(scope="module")
def pieces():
    return sentencepiece_codec.read_pieces("piece_bpe_32k.model")


@pytest.mark.parametrize("max_segment", [64, 5])
def test_encode_equals_the_library_and_decodes(spark, pieces, max_segment):
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    df = spark.createDataFrame(list(enumerate(TEXTS)), DOCS).withColumn("ids", F.lit(1)).repartition(3)
    encoded = sentencepiece_codec.encode(df, pieces, max_segment=max_segment)
    got = {r.doc_id: r for r in encoded.collect()}
    assert len(got) == len(TEXTS)
    for i, t in enumerate(TEXTS):
        assert np.frombuffer(got[i].ids, "<u4").tolist() == library.encode(t or ""), t
        assert got[i].n_tokens == len(got[i].ids) // 4
    back = {r.doc_id: r.text for r in sentencepiece_codec.decode(encoded, pieces).collect()}
    assert back == {i: (t or "").replace("▁", " ") for i, t in enumerate(TEXTS)}  # a written mark reads as a space
    assert sentencepiece_codec.encode(df.limit(0), pieces).count() == 0


def test_every_segment_goes_through_the_lattice(spark, pieces):
    """Also in one partition: the lattice holds all distinct segments that have a piece, and nothing is folded beside it."""
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS) if t], DOCS).coalesce(1)
    assert df.rdd.getNumPartitions() == 1
    segments = df.mapInArrow(sentencepiece_codec._segment_batches(pieces.pairs, 64), "segment string, part int")
    distinct = {r.segment for r in segments.collect()}
    held = {r.segment for r in sentencepiece_codec.lattice(segments, pieces, "merge").select("segment").collect()}
    assert held == {s for s in distinct if any(c in pieces.normal for c in s)} and len(held) > 50
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    got = {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in sentencepiece_codec.encode(df, pieces).collect()}
    assert got == {i: library.encode(t) for i, t in enumerate(TEXTS) if t}


@pytest.mark.parametrize("how", ["merge", "viterbi"])
def test_spark_folds_equal_brute_force(spark, pieces, how):
    rnd = random.Random(1)
    words = ["".join(rnd.choice("▁aeinrstéß中\n①hou") for _ in range(rnd.randint(1, 14))) for _ in range(150)]
    cut = sentencepiece_codec.Segmenter(pieces.pairs)
    segments = sorted({s for w in words for s in cut.word(w)})
    df = spark.createDataFrame([(s, p) for s in segments for p in (0, 1)], "segment string, part int")
    got = sentencepiece_codec.fold(sentencepiece_codec.lattice(df, pieces, how), pieces, how).collect()
    plain = {s: sentencepiece_codec.FOLDS[how](s, pieces) for s in segments
             if how == "viterbi" or any(c in pieces.normal for c in s)}
    assert {r.segment: list(r.ids) for r in got} == plain
    assert all(sorted(r.parts) == [0, 1] for r in got)


def test_viterbi_is_the_best_of_all_paths(pieces):
    def best(s):
        if not s:
            return 0.0
        scores = []
        for n in range(1, min(len(s), pieces.longest) + 1):
            piece = pieces.normal.get(s[:n])
            if piece or n == 1:
                scores.append((piece[1] if piece else pieces.floor) + best(s[n:]))
        return max(scores)
    by_id = {i: s for i, s in pieces.normal.values()}
    for s in ("▁the", "▁thetion", "ation", "▁Hello", "xqzt", "éa"):
        ids = sentencepiece_codec.fold_viterbi(s, pieces)
        assert sum(by_id.get(i, 0) for i in ids) >= best(s) - 1e-6 or any(i not in by_id for i in ids)


def test_packing(spark):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rnd = random.Random(2)
    texts = TEXTS + ["a <|endoftext|> b", "it's   we'LL 12ab"] + \
        [" ".join(f"word{rnd.randint(0, 99)}" for _ in range(rnd.randint(0, 30))) for _ in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)) + [(3, " "), (None, "null id")], DOCS) \
        .withColumn("length", F.lit("mine")).repartition(5)
    for capacity in (16, 2048):
        expected = Counter()
        for d, t in [*enumerate(texts), (3, " "), (None, "null id")]:
            ids = [*library.encode(t or "", add_special_tokens=False).ids, 0]
            for k in range(0, len(ids), capacity):
                own = ids[k:k + capacity]
                expected[d, k // capacity, k, len(own), zlib.crc32(np.array(own, "<u4").tobytes())] += 1
        rows = packing.pack_documents(df, capacity=capacity).collect()
        assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == expected
        filled = defaultdict(list)
        for r in rows:
            filled[r.sequence_id].append((r.offset, r.length))
        for own in filled.values():
            at = 0
            for offset, length in sorted(own):
                assert offset == at
                at += length
            assert at <= capacity
        assert len(filled) <= math.ceil(sum(r.length for r in rows) / capacity) * 1.1 + 1
    assert packing.pack_documents(df.limit(0)).count() == 0


@pytest.mark.parametrize("kind", ["uniform", "short", "long", "one"])
def test_patterns_use_up_the_histogram(kind):
    rng = np.random.default_rng(3)
    lengths = {"uniform": rng.integers(1, 129, 5000), "short": 1 + rng.integers(0, 20, 5000),
               "long": rng.integers(70, 129, 500), "one": np.array([7])}[kind]
    hist = np.bincount(lengths, minlength=129)
    plan = packing.pack_histogram(hist)
    used = np.zeros_like(hist)
    for pattern, times in plan:
        assert times > 0 and sum(x * n for x, n in pattern.items()) <= 128
        for x, n in pattern.items():
            used[x] += n * times
    assert (used == hist).all()
    sequences = sum(times for _, times in plan)
    assert sequences <= (500 if kind == "long" else math.ceil(lengths.sum() / 128) * 1.02 + 1)
    table = packing.plan_table(plan)
    assert len(table) == sum(len(p) for p, _ in plan)


def test_least_squares_finds_an_exact_mix():
    hist = np.zeros(17, np.int64)
    hist[[10, 6, 8, 4]] = [30, 30, 20, 40]
    patterns = packing.exact_patterns(hist, 4)
    counts = packing.fit_counts(patterns, hist)
    used = np.zeros(17)
    for p, c in zip(patterns, counts, strict=True):
        for x, n in p.items():
            used[x] += n * c
    assert np.abs(used - hist).max() < 0.05 and (counts >= 0).all()


LANG = "doc_id bigint, text string, lang string"


def invented(rnd, letters, n):
    words = ["".join(rnd.choice(letters) for _ in range(rnd.randint(2, 6))) for _ in range(40)]
    return [" ".join(rnd.choice(words) for _ in range(rnd.randint(5, 60))) for _ in range(n)]


def test_language_id(spark):
    rnd = random.Random(4)
    own = {"aa": invented(rnd, "abcdeé", 80), "bb": invented(rnd, "fghijß", 80), "cc": invented(rnd, "абвгде", 80)}
    rows = [(i * 3 + k, t, lang) for k, (lang, ts) in enumerate(own.items()) for i, t in enumerate(ts)]
    df = spark.createDataFrame(rows + [(900, None, "aa"), (901, "x", None), (None, "abc", "aa")], LANG)
    train = df.where("doc_id % 4 <> 2")
    model = language_id.train_model(train, train_docs=50)
    tests = df.where("doc_id % 4 = 2").select("doc_id", "text").unionByName(spark.createDataFrame(
        [(1000, None), (1001, ""), (1002, "123 !?"), (1003, " ".join(own["bb"]) * 400), (1004, own["aa"][2].upper()),
         (1004, own["aa"][2].upper()), (1005, "zzyyxxwwqq kkmm " * 40)], DOCS)).withColumn("score", F.lit("mine"))
    got = {r.doc_id: r for r in language_id.identify(tests, model).collect()}
    truth = {d: lang for d, t, lang in rows if d % 4 == 2}
    assert sum(got[d].lang_pred == lang for d, lang in truth.items()) >= 0.95 * len(truth)
    assert all(got[d].accepted for d in truth)
    for d in (1000, 1001, 1002):
        assert (got[d].lang_pred, got[d].score, got[d].accepted) == ("und", 0.0, False)
    assert got[1003].lang_pred == "bb" and got[1004].lang_pred == "aa" and got[1004].accepted
    assert not got[1005].accepted and got[1005].lang_pred in own
    assert all(0 <= r.score <= 1 for r in got.values())
    assert language_id.train_model(df.limit(0)) is None
    assert {r.lang_pred for r in language_id.identify(tests, None).collect()} == {"und"}
    assert language_id.identify(tests.limit(0), model).count() == 0


def test_kneser_ney_sums_to_one_and_matches_brute_force(spark):
    text = "abracadabra cabra"
    rows = [(i, text, "aa") for i in range(8)]
    model = language_id.train_model(spark.createDataFrame(rows, LANG), order=2)
    n = 6  # two of eight are kept for calibration
    padded = "\x01" + text
    pairs = Counter(zip(padded, padded[1:], strict=False))
    follow = defaultdict(dict)
    for (a, b), c in pairs.items():
        follow[a][b] = c * n
    types = Counter(b for _, b in pairs)
    n1, n2 = (sum(v == k for v in types.values()) for k in (1, 2))
    d1 = n1 / (n1 + 2 * n2) if n1 and n2 else 0.5
    total = sum(types.values())
    low = {b: (v - d1) / total + d1 * len(types) / total * 2.0 ** -20 for b, v in types.items()}

    def probability(a, b):
        c = follow[a]
        mass = sum(c.values())
        return max(c.get(b, 0) - 0.5, 0) / mass + 0.5 * len(c) / mass * low[b]
    assert 0.9 < sum(probability("a", b) for b in types) <= 1  # the rest is for characters never seen
    bits, length, _ = model.bits(["abra drab"])
    expected = -sum(math.log2(probability(a, b)) for a, b in zip("\x01abra drab", "abra drab", strict=False))
    assert length[0] == 9 and abs(bits[0, 0] - expected) < 1e-3


def test_every_label_is_learned(spark):
    rnd = random.Random(5)
    own = {f"l{k:02}": invented(rnd, [chr(0x4E00 + 30 * k + i) for i in range(12)], 12) for k in range(60)}
    rows = [(k * 100 + i, t, lang) for k, (lang, ts) in enumerate(own.items()) for i, t in enumerate(ts)]
    long = [(9000 + i, " ".join(invented(rnd, "fghijß", 1) * 900), "long") for i in range(8)]
    nameless = [(None, t, "null ids") for t in invented(rnd, "абвгде", 12)]
    train = spark.createDataFrame(rows + long + nameless, LANG)
    model = language_id.train_model(train, max_train_chars=2000)
    assert model.languages == sorted([*own, "long", "null ids"])  # more than 50, one of long texts alone
    assert min(len(t) for _, t, _ in long) > 2000
    got = {r.doc_id: r for r in language_id.identify(train.where("doc_id is not null"), model).collect()}
    assert all(got[d].lang_pred == lang for d, _, lang in rows + long)
    alone = language_id.train_model(train.where("lang = 'l07'"), max_train_chars=2000)
    mine = model.bits([own["l07"][0]])[0][0, model.languages.index("l07")]
    assert abs(mine - alone.bits([own["l07"][0]])[0][0, 0]) < 1e-3  # a block's languages do not touch each other
    with pytest.raises(ValueError, match="languages take"):
        language_id.train_model(train, max_train_chars=2000, max_model_bytes=10_000)


def syllables(rnd, letters, n):
    words = ["".join(rnd.choice(letters) for _ in range(rnd.randint(2, 6))) for _ in range(60)]
    return [" ".join(rnd.choice(words) for _ in range(rnd.randint(20, 150))) for _ in range(n)]


def test_short_foreign_texts_are_rejected_despite_junk_labels(spark):
    rnd = random.Random(6)
    own = {"aa": syllables(rnd, ["ka", "lo", "mi", "ter", "un", "sa"], 300),
           "bb": syllables(rnd, ["sch", "ei", "ber", "ich", "ge", "to"], 300)}
    foreign = [t[:n] for t in syllables(rnd, ["zx", "kq", "wy", "prz", "cz", "ję"], 20) for n in (20, 30, 40)]
    rows = [(2 * i + k, t, lang) for k, (lang, ts) in enumerate(own.items()) for i, t in enumerate(ts)]
    train = [r for r in rows if r[0] % 4 < 2]
    tests = [r for r in rows if r[0] % 4 >= 2]
    junk = [(10_000 + i, "".join(rnd.choice("qxzwkjvy") for _ in range(400)), "aa") for i in range(8)]
    limits = []
    for labelled in (train, train + junk):
        model = language_id.train_model(spark.createDataFrame(labelled, LANG))
        limits.append(model.limit)
        assert not any(model.judge(foreign)[2])
        assert np.mean(model.judge([t for _, t, _ in tests])[2]) >= 0.99
    assert max(limits) < 16


def test_the_limit_is_the_quantile_of_a_large_set():
    rng = np.random.default_rng(7)
    values = rng.exponential(size=20_000)
    assert language_id.tail_quantile(values, 0.001) == np.quantile(values, 0.999)
    few = rng.exponential(size=300)
    odd = np.concatenate([few, np.full(8, 500.0)])
    assert 4 < language_id.tail_quantile(few, 0.001) < 14  # 6.9 for all
    assert language_id.tail_quantile(odd, 0.001) < 20


def test_folded_segments_are_sent_on_before_a_task_holds_many():
    """Blocks leave while rows still come in, and together hold every row once."""
    taken = []

    def batches():
        for b in range(8):
            taken.append(b)
            names = [f"s{b}-{i}" for i in range(10_000)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([i % 3 for i in range(10_000)], pa.int32()), pa.array(names, pa.string()),
                 pa.array([[b, i] for i in range(10_000)], pa.list_(pa.int32()))], ["part", "segment", "ids"])
    sent = sentencepiece_codec._pack_parts(batches())
    out = [next(sent)]
    assert len(taken) < 8
    out += sent
    got = {}
    for block in out:
        for part, packed in zip(block.column(0).to_pylist(), block.column(1).to_pylist(), strict=True):
            for segment, ids in zip(*marshal.loads(zlib.decompress(packed)), strict=True):
                assert segment not in got
                got[segment] = part, np.frombuffer(ids, "<u4").tolist()
    assert got == {f"s{b}-{i}": (i % 3, [b, i]) for b in range(8) for i in range(10_000)}


def test_what_a_task_held_for_encoding_is_let_go_when_its_partition_ends(pieces):
    """The texts and blocks of a partition are not kept beside the next one's."""
    pair = ([(1, "1" * 70), (2, None)], [])
    encoded = list(sentencepiece_codec._encode_part(pieces, "merge", 0)(pair))
    assert [(d, n) for d, n, _ in encoded] == [(1, 71), (2, 0)] and pair == ([], [])


@pytest.mark.parametrize("table", [True, False])
def test_words_and_segments_are_cut_many_at_a_time(pieces, table):
    cut, plain = sentencepiece_codec.Cutter(pieces.pairs), sentencepiece_codec.Segmenter(pieces.pairs)
    if not table:
        cut.table = None
    texts = [*TEXTS, "ends in a mark ", " begins", "▁", "a▁", None]
    words, first = cut.words(texts)
    words = words.to_pylist()
    own = [sentencepiece_codec._WORD.findall(sentencepiece_codec.marked(t)) for t in texts]
    assert [words[a:b] for a, b in zip(first, first[1:], strict=False)] == own
    distinct = pa.array(words).unique()
    segments, sizes, first = cut.segments(distinct.slice(3))
    segments = segments.to_pylist()
    assert sizes.tolist() == [len(s) for s in segments]
    assert [segments[a:b] for a, b in zip(first, first[1:], strict=False)] == \
        [plain.word(w) for w in distinct.to_pylist()[3:]]
    assert [len(x) for x in cut.words([None, ""])] == [0, 3] and len(cut.segments(pa.array([], pa.string()))[0]) == 0


def test_merging_takes_the_best_left_neighbours_whatever_the_scores(spark):
    """Pieces in no order of training, many of one score: better neighbours may come up after worse ones were joined."""
    rnd = random.Random(8)
    names = [*"abcé", *{"".join(rnd.choice("abcé") for _ in range(rnd.randint(2, 6))) for _ in range(200)}]
    invented_pieces = sentencepiece_codec.Pieces(
        {p: (1000 + i, float(rnd.randint(-6, 0))) for i, p in enumerate(names)}, list(range(256)), 0, [])
    segments = sorted({"".join(rnd.choice("abcabcabcabcéz") for _ in range(rnd.randint(1, 64))) for _ in range(150)})
    df = spark.createDataFrame([(s, 0) for s in segments], "segment string, part int")
    folded = sentencepiece_codec.fold(sentencepiece_codec.lattice(df, invented_pieces, "merge"), invented_pieces, "merge")
    assert {r.segment: list(r.ids) for r in folded.collect()} == \
        {s: sentencepiece_codec.fold_merge(s, invented_pieces) for s in segments if set(s) & set("abcé")}


def test_the_lattice_has_tasks_enough_and_the_table_is_in_the_plan(spark, pieces, tmp_path):
    """Few bytes of segments become many edges: adaptive execution must not put them into one task."""
    spark.createDataFrame(list(enumerate(TEXTS)), DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    segments = docs.mapInArrow(sentencepiece_codec._segment_batches(pieces.pairs, 64), "segment string, part int")
    lattice = sentencepiece_codec.lattice(segments, pieces, "merge")
    assert lattice.rdd.getNumPartitions() >= sentencepiece_codec.LATTICE_TASKS
    assert sentencepiece_codec.encode(docs, pieces).inputFiles()


def test_parts_of_a_partition_do_not_depend_on_its_batches(monkeypatch):
    class Context:
        get = staticmethod(lambda: Context)
        partitionId = staticmethod(lambda: 2)
    monkeypatch.setattr(sentencepiece_codec, "TaskContext", Context)
    monkeypatch.setattr(sentencepiece_codec, "PART_CHARS", 50)
    monkeypatch.setattr(sentencepiece_codec, "SLICE_CHARS", 20)
    rnd = random.Random(9)
    rows = [(i, None if i % 9 == 0 else "x" * rnd.randint(0, 30)) for i in range(200)]
    found = []
    for size in (1, 7, 200):
        batches = [pa.RecordBatch.from_arrays([pa.array([i for i, _ in some]), pa.array([t for _, t in some], pa.string())],
                                              ["doc_id", "text"]) for some in (rows[k:k + size] for k in range(0, 200, size))]
        found.append([(part, i, t) for part, ids, some in sentencepiece_codec._numbered(iter(batches))
                      for i, (_, t) in zip(ids.to_pylist(), some, strict=True)])
    assert found[0] == found[1] == found[2] and [(i, t) for _, i, t in found[0]] == rows
    chars = Counter()
    for part, _, t in found[0]:
        chars[part] += len(t or "")
    first = 2 * sentencepiece_codec.PARTS
    assert sorted(chars) == list(range(first, first + len(chars))) and len(chars) > 20
    assert all(50 <= chars[part] < 80 for part in sorted(chars)[:-1])

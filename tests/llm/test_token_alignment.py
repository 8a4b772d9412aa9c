"""Token alignment against the libraries on whole texts, and the sparse products against dense ones."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from proficio.llm import token_alignment as T

DOCS = "doc_id bigint, text string"
TEXTS = ["Hello  world 123", "", None, " ", "   lead  ", "a      b", "é中\U0001F600\n\tx", "ﬁ Å①", "▁x ▁▁y", "aaaaaaaaaaaa " * 50,
         "x" * 300, "a b\xa0c　d\x00e\x1ff", "The quick brown fox's tail; {\r\n  return 'ok';\r\n}", "Hello  world 123",
         "Straße İstanbul ΣΑΣ née", "中文字符没有空格的一句话" * 20, "word " * 20000, "\n\nstart\n  two\t \n three \t end\t",
         "<s> <|endoftext|> </s><unk> <0x41> [INST]", "a\x1c b\x1c\x1c c  d   e", "tab\t\t next  \n\n\n x ", "¬​ zero‍ w"]


def expected(texts):
    """Columns of every text from whole encodings, byte positions and loops."""
    a_of = Tokenizer.from_file(public_tokenizers.path(T.A_FILE))
    a_of.encode_special_tokens = True
    b_of = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(T.B_FILE))
    byte_of = {c: i for i, c in enumerate(T.byte_characters())}
    rows, count = [], Counter()
    for text in texts:
        a = a_of.encode(" " + text, add_special_tokens=False).ids if text else []
        b = b_of.encode(text) if text else []
        a_raw = [bytes(byte_of[c] for c in a_of.id_to_token(i)) for i in a]
        b_raw = [bytes([int(b_of.id_to_piece(i)[3:5], 16)]) if b_of.is_byte(i) else b_of.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if not text or not b"".join(a_raw) == b"".join(b_raw) == (" " + text).encode():
            rows.append((0, 0, 0, [], ""))
            continue
        owner_a = [k for k, x in enumerate(a_raw) for _ in x]
        owner_b = [k for k, x in enumerate(b_raw) for _ in x]
        links = sorted(set(zip(owner_a, owner_b, strict=True)))
        ends_a, ends_b = (set(np.cumsum([len(x) for x in raw]).tolist()) for raw in (a_raw, b_raw))
        cuts = sorted(ends_a & ends_b)
        groups, begin = [], 0
        for end in cuts:
            groups.append(",".join(str(a[k]) for k in dict.fromkeys(owner_a[begin:end])) + "|"
                          + ",".join(str(b[k]) for k in dict.fromkeys(owner_b[begin:end])))
            begin = end
        pairs = [(a[i], b[j]) for i, j in links]
        count.update(set(pairs))
        rows.append((len(a), len(b), len(groups), pairs, ";".join(groups)))
    most = defaultdict(int)
    for (a, _), n in count.items():
        most[a] = max(most[a], n)
    return [(n_a, n_b, n_g, len(pairs), sum(count[p] == most[p[0]] for p in pairs), sum(count[p] for p in pairs), groups)
            for n_a, n_b, n_g, pairs, groups in rows]


@pytest.mark.parametrize("block_bytes,parts", [(T.BLOCK_BYTES, 1), (200, 4), (1, 3)])
def test_reports_equal_the_libraries(spark, block_bytes, parts):
    df = spark.createDataFrame(list(enumerate(TEXTS)), DOCS).withColumn("block", F.lit(7)).withColumn("pairs", F.lit("x")).repartition(parts)
    got = {r.doc_id: r for r in T.alignment_report(df, block_bytes=block_bytes).collect()}
    exp = expected(TEXTS)
    assert len(got) == len(TEXTS)
    for i, e in enumerate(exp):
        r = got[i]
        assert (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups) == e, TEXTS[i]
    assert sum(e[0] > 0 for e in exp) >= 14                      # most of them do have tokens


def test_documents_of_the_test_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    got = {r.doc_id: r for r in T.alignment_report(docs, digest=True).collect()}
    for (i, _), e in zip(texts.items(), expected(list(texts.values())), strict=True):
        r = got[i]
        groups = hashlib.sha256(e[6].encode()).hexdigest() if e[0] else ""
        assert (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups) == (*e[:6], groups)


def test_products_equal_dense_ones(monkeypatch):
    rng = np.random.default_rng(5)
    for block in (1 << 20, 3):
        monkeypatch.setattr(T, "PRODUCT_ROWS", block)
        for _ in range(30):
            dense = [(rng.random(shape) < 0.3) * rng.integers(1, 4, shape) for shape in ((7, 9), (9, 5))]
            a, b = (T.Csr(np.concatenate([[0], np.cumsum((d > 0).sum(axis=1))]), np.nonzero(d)[1], d[d > 0], d.shape[1]) for d in dense)

            def full(m, height):
                out = np.zeros((height, m.width), np.int64)
                out[m.rows(), m.columns] = m.values
                return out
            assert (full(a.times(b), 7) == dense[0] @ dense[1]).all()
            assert (full(a.transposed(), 9) == dense[0].T).all()
    empty = T.Csr.runs(np.zeros(0, np.int64))
    assert len(empty.times(empty.transposed()).columns) == 0


def test_links_share_bytes_or_groups(spark):
    texts = ["Straße née, unbelievable words", "", None, "▁no"]
    df = spark.createDataFrame(list(enumerate(texts)), DOCS)
    overlap = {(r.doc_id, r.a_at, r.b_at): r for r in T.token_links(df).collect()}
    group = {(r.doc_id, r.a_at, r.b_at): r for r in T.token_links(df, kind="group").collect()}
    e = expected(texts)[0]
    assert len(overlap) == e[3] and set(overlap) <= set(group) and {k[0] for k in overlap} == {0}
    assert sum(r.weight for r in overlap.values()) == len((" " + texts[0]).encode())
    sizes = [(len(g.split("|")[0].split(",")), len(g.split("|")[1].split(","))) for g in e[6].split(";")]
    assert len(group) == sum(a * b for a, b in sizes)
    with pytest.raises(ValueError):
        T.token_links(df, kind="other")


def test_empty_tables_and_repeated_rows(spark):
    df = spark.createDataFrame([(1, "same text"), (1, "same text"), (None, "same text"), (2, None)], DOCS)
    got = T.alignment_report(df).collect()
    assert len(got) == 4
    full = [r for r in got if r.n_a]
    assert len(full) == 3 and all(r.count_sum == 3 * r.n_links and r.n_best == r.n_links for r in full)
    assert T.alignment_report(df.limit(0)).count() == 0 and T.token_links(df.limit(0)).count() == 0
    only_null = T.alignment_report(df.where("doc_id = 2")).collect()
    assert [(r.doc_id, r.n_a, r.groups) for r in only_null] == [(2, 0, "")]

"""URL filters, chat formatting, line dedup and Merkle fingerprints."""

import hashlib
import random

from pyspark.sql import functions as F

from proficio.llm import chat_format, fingerprints, line_dedup, url_filters
from proficio.llm.queries import rule_table

DOCS = "doc_id bigint, text string, source string"


def brute_rule(url, rules):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        end = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
        path = rest[end:].split("#")[0].split("?")[0]
    fit = [(len(h + p), len(h), v, h + p) for h, p, v in rules
           if host and (host == h or host.endswith("." + h)) and path.startswith(p)]
    if not fit:
        return host, path, None, "allow"
    best = max(fit)
    return host, path, best[3], best[2]


def test_urls_match_brute_force(spark):
    urls = ["http://a.example.org/es/1", "https://EXAMPLE.org/en/12?x#y", "http://example.org/en/2", "ftp://x.com/fr/",
            "http://com/de/", "http://b.com/de", "http://notexample.org", "http://a.org", "http://org/", "no scheme",
            "", None, "http://", "http:///de/", "a://b://c.com/de/", "http://com.?/de/", "http://é.com/fr/é",
            "http://h.org:80/x", "http://x.com/fr/" + "y" * 5000, "http://u@q.org/#/de/"] * 2
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string").withColumn("rule", F.lit("mine"))
    for rules in (url_filters.RULES, [("org", "/", "allow"), ("org", "/", "block"), ("a.org", "", "allow")], []):
        got = {r.page_id: (r.host, r.path, r.rule, r.verdict)
               for r in url_filters.filter_urls(pages, rule_table(spark, rules)).collect()}
        assert got == {i: brute_rule(u, rules) for i, u in enumerate(urls)}


def test_urls_null_rules_and_empty_pages(spark):
    rules = rule_table(spark).unionByName(spark.sql("SELECT cast(null AS string) host, '/x' path, 'block' verdict"))
    none = spark.createDataFrame([], "page_id bigint, url string")
    assert url_filters.filter_urls(none, rules).count() == 0
    page = spark.createDataFrame([(None, "http://q.org/x")], "page_id bigint, url string")
    assert url_filters.filter_urls(page, rules).collect()[0].rule == "org/"


CONV = "conv_id bigint, turn bigint, role string, text string"


def test_chat_rotation(spark):
    rows = [(1, 0, "system", "be kind"), (1, 1, "ann", "hi <|im_end|>"), (1, 2, "bob", None), (1, 65, "ann", "late"),
            (2, None, None, "x"), (2, None, None, "x"), (None, 3, "eve", "y"), (3, 0, "system", "alone")]
    df = spark.createDataFrame(rows, CONV).withColumn("segment", F.lit(1)).withColumn("part", F.lit(2))
    got = {(r.conv_id, r.perspective, r.part): r for r in chat_format.chat_views(df).collect()}
    assert set(got) == {(1, "ann", 0), (1, "ann", 1), (1, "bob", 0), (1, "bob", 1), (2, "unknown", -1), (None, "eve", 0)}
    ann = got[1, "ann", 0]
    assert ann.rendered == ("<|im_start|>system\nbe kind<|im_end|>\n<|im_start|>assistant\nhi < |im_end|><|im_end|>\n"
                            "<|im_start|>user name=bob\n<|im_end|>\n")
    start, length = map(int, ann.mask_spans.split(":"))
    assert ann.rendered[start:start + length] == "hi < |im_end|><|im_end|>\n" and ann.n_masked_chars == length
    assert got[1, "bob", 1].mask_spans == "" and got[1, "bob", 1].n_masked_chars == 0
    assert got[2, "unknown", -1].n_messages == 2  # repeated rows are both rendered
    assert chat_format.chat_views(spark.createDataFrame([], CONV)).count() == 0


def test_chat_parts_of_repeated_turns_are_cut_by_position(spark):
    rnd = random.Random(8)
    rows = [(None, rnd.choice([None, -3, 0, 7]), rnd.choice(["ann", "bob", "system", None]), f"{rnd.random()} " * 3)
            for _ in range(1500)]
    rows += [(None, 0, "ann", "again")] * 900 + [(5, 0, "ann", "small"), (5, 1, "bob", "small"), (6, None, "eve", "z")]
    df = spark.createDataFrame(rows, CONV).repartition(5)
    size = 30_000
    cut = chat_format.chat_views(df, piece_size=size).collect()
    assert max(len(r.rendered) for r in cut) < size and max(r.n_messages for r in cut) <= size // 512 + 1
    whole = {(r.conv_id, r.perspective, r.part): r for r in chat_format.chat_views(df).collect()}
    joined = {}
    for r in sorted(cut, key=lambda r: r.piece):
        joined.setdefault((r.conv_id, r.perspective, r.part), []).append(r)
    assert joined.keys() == whole.keys() and len(joined[None, "ann", 0]) > 20
    for key, own in joined.items():
        assert [r.piece for r in own] == list(range(len(own)))
        assert "".join(r.rendered for r in own) == whole[key].rendered
        assert sum(r.n_messages for r in own) == whole[key].n_messages
        masked = [r.rendered[int(a):int(a) + int(n)] for r in own if r.mask_spans
                  for a, n in (x.split(":") for x in r.mask_spans.split(","))]
        w = whole[key]
        assert masked == [w.rendered[int(a):int(a) + int(n)] for a, n in
                          (x.split(":") for x in w.mask_spans.split(",") if x)]
        assert sum(map(len, masked)) == w.n_masked_chars == sum(r.n_masked_chars for r in own)


def test_no_row_holds_all_messages_without_a_conversation(spark):
    df = spark.range(40_000).selectExpr("cast(null as bigint) conv_id", "id % 8 turn", "concat('r', id % 2) role",
                                        "cast(id as string) text")
    got = chat_format.chat_views(df).select("perspective", "n_messages").collect()
    assert sum(r.n_messages for r in got) == 80_000 and max(r.n_messages for r in got) < 20_000


def test_line_dedup_matches_brute_force(spark):
    rnd = random.Random(3)
    lines = [f"line {i}" for i in range(30)] + ["", "  ", "very common"]
    rows = []
    for d in range(120):
        rows.append((d, "\n".join(rnd.choice(lines[:d % 33 + 1]) for _ in range(rnd.randint(1, 6))), f"s{d % 9}"))
    rows += [(500, None, "s1"), (501, "", None), (502, "very common\nonly here", None), (None, "line 1", "s2"),
             (7, rows[7][1], "s7")]
    sites = {}
    for _, t, s in rows:
        for x in (t or "").split("\n"):
            if x.strip(" ") and s:
                sites.setdefault(x.strip(" "), set()).add(s)
    df = spark.createDataFrame(rows, DOCS).withColumn("gone_keys", F.lit("mine")).withColumn("key", F.lit(1))
    for least in (2, 5, 8):
        got = line_dedup.drop_boilerplate(df, min_sites=least).collect()
        assert len(got) == len(rows)
        for r in got:
            own = None if r.text is None else r.text.split("\n")
            kept = None if own is None else [x for x in own if len(sites.get(x.strip(" "), ())) < least]
            assert r.kept_text == (None if kept is None else "\n".join(kept))
            assert r.n_lines == len(own or []) and r.n_removed == len(own or []) - len(kept or [])
            assert r.gone_keys == "mine"
    assert line_dedup.drop_boilerplate(spark.createDataFrame([], DOCS)).count() == 0


def test_line_dedup_counts_near_the_threshold_exactly(spark):
    rows = [(i, "near" if i < 9 else "on", f"s{i}") for i in range(19)] + [(i + 100, "on", "s0") for i in range(50)]
    lines = line_dedup.line_table(spark.createDataFrame(rows, DOCS))
    keys = line_dedup.boilerplate(lines, min_sites=10, lg_k=4)  # a coarse sketch: both lines are near
    assert [bytes(r.key) for r in keys.collect()] == [hashlib.md5(b"on").digest()]


def brute_edit(docs):
    order = sorted(docs, key=lambda r: (r[0] is not None, r[0], r[1] or ""))
    out = {}
    for i, (d, t, *_) in enumerate(order):
        t, nxt = t or "", order[(i + 1) % len(order)][1] or ""
        half = len(t) // 2
        out[d] = t[:len(t) - half] + nxt[:half]
    return out


def test_fingerprints_edit_and_likeness(spark):
    rnd = random.Random(5)
    text = lambda n: "\n".join(". ".join(f"w{rnd.randint(0, 10**6)}" for _ in range(4)) for _ in range(n))
    rows = [(i * 7 - 50, text(rnd.randint(1, 40)), "s") for i in range(60)]
    rows += [(1000, "", "s"), (1001, None, "s"), (1002, "x", "s"), (1003, "é" * 7, "s"), (None, rows[0][1], "s"),
             (1004, "long " * 20000, "s")]
    df = spark.createDataFrame(rows, DOCS).withColumn("fingerprint", F.lit("mine"))
    expected = brute_edit(rows)
    for buckets in (1, 3, 16):
        got = {r.doc_id: r for r in fingerprints.fingerprint_report(df, buckets=buckets).collect()}
        assert {d: r.edited_sha256 for d, r in got.items()} == \
            {d: hashlib.sha256(x.encode()).hexdigest() for d, x in expected.items()}
        assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got.values())
        assert got[None].fingerprint == got[-50].fingerprint and got[1000].fingerprint == got[1001].fingerprint
        assert got[1000].near_next == got[1000].near_edited == 1.0 and got[1002].near_edited == 1.0
        long = [r for r in got.values() if r.n_chars > 400 and r.doc_id not in (None, 1004)]
        assert all(0.2 < r.near_edited < 0.8 and r.near_next < 0.1 for r in long)


def test_fingerprints_small_tables_and_branches(spark):
    one = spark.createDataFrame([(5, "abcd", "s")], DOCS)
    row = fingerprints.fingerprint_report(one).collect()[0]
    assert row.edited_sha256 == hashlib.sha256(b"abab").hexdigest() and row.near_next == 1.0
    assert fingerprints.fingerprint_report(spark.createDataFrame([], DOCS)).count() == 0
    same = spark.createDataFrame([(5, "a", "s"), (5, "b", "s"), (5, "a", "t")], DOCS)
    assert fingerprints.fingerprint_report(same).count() == 3
    a = [f"p{i}. q{i}" for i in range(20)]
    b = a[:4] + ["changed"] + a[5:]
    pair = spark.createDataFrame([("\n".join(a), "\n".join(b))], "a string, b string")
    pair = fingerprints.with_fingerprint(fingerprints.with_fingerprint(pair, "a", "fa", "la"), "b", "fb", "lb")
    assert pair.select(fingerprints.differing_paragraphs(F.col("fb"), F.col("fa"))).first()[0] == [4]

"""Removal of passages that repeat across documents, by repeated-phrase automata.

1. Every document is winnowed: of each window of ``window`` words the least
   hashed run of ``gram`` words is an anchor.  A window that two documents
   share gives both the same anchor, so windows without a recurring anchor
   are out.
2. The windows around recurring anchors are hashed and counted; those that
   are in two or more documents are owned by the smallest doc_id.  Runs of
   owned windows are cut from their owner's text: the recurring passages.
3. Documents with recurring anchors are dealt into blocks.  Each block gets
   the passages that share an anchor with it, compiles them into Aho-Corasick
   automata (one per ``shard_words`` words) and streams its documents through
   them.  The windows around a hit are compared with the passages' windows;
   those owned by a smaller doc_id are removed.

Only windows whose words are equal are removed, so hashes decide nothing but
what is looked at.  The automata see words as single characters and hold one
phrase for about every ``window / 2`` words of a passage: any window of a
passage contains one of its phrases whole.

Defined cases: a null text has no words; texts shorter than a window lose
nothing; a null doc_id counts as larger than any other and owns nothing; rows
repeated under one doc_id are one document; an empty table gives an empty
result.
"""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import compress
from math import isqrt
from operator import itemgetter

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from proficio.llm._util import fresh, give_back, trimmed
from proficio.llm.windows import gram_hashes, sliding_argmin, split_words, word_hashes
from proficio.session import materialize

WINDOW = 50
GRAM = 20
SHARD_WORDS = 150_000
SEGMENT = 512
BLOCK_BYTES = 3 << 20
_NO_ID = (1 << 63) - 1
_GRAM_BASE, _WINDOW_BASE, _SECOND_BASE = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F
_FLUSH = 200_000
_CODES = 900_000  # words a block's passages put into characters before the documents are streamed; fewer than there are characters
_WORD = re.compile(r"[^\x20\x09-\x0D]+\s?", re.ASCII)


def _anchors(words: list[bytes], window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word hashes, gram hashes, per window the position of its anchor)."""
    hashes = word_hashes(words)
    grams = gram_hashes(hashes, gram, _GRAM_BASE)
    return hashes, grams, sliding_argmin(grams, window - gram + 1)


def _scan(window: int, gram: int):
    """mapInArrow (key, text_hash, text): word count, digest of the words, anchors of every document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, digests, anchors = [], [], []
            for text in batch.column(2):
                words = split_words(text.as_py())
                counts.append(len(words))
                digests.append(hashlib.sha256(b" ".join(words)).hexdigest())
                if len(words) < window:
                    anchors.append(np.empty(0, np.int64))
                    continue
                _, grams, least = _anchors(words, window, gram)
                anchors.append(np.unique(grams[np.unique(least)]).view(np.int64))
            offsets = np.concatenate([[0], np.cumsum([len(a) for a in anchors])]).astype(np.int32)
            values = np.concatenate(anchors) if anchors else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(counts, pa.int64()), pa.array(digests, pa.string()),
                 pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))],
                ["key", "text_hash", "n_words", "sha", "anchors"])
    return run


def _candidate_windows(window: int, gram: int):
    """mapInArrow (key, row32, text, anchors): (h1, h2, key, place) of windows with a recurring anchor."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        rows = 0

        def flush():
            cols = [np.concatenate(c) for c in zip(*held, strict=True)]
            return pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["h1", "h2", "key", "place"])

        for batch in batches:
            keys, row32 = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for i, (text, recurring) in enumerate(zip(batch.column(2), batch.column(3), strict=True)):
                hashes, grams, least = _anchors(split_words(text.as_py()), window, gram)
                known = np.asarray(recurring.values).view(np.uint64)
                starts = np.nonzero(np.isin(grams, known)[least])[0]
                h1 = gram_hashes(hashes, window, _WINDOW_BASE)[starts].view(np.int64)
                h2 = gram_hashes(hashes, window, _SECOND_BASE)[starts].astype(np.uint32).view(np.int32)
                held.append((h1, h2, np.full(len(starts), keys[i], np.int64),
                             (np.int64(row32[i]) << np.int64(32)) | starts.astype(np.int64)))
                rows += len(starts)
                if rows >= _FLUSH:
                    yield flush()
                    held, rows = [], 0
        if held:
            yield flush()
    return run


def _cut_passages(window: int, gram: int):
    """mapInArrow (key, row32, text, places): (owner, place, words, anchors) of each run of owned windows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owners, places, texts, anchors = [], [], [], []
            for i in range(batch.num_rows):
                words = split_words(batch.column(2)[i].as_py())
                _, grams, least = _anchors(words, window, gram)
                starts = np.unique(np.asarray(batch.column(3)[i].values) & 0xFFFFFFFF)
                starts = starts[starts < len(least)]
                for part in np.split(starts, np.nonzero(np.diff(starts) > 1)[0] + 1):
                    for s in range(0, len(part), SEGMENT):
                        own = part[s:s + SEGMENT]
                        first, last = int(own[0]), int(own[-1])
                        owners.append(batch.column(0)[i].as_py())
                        places.append((batch.column(1)[i].as_py() << 32) | first)
                        texts.append(b" ".join(words[first:last + window]).decode())
                        anchors.append(np.unique(grams[least[first:last + 1]]).view(np.int64).tolist())
            yield pa.RecordBatch.from_arrays(
                [pa.array(owners, pa.int64()), pa.array(places, pa.int64()), pa.array(texts, pa.string()),
                 pa.array(anchors, pa.list_(pa.int64()))], ["owner", "place", "words", "anchors"])
    return run


def _code(number: int) -> int:
    return number if number < 0xD800 else number + 0x800  # no surrogates


def _char(number: int) -> str:
    return chr(_code(number))


def _new_codes() -> dict[bytes, str]:
    """word -> its character; a word that is looked up for the first time gets the next one."""
    codes: defaultdict[bytes, str] = defaultdict(lambda: _char(len(codes) + 1))
    return codes


def _spelled(text: str, base: int) -> str:
    """Each character of ``text`` as two, the digits of its code; second digits differ from all first ones."""
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    return np.column_stack([codes // base, codes % base + base]).astype("<u2").tobytes().decode("utf-16-le")


class PassageAutomaton:
    """An Aho-Corasick automaton over passages given as (owner, words as characters).

    It locates where a passage may go on; the windows around a hit are then
    confirmed, word by word, against the passages' own windows.  The automaton
    reads words as two digits to ``base``: the library searches the branches of
    a state one by one, and the first one would have a branch for most words.
    """

    def __init__(self, passages: list[tuple[int, str]], window: int, base: int):
        self.window = window
        self.size = (window + 1) // 2          # words of a phrase
        stride = window - self.size + 1        # any window holds a phrase that starts at a multiple of this
        self.owners: dict[str, int] = {}       # window -> smallest owner
        self.automaton = ahocorasick.Automaton()
        for owner, text in sorted(passages, key=itemgetter(0), reverse=True):
            self.owners.update(dict.fromkeys([text[at:at + window] for at in range(len(text) - window + 1)], owner))
            spelled = _spelled(text, base)
            for at in range(0, len(text) - self.size + 1, stride):
                self.automaton.add_word(spelled[2 * at:2 * (at + self.size)], True)
        if len(self.automaton):
            self.automaton.make_automaton()

    def mark(self, key: int, text: str, spelled: str, gone: np.ndarray) -> None:
        """Set ``gone`` for every word in a window that a smaller owner's passage has, too."""
        if not len(self.automaton) or len(text) < self.window:
            return
        owner_of, window = self.owners.get, self.window
        found, looked, last = [], 0, len(text) - window
        for digit, _ in self.automaton.iter(spelled):
            end = digit // 2
            start = end - self.size + 1
            for at in range(max(looked, end - window + 1), min(start, last) + 1):
                owner = owner_of(text[at:at + window])
                if owner is not None and owner < key:
                    found.append(at)
            looked = max(looked, start + 1)
        if found:
            edges = np.zeros(len(text) + 1, np.int64)
            edges[found] += 1
            edges[np.array(found) + window] -= 1
            gone |= np.cumsum(edges[:-1]) > 0


def _mark_all(keys: list[int], split: list[list[bytes]], gone: list[np.ndarray], codes: dict[bytes, str],
              shards: list[list[tuple[int, str]]], window: int) -> None:
    """Stream the documents, put into characters once, through the automaton of each shard."""
    if not codes:
        return
    base, code = isqrt(_code(len(codes))) + 1, codes.get
    texts = ["".join([code(w, "\0") for w in words]) for words in split]
    spelled = [_spelled(text, base) for text in texts]
    for shard in shards:
        automaton = PassageAutomaton(shard, window, base)
        for key, text, digits, marks in zip(keys, texts, spelled, gone, strict=True):
            automaton.mark(key, text, digits, marks)


def _kept(text: str, words: list[bytes], gone: np.ndarray) -> tuple[str, str]:
    """(digest of the kept words joined by one space, the text with the removed words cut out)."""
    stays = (~gone).tolist()
    parts = _WORD.findall(text)
    if not len(parts) == len(words) == len(stays):
        raise ValueError("the words of a text and their marks differ in number")
    return hashlib.sha256(b" ".join(compress(words, stays))).hexdigest(), "".join(compress(parts, stays))


def _locate(window: int, shard_words: int):
    """Cogrouped per block: documents (key, text_hash, text) and passages (owner, words)."""
    def run(docs: pd.DataFrame, passages: pd.DataFrame) -> pd.DataFrame:
        split = [split_words(t) for t in docs["text"]]
        gone = [np.zeros(len(w), bool) for w in split]
        keys = [int(key) for key in docs["key"]]
        codes = _new_codes()
        shards: list[list[tuple[int, str]]] = [[]]
        held = 0
        for owner, text in zip(passages["owner"], passages["words"], strict=True):
            coded = "".join([codes[w] for w in split_words(text)])
            shards[-1].append((int(owner), coded))
            held += len(coded)
            if len(codes) >= _CODES:
                _mark_all(keys, split, gone, codes, shards, window)
                codes, shards, held = _new_codes(), [[]], 0
            elif held >= shard_words:
                shards.append([])
                held = 0
        _mark_all(keys, split, gone, codes, shards, window)
        out = []
        for key, text_hash, text, words, marks in zip(docs["key"], docs["text_hash"], docs["text"], split, gone,
                                                      strict=True):
            if marks.any():
                out.append((key, text_hash, int(marks.sum()), *_kept(text, words, marks)))
        del split, gone
        give_back()
        return pd.DataFrame(out, columns=["key", "text_hash", "n_removed", "kept_sha", "kept_text"])
    return run


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(id_col).cast("bigint"), F.lit(_NO_ID)).alias("key"),
                       F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text"))


def _removals(keyed: DataFrame, scan: DataFrame, window: int, gram: int, shard_words: int,
              block_bytes: int) -> DataFrame:
    """(key, text_hash, n_removed, kept_sha, kept_text) of the documents that lose words."""
    spark = keyed.sparkSession
    anchors = scan.select("key", "text_hash", F.explode("anchors").alias("anchor"))
    recurring = (anchors.groupBy("anchor").agg(F.min("key").alias("lo"), F.max("key").alias("hi"))
                 .where("lo < hi").select("anchor"))
    touched = (anchors.join(recurring, "anchor", "left_semi")
               .groupBy("key", "text_hash").agg(F.collect_set("anchor").alias("anchors")))
    wide = keyed.join(touched, ["key", "text_hash"])
    texts = materialize(wide.withColumn("row32", F.shiftright("text_hash", 33).cast("int")), "passages-texts")
    rows = texts.agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes")).first()
    if rows.n > texts.select("key", "text_hash").distinct().count():  # rows repeated with the same id and text
        texts = materialize(texts.dropDuplicates(["key", "text_hash"]), "passages-texts")
    blocks = max(1, -(-(rows.bytes or 0) // block_bytes))
    texts = texts.withColumn("block", F.pmod(F.xxhash64("key", "text_hash"), F.lit(blocks)).cast("int"))

    windows = texts.select("key", "row32", "text", "anchors").mapInArrow(
        trimmed(_candidate_windows(window, gram)), "h1 bigint, h2 int, key bigint, place bigint")
    owned = (windows.groupBy("h1", "h2")
             .agg(F.min("key").alias("lo"), F.max("key").alias("hi"), F.min_by("place", "key").alias("place"))
             .where("lo < hi"))
    starts = (owned.select(F.col("lo").alias("key"), F.shiftright("place", 32).cast("int").alias("row32"), "place")
              .groupBy("key", "row32").agg(F.collect_list("place").alias("places")))
    passages = materialize(
        texts.join(starts, ["key", "row32"]).select("key", "row32", "text", "places")
        .mapInArrow(trimmed(_cut_passages(window, gram)), "owner bigint, place bigint, words string, anchors array<bigint>"),
        "passages")

    in_block = (texts.select("block", "key", F.explode("anchors").alias("anchor"))
                .groupBy("anchor", "block").agg(F.max("key").alias("hi")))
    wanted = (passages.select("owner", "place", F.explode("anchors").alias("anchor"))
              .join(in_block, "anchor").where("hi > owner").select("block", "owner", "place").distinct())
    dealt = wanted.join(passages.select("owner", "place", "words"), ["owner", "place"]) \
        .select(F.col("block").alias("for_block"), "owner", "words")
    return (texts.select("block", "key", "text_hash", "text").groupBy("block")
            .cogroup(dealt.groupBy("for_block"))
            .applyInPandas(_locate(window, shard_words),
                           "key bigint, text_hash bigint, n_removed bigint, kept_sha string, kept_text string"))


def _scanned(keyed: DataFrame, window: int, gram: int) -> DataFrame:
    return materialize(keyed.mapInArrow(
        trimmed(_scan(window, gram)), "key bigint, text_hash bigint, n_words bigint, sha string, anchors array<bigint>"),
        "passages-scan")


def repeated_words(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, shard_words: int = SHARD_WORDS,
                   block_bytes: int = BLOCK_BYTES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 of every row of ``docs``."""
    keyed = _keyed(docs, id_col, text_col)
    scan = _scanned(keyed, window, gram)
    changed = _removals(keyed, scan, window, gram, shard_words, block_bytes).drop("kept_text")
    return (scan.select("key", "text_hash", "n_words", "sha").join(changed, ["key", "text_hash"], "left")
            .select(F.when(F.col("key") != _NO_ID, F.col("key")).alias("doc_id"), "n_words",
                    F.coalesce("n_removed", F.lit(0)).cast("bigint").alias("n_removed"),
                    F.coalesce("kept_sha", "sha").alias("kept_sha256")))


def drop_repeated_passages(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, id_col: str = "doc_id",
                           text_col: str = "text") -> DataFrame:
    """``docs`` with the repeated words cut out of the text column; other texts and columns stay as they are."""
    keyed = _keyed(docs, id_col, text_col)
    scan = _scanned(keyed, window, gram)
    changed = materialize(_removals(keyed, scan, window, gram, SHARD_WORDS, BLOCK_BYTES)
                          .select("key", "text_hash", "kept_text"), "passages-kept")
    names = {c: fresh(docs, c) for c in ("p_key", "p_hash", "p_text", "p_found")}
    new = changed.select(F.col("key").alias(names["p_key"]), F.col("text_hash").alias(names["p_hash"]),
                         F.col("kept_text").alias(names["p_text"]), F.lit(True).alias(names["p_found"]))
    joined = docs.join(new, (F.coalesce(docs[id_col].cast("bigint"), F.lit(_NO_ID)) == F.col(names["p_key"]))
                       & (F.xxhash64(docs[text_col]) == F.col(names["p_hash"])), "left")
    text = F.when(F.col(names["p_found"]), F.col(names["p_text"])).otherwise(F.col(text_col))
    return joined.select(*[text.alias(c) if c == text_col else joined[c] for c in docs.columns])

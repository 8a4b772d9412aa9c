"""Alignment of two tokenizers' tokens by sparse token-byte incidence matrices.

Both tokenizers encode the same bytes (a space and the text).  Tokens x bytes
is a sparse 0/1 matrix, kept as hand-built compressed rows; the row products
of A with the transpose of B (Gustavson) have an entry wherever an A token and
a B token share bytes, and its value is how many.  Byte offsets where tokens
of both end cut them into groups; tokens x groups is such a matrix, too, and
its products link the tokens of a group.

Words repeat, so the matrices are built for the distinct segments of a batch
that the worker does not know yet, all in one product.  A segment begins at a
space or line feed after a character that is no white space; no token of
either vocabulary crosses such a place, which is checked against the
vocabularies.  A text whose segments can't be told apart this way is encoded
whole.

How many documents hold a linked id pair is counted over blocks: a block of
documents (``BLOCK_BYTES`` of text) keeps its distinct pairs once, its
documents point into them, and only (block, pair) rows are shuffled to be
summed and dealt back.  The highest count of every A id, at most one row for
each id of A's vocabulary, is broadcast.

Defined cases: texts that are null, empty or not given back by both
tokenizers byte for byte have no tokens: zeros, and '' for the groups.  Very
long texts are a block of their own.  Repeated rows count as documents each.
An empty table gives an empty result.  Other columns are neither read nor
returned, whatever their names.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from proficio.llm._util import trimmed, worker_store
from proficio.llm.packing import byte_characters
from proficio.session import materialize

A_FILE, B_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
BLOCK_BYTES = 8 << 20
KNOW_BYTES = 1 << 20
MEMO_SEGMENTS = 200_000
ENCODE_AT_ONCE = 20_000
PRODUCT_ROWS = 1 << 20
SPACE = "▁"

_SEGMENT = re.compile(r"\s*\S+(?:[^\S \n]\s*\S+)*|\s+")


# --------------------------------------------------------------- sparse matrices
@dataclass
class Csr:
    """Compressed rows: the columns of row i are ``columns[begin[i]:begin[i + 1]]``, with ``values``."""
    begin: np.ndarray
    columns: np.ndarray
    values: np.ndarray
    width: int

    @classmethod
    def runs(cls, lengths: np.ndarray) -> Csr:
        """Rows that cover one stretch of columns after the other: tokens x bytes."""
        begin = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
        n = int(begin[-1])
        return cls(begin, np.arange(n), np.ones(n, np.int64), n)

    @classmethod
    def labels(cls, column: np.ndarray, width: int) -> Csr:
        """Rows of one column each: tokens x groups."""
        return cls(np.arange(len(column) + 1), column, np.ones(len(column), np.int64), width)

    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.begin) - 1), np.diff(self.begin))

    def transposed(self) -> Csr:
        order = np.argsort(self.columns, kind="stable")
        begin = np.concatenate([[0], np.cumsum(np.bincount(self.columns, minlength=self.width))])
        return Csr(begin, self.rows()[order], self.values[order], len(self.begin) - 1)

    def times(self, other: Csr) -> Csr:
        """Gustavson's product: row i is the sum of the rows of ``other`` at the columns of row i.

        ``PRODUCT_ROWS`` entries of this matrix are worked on at a time.
        """
        keys, sums, at = [], [], 0
        rows = self.rows()
        while at < len(self.columns):
            to = min(at + PRODUCT_ROWS, len(self.columns))
            if to < len(self.columns):           # a row is never cut, unless it is longer than that
                cut = int(self.begin[rows[to]])
                to = cut if cut > at else int(self.begin[rows[to] + 1])
            k = self.columns[at:to]
            n = other.begin[k + 1] - other.begin[k]
            place = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(other.begin[k], n)
            key = np.repeat(rows[at:to], n) * max(other.width, 1) + other.columns[place]
            value = np.repeat(self.values[at:to], n) * other.values[place]
            if np.any(key[1:] < key[:-1]):
                order = np.argsort(key, kind="stable")
                key, value = key[order], value[order]
            first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
            keys.append(key[first])
            sums.append(np.add.reduceat(value, first) if len(first) else value)
            at = to
        key = np.concatenate([np.zeros(0, np.int64), *keys])
        height = len(self.begin) - 1
        begin = np.concatenate([[0], np.cumsum(np.bincount(key // max(other.width, 1), minlength=height)[:height])])
        return Csr(begin, key % max(other.width, 1), np.concatenate([np.zeros(0, np.int64), *sums]), other.width)


@dataclass
class Alignment:
    """Tokens of A and B over the same bytes, their groups, and the products of the incidence matrices."""
    a: np.ndarray
    b: np.ndarray
    a_group: np.ndarray
    b_group: np.ndarray
    n_groups: int
    a_bytes: Csr
    b_bytes: Csr

    @classmethod
    def of(cls, a: np.ndarray, b: np.ndarray, a_lengths: np.ndarray, b_lengths: np.ndarray) -> Alignment:
        a_bytes, b_bytes = Csr.runs(a_lengths), Csr.runs(b_lengths)
        ends_a, ends_b = a_bytes.begin[1:], b_bytes.begin[1:]
        ends = ends_a[ends_b[np.minimum(np.searchsorted(ends_b, ends_a), max(len(ends_b) - 1, 0))] == ends_a]
        return cls(a, b, np.searchsorted(ends, a_bytes.begin[1:]), np.searchsorted(ends, b_bytes.begin[1:]), len(ends),
                   a_bytes, b_bytes)

    def overlaps(self) -> Csr:
        """A tokens x B tokens: the bytes that both cover."""
        return self.a_bytes.times(self.b_bytes.transposed())

    def shared_groups(self) -> Csr:
        """A tokens x B tokens: 1 where both are in one group."""
        return Csr.labels(self.a_group, self.n_groups).times(Csr.labels(self.b_group, self.n_groups).transposed())

    def members(self) -> tuple[Csr, Csr]:
        """Groups x A tokens and groups x B tokens."""
        return (Csr.labels(self.a_group, self.n_groups).transposed(), Csr.labels(self.b_group, self.n_groups).transposed())


# -------------------------------------------------------------------- tokenizers
def vocabulary_path(name: str) -> str:
    if os.path.isabs(name):
        return name
    import public_tokenizers
    return public_tokenizers.path(name)


class Pair:
    """Both tokenizers, the bytes of their tokens, and what is known of the segments seen so far.

    A segment is known by (n_a, n_b, groups as text, linked id pairs as
    little-endian a << 32 | b), or None where the bytes don't come back.
    """

    def __init__(self, a_file: str, b_file: str):
        import sentencepiece
        from tokenizers import Tokenizer
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.a = Tokenizer.from_file(vocabulary_path(a_file))
        self.a.encode_special_tokens = True
        byte_of = {c: i for i, c in enumerate(byte_characters())}
        self.a_bytes: dict[int, bytes] = {}
        for token, i in self.a.get_vocab(with_added_tokens=True).items():
            # a special token's string has no place among the byte characters' words; it is never encoded
            self.a_bytes[i] = bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode()
        self.b = sentencepiece.SentencePieceProcessor(model_file=vocabulary_path(b_file))
        self.b_bytes = [self._piece(i) for i in range(self.b.get_piece_size())]
        self.a_sizes = np.zeros(max(self.a_bytes) + 1, np.int64)
        self.a_sizes[list(self.a_bytes)] = [len(x) for x in self.a_bytes.values()]
        self.b_sizes = np.array([len(x) for x in self.b_bytes], np.int64)
        self.shown = list(map(str, range(max(len(self.a_sizes), len(self.b_sizes)))))
        self.mark = self.b.piece_to_id(SPACE)
        # every token's white space comes before its other characters, so no token crosses a segment's begin
        self.cut = (all(_no_inner_space(x) for x in self.a_bytes.values())
                    and all(_no_inner_space(x) for x in self.b_bytes))
        self.memo: dict[str, tuple | None] = {}
        self.older: dict[str, tuple | None] = {}

    def _piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace(SPACE, " ").encode()

    def tokens(self, segments: list[str], whole: bool) -> tuple[list[list[int]], list[list[int] | None]]:
        """Ids of A and of B; None for a segment whose ids alone aren't those it has within a text."""
        a = [e.ids for e in self.a.encode_batch_fast(segments, add_special_tokens=False)]
        # B puts a space before each text: instead of the segment's own, or to be taken off
        own = [s.startswith(" ") for s in segments]
        b = self.b.encode([s[1:] if o else s for s, o in zip(segments, own, strict=True)], num_threads=1)
        if whole:
            return a, b
        return a, [ids if o else ids[1:] if ids[:1] == [self.mark] else None for ids, o in zip(b, own, strict=True)]

    def encoded(self, segment: str) -> tuple[list[int], list[int]] | None:
        """Ids of a space and a text, if both give back its bytes."""
        a, b = self.tokens([segment], whole=True)
        ids = (a[0], b[0])
        return ids if self._same(segment, *ids) else None

    def _same(self, segment: str, a: list[int], b: list[int]) -> bool:
        raw = segment.encode()
        return (b"".join(map(self.a_bytes.__getitem__, a)) == raw
                and b"".join(map(self.b_bytes.__getitem__, b)) == raw)

    def _good(self, segments: list[str], a: list[list[int]], b: list[list[int] | None]) -> list[int]:
        """The places of the segments whose bytes both give back: mostly all, so they are compared at once first."""
        if None not in b and all(a) and all(b):
            raw = "".join(segments).encode()
            sizes = np.fromiter((len(s.encode()) for s in segments), np.int64, len(segments))
            for ids, names, size in ((a, self.a_bytes, self.a_sizes), (b, self.b_bytes, self.b_sizes)):
                flat = list(chain.from_iterable(ids))
                begin = np.cumsum([0, *map(len, ids)])[:-1]
                if b"".join(map(names.__getitem__, flat)) != raw or (np.add.reduceat(size[flat], begin) != sizes).any():
                    break
            else:
                return list(range(len(segments)))
        return [i for i, s in enumerate(segments) if b[i] is not None and self._same(s, a[i], b[i])]

    def learn(self, segments: list[str], whole: bool = False) -> dict[str, tuple | None]:
        """What is to be known of the segments, by one product for all of them."""
        a, b = self.tokens(segments, whole)
        found: dict[str, tuple | None] = dict.fromkeys(segments)
        good = self._good(segments, a, b)
        if not good:
            return found
        if len(good) < len(segments):
            a, b = [a[i] for i in good], [b[i] for i in good]
        ids_a, ids_b = (np.fromiter(chain.from_iterable(ids), np.int64) for ids in (a, b))
        both = Alignment.of(ids_a, ids_b, self.a_sizes[ids_a], self.b_sizes[ids_b])
        links = both.overlaps()
        pairs = ((ids_a[links.rows()] << 32) | ids_b[links.columns]).astype("<u8").tobytes()
        in_a, in_b = both.members()            # tokens are in the order of their groups
        text_a, text_b = (list(map(self.shown.__getitem__, ids.tolist())) for ids in (ids_a, ids_b))
        groups = [",".join(text_a[i:j]) + "|" + ",".join(text_b[k:m])
                  for i, j, k, m in zip(*(x for m in (in_a, in_b) for x in (m.begin[:-1].tolist(), m.begin[1:].tolist())),
                                        strict=True)]
        n_a, n_b = (np.fromiter(map(len, ids), np.int64, len(ids)) for ids in (a, b))
        ends = np.cumsum(n_a)
        g_to = (both.a_group[ends - 1] + 1).tolist()
        l_to = (links.begin[ends] * 8).tolist()
        g = at = 0
        for i, x, y, to, end in zip(good, n_a.tolist(), n_b.tolist(), g_to, l_to, strict=True):
            found[segments[i]] = (x, y, to - g, groups[g] if to == g + 1 else ";".join(groups[g:to]), pairs[at:end])
            g, at = to, end
        return found

    def know(self, texts: list[str]) -> list[list[tuple] | None]:
        """Of each text, what is known of its segments in order; None for a text without tokens."""
        if len(self.memo) > MEMO_SEGMENTS:
            self.older, self.memo = self.memo, {}
        cut = [_SEGMENT.findall(" " + t) if t and self.cut else None for t in texts]
        memo, older = self.memo, self.older
        new = []
        for s in set(chain.from_iterable(filter(None, cut))) - memo.keys():
            if s in older:
                memo[s] = older[s]
            else:
                new.append(s)
        new.sort()
        for i in range(0, len(new), ENCODE_AT_ONCE):
            self.memo.update(self.learn(new[i:i + ENCODE_AT_ONCE]))
        out = []
        for text, segments in zip(texts, cut, strict=True):
            found = list(map(self.memo.get, segments)) if segments else None
            if found is None or None in found:       # no segments, or one that must be seen in its text
                found = [self.learn([" " + text], whole=True)[" " + text]] if text else None
            out.append(None if found is None or None in found else found)
        return out


def _no_inner_space(token: bytes) -> bool:
    """Whether no space or line feed comes after another character than white space."""
    text = token.decode("utf-8", "replace")
    return not re.search(r"\S[ \n]", text)


def pair_of(a_file: str, b_file: str) -> Pair:
    """The worker's tokenizers, loaded once."""
    store = worker_store().setdefault("token_pairs", {})
    if (a_file, b_file) not in store:
        store[a_file, b_file] = Pair(a_file, b_file)
    return store[a_file, b_file]


# ------------------------------------------------------------------------ blocks
def pack_numbers(values: np.ndarray) -> bytes:
    """Unsigned numbers in the smallest width that holds them all, after a byte that names the width."""
    top = int(values.max()) if len(values) else 0
    width = 1 if top < 1 << 8 else 2 if top < 1 << 16 else 4 if top < 1 << 32 else 8
    return bytes([width]) + values.astype(f"<u{width}").tobytes()


def unpack_numbers(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, f"<u{raw[0]}", offset=1).astype(np.int64)


class Block:
    """Documents whose distinct pairs are kept once."""

    def __init__(self):
        self.rows: list[tuple] = []
        self.pairs: list[np.ndarray] = []
        self.times: list[np.ndarray] = []
        self.size = 0

    def add(self, doc_id, text: str, known: list[tuple] | None, digest: bool) -> None:
        self.size += len(text) + 64
        if known is None:
            self.rows.append((doc_id, 0, 0, 0, 0, ""))
            pairs = times = np.zeros(0, np.int64)
        else:
            n_a, n_b, n_groups, groups, links = zip(*known, strict=True)
            shown = ";".join(groups)
            links = np.frombuffer(b"".join(links), "<u8").astype(np.int64)
            pairs, times = np.unique(links, return_counts=True)
            self.rows.append((doc_id, sum(n_a), sum(n_b), sum(n_groups), len(links),
                              hashlib.sha256(shown.encode()).hexdigest() if digest else shown))
        self.pairs.append(pairs)
        self.times.append(times)

    def finished(self, block: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        """The documents' rows, each with its places among the block's pairs, and a row with these pairs."""
        every = np.concatenate([np.zeros(0, np.int64), *self.pairs])
        own, n_docs = np.unique(every, return_counts=True)
        places = [np.diff(np.searchsorted(own, p), prepend=0) for p in self.pairs]
        columns = [list(x) for x in zip(*self.rows, strict=True)]
        n = len(self.rows)
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(
                [*columns, [block] * n, [pack_numbers(p) for p in places], [pack_numbers(t) for t in self.times], [None] * n],
                schema, strict=True)], schema=schema)
        if len(own):
            yield pa.RecordBatch.from_arrays(
                [pa.array([x], f.type) for x, f in zip(
                    [None, 0, 0, 0, 0, "", block, None, pack_numbers(n_docs), own.astype("<u8").tobytes()], schema, strict=True)],
                schema=schema)


def aligned_blocks(docs: DataFrame, a_file: str = A_FILE, b_file: str = B_FILE, id_col: str = "doc_id",
                   text_col: str = "text", block_bytes: int = BLOCK_BYTES, digest: bool = False) -> DataFrame:
    """Every document's token, group and link counts, its groups (``a1,a2|b1;a3|b2``, or their SHA-256), and the blocks' pairs.

    A row with ``pairs`` holds a block's distinct pairs and, packed in ``times``, how many of its documents have each.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = (f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, "
            "groups string, block bigint, places binary, times binary, pairs binary")

    def align(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = pair_of(a_file, b_file)
        number = TaskContext.get().partitionId() << 32
        schema, block = None, Block()
        for part in parts:
            if schema is None:
                schema = pa.schema([("doc_id", part.schema.field("doc_id").type), *[(c, pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")],
                                    ("groups", pa.string()), ("block", pa.int64()), *[(c, pa.binary()) for c in ("places", "times", "pairs")]])
            at = 0
            while at < part.num_rows:
                ids, texts, size = [], [], 0
                while at < part.num_rows and size < min(KNOW_BYTES, block_bytes):
                    texts.append(part["text"][at].as_py() or "")
                    ids.append(part["doc_id"][at].as_py())
                    size += len(texts[-1]) + 64
                    at += 1
                for doc_id, text, known in zip(ids, texts, both.know(texts), strict=True):
                    block.add(doc_id, text, known, digest)
                if block.size >= block_bytes:
                    yield from block.finished(number, schema)
                    number, block = number + 1, Block()
        if block.rows:
            yield from block.finished(number, schema)
    return rows.mapInArrow(trimmed(align), kind)


def pair_rows(blocks: DataFrame) -> DataFrame:
    """(pair, block, n): in how many of a block's documents each of its pairs is linked."""
    def spread(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for block, pairs, times in zip(*(part[c].to_pylist() for c in ("block", "pairs", "times")), strict=True):
                pair = np.frombuffer(pairs, "<u8").astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(pair), pa.array(np.full(len(pair), block)), pa.array(unpack_numbers(times))],
                                                 names=["pair", "block", "n"])
    return blocks.where("pairs is not null").select("block", "pairs", "times").mapInArrow(spread, "pair bigint, block bigint, n bigint")


def counted_pairs(blocks: DataFrame) -> DataFrame:
    """(block, pair, n_docs, best): every block's pairs with their count over all documents.

    ``best``: no pair of the same A id has a higher count.  A pair has one
    row a block, so even one that all documents share is few rows.
    """
    summed = pair_rows(blocks).select("block", "pair", F.sum("n").over(W.partitionBy("pair")).alias("n_docs"))
    counted = materialize(summed, "alignment-pairs")
    a_id = F.shiftright("pair", 32)
    highest = counted.groupBy(a_id.alias("a_id")).agg(F.max("n_docs").alias("most"))
    return (counted.join(F.broadcast(highest), a_id == F.col("a_id"))     # a row for each id of A's vocabulary at most
            .select("block", "pair", "n_docs", (F.col("n_docs") == F.col("most")).alias("best")))


def alignment_report(docs: DataFrame, a_file: str = A_FILE, b_file: str = B_FILE, id_col: str = "doc_id",
                     text_col: str = "text", block_bytes: int = BLOCK_BYTES, digest: bool = False) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups (or their SHA-256) of every document.

    ``n_best``: links whose pair has the highest count of its A id;
    ``count_sum``: the counts, added up over the links.
    """
    blocks = materialize(aligned_blocks(docs, a_file, b_file, id_col, text_col, block_bytes, digest), "alignment-blocks")
    of_docs = blocks.where("pairs is null").drop("pairs")
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]
    kind = (f"doc_id {of_docs.schema['doc_id'].dataType.simpleString()}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, "
            "n_best bigint, count_sum bigint, groups string")

    def summed(left: pa.Table, right: pa.Table) -> pa.Table:
        n_docs = best = np.zeros(0, np.int64)
        if right.num_rows:
            order = np.argsort(right["pair"].to_numpy(), kind="stable")
            n_docs, best = right["n_docs"].to_numpy()[order], right["best"].to_numpy()[order].astype(np.int64)
        n_best, total = [], []
        for places, times in zip(left["places"].to_pylist(), left["times"].to_pylist(), strict=True):
            at, t = np.cumsum(unpack_numbers(places)), unpack_numbers(times)
            n_best.append(int((best[at] * t).sum()))
            total.append(int((n_docs[at] * t).sum()))
        found = {"n_best": pa.array(n_best, pa.int64()), "count_sum": pa.array(total, pa.int64())}
        return pa.table([found.get(c, left[c] if c in left.column_names else None) for c in names], names=names)

    return of_docs.groupBy("block").cogroup(counted_pairs(blocks).groupBy("block")).applyInArrow(summed, kind)


def token_links(docs: DataFrame, kind: str = "overlap", a_file: str = A_FILE, b_file: str = B_FILE, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """doc_id, a_at, a_id, b_at, b_id, weight: every link of every document, tokens numbered from 0.

    ``overlap`` links tokens that share bytes (``weight`` of them); ``group`` links the tokens of a group.
    """
    if kind not in ("overlap", "group"):
        raise ValueError("kind is overlap or group")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).where("text <> ''")

    def link(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        both = pair_of(a_file, b_file)
        for part in parts:
            for doc_id, text in zip(part["doc_id"], part["text"], strict=True):
                ids = both.encoded(" " + text)
                if ids is None:
                    continue
                a, b = (np.array(x, np.int64) for x in ids)
                found = Alignment.of(a, b, np.array([len(both.a_bytes[x]) for x in ids[0]]), np.array([len(both.b_bytes[x]) for x in ids[1]]))
                links = found.overlaps() if kind == "overlap" else found.shared_groups()
                at = links.rows()
                yield pd.DataFrame({"doc_id": doc_id, "a_at": at, "a_id": a[at], "b_at": links.columns,
                                    "b_id": b[links.columns], "weight": links.values})
    return rows.mapInPandas(link, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, a_at bigint, a_id bigint, b_at bigint, "
                                  "b_id bigint, weight bigint")

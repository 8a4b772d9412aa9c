"""Packing of tokenised documents into sequences by length patterns.

Documents are tokenised once, cut into pieces of at most ``capacity`` tokens
and written with a running number per length and task.  The histogram of
lengths (at most ``capacity`` rows) goes to the driver, where non-negative
least squares fits repeat counts of few-document patterns that fill a
sequence exactly; the counts are rounded down, and the rest is packed best
fit, longest first, again by whole patterns.  The resulting plan has a few
thousand rows however many documents there are; every piece finds its
sequence and offset in it by its rank among the pieces of its length.

Defined cases: a null text is empty and holds only the separator id; empty
documents are packed like others; repeated rows are packed each; an empty
table gives an empty result.
"""

from __future__ import annotations

import os
import struct
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from proficio.llm._util import trimmed, worker_store
from proficio.session import materialize

CAPACITY = 2048
SEPARATOR = 0
VOCABULARY = "word_bpe_49k.json"
MEMO_WORDS = 200_000


def byte_characters() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies.

    Printable Latin-1 bytes stand for themselves; the others, in order, for
    the characters from 256 on.
    """
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in plain]
    return [chr(b) if b in plain else chr(256 + others.index(b)) for b in range(256)]


class WordTokenizer:
    """A tokenizer that drops white space, run once per distinct word.

    Such a tokenizer never joins two words, so a text's ids are its words' ids
    one after the other; ids are kept for the last ``MEMO_WORDS`` to twice as
    many words.  A text with the string of a special token is encoded whole.

    If the tokenizer also lower-cases and splits letters from other characters
    at byte level (probed with a few words), a word is cut into its letters
    and the punctuation after them, and plain letters go straight to the
    tokenizer's model.
    """

    _TAIL = b".,!?;:"
    _PROBES = ("the", "quick", "straße", "école", "niñoé", "zqxj", "ångström", "a")

    def __init__(self, vocabulary: str):
        from tokenizers import Tokenizer
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        path = vocabulary
        if not os.path.isabs(path):
            import public_tokenizers
            path = public_tokenizers.path(vocabulary)
        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.memo: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.ends: dict[bytes, bytes] = {}
        self.mapped = dict(enumerate(byte_characters()))
        self.tokenize = self.tokenizer.model.tokenize
        plain = list(self._PROBES)
        shown = [p.upper() + self._TAIL[i % 6:i % 6 + 1].decode() for i, p in enumerate(plain) if p.isascii()]
        self.direct = all(self._model_ids(p) == self._whole([p])[0] for p in plain) and all(
            self._whole([w])[0] == self._whole([w[:-1].lower()])[0] + self._whole([w[-1]])[0] for w in shown)

    def _whole(self, words: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes()
                for e in self.tokenizer.encode_batch(words, add_special_tokens=False)]

    def _model_ids(self, letters: str) -> bytes:
        shown = letters if letters.isascii() else letters.encode().decode("latin-1").translate(self.mapped)
        ids = [t.id for t in self.tokenize(shown)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _end(self, tail: bytes) -> bytes:
        ids = self.ends.get(tail)
        if ids is None:
            ids = self._whole([tail.decode()])[0]
            if len(tail) <= 2:
                self.ends[tail] = ids
        return ids

    def _learn(self, words: set[bytes]) -> None:
        memo, older, hard = self.memo, self.older, []
        for word in words:
            ids = older.get(word)
            if ids is None:
                core = word.lower().rstrip(self._TAIL)  # bytes: A-Z only
                ids = memo.get(core) or older.get(core)
                if ids is None:
                    if not self.direct:
                        hard.append(word)
                        continue
                    text = core.decode()
                    if not core.isalpha():              # bytes: not only ASCII letters
                        # letters below U+0180: composed already, lower-cased one by one
                        text = text.lower()
                        if not text.isalpha() or max(text) >= "\u0180":
                            hard.append(word)
                            continue
                    ids = memo[core] = self._model_ids(text)
                if len(core) < len(word):
                    ids += self._end(word[len(core):])
            memo[word] = ids
        for i in range(0, len(hard), 1000):
            part = hard[i:i + 1000]
            self.memo.update(zip(part, self._whole([w.decode() for w in part]), strict=True))

    def encode(self, text: str | None) -> bytes:
        """The text's ids as little-endian unsigned 32-bit numbers."""
        text = text or ""
        if any(s in text for s in self.special):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        if len(self.memo) > MEMO_WORDS:
            self.older, self.memo = self.memo, {}
        words = text.encode().split()
        found = list(map(self.memo.get, words))
        if None in found:
            missing = [i for i, ids in enumerate(found) if ids is None]
            self._learn({words[i] for i in missing})
            for i in missing:
                found[i] = self.memo[words[i]]
        return b"".join(found)


def worker_tokenizer(vocabulary: str) -> WordTokenizer:
    store = worker_store()
    if vocabulary not in store:
        store[vocabulary] = WordTokenizer(vocabulary)
    return store[vocabulary]


def _pieces(vocabulary: str, capacity: int, separator: int):
    """mapInArrow (doc_id, text): the pieces, numbered within the task for each length."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = worker_tokenizer(vocabulary).encode
        end = np.array([separator], "<u4").tobytes()
        part = TaskContext.get().partitionId()
        seen = [0] * (capacity + 1)
        for batch in batches:
            at, piece, start, length, crc, rank = [], [], [], [], [], []
            for i, text in enumerate(batch.column(1)):
                ids = encode(text.as_py()) + end
                for k, a in enumerate(range(0, len(ids), 4 * capacity)):
                    own = ids[a:a + 4 * capacity]
                    n = len(own) // 4
                    at.append(i)
                    piece.append(k)
                    start.append(a // 4)
                    length.append(n)
                    crc.append(zlib.crc32(own))
                    rank.append(seen[n])
                    seen[n] += 1
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(at, pa.int64())), pa.array(piece, pa.int32()),
                 pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64()),
                 pa.array(np.full(len(at), part, np.int32)), pa.array(rank, pa.int64())],
                ["doc_id", "piece", "start", "length", "ids_crc32", "part", "nth"])
    return run


def exact_patterns(hist: np.ndarray, most: int) -> list[dict[int, int]]:
    """Patterns of one to ``most`` (at most four) pieces that fill a sequence exactly, from the lengths that occur."""
    cap = len(hist) - 1
    found: set[tuple[int, ...]] = set()
    for a in (int(x) for x in np.nonzero(hist)[0]):
        rest = cap - a
        half, third = rest // 2, rest // 3
        for p in ((a,), (a, rest), (a, half, rest - half), (a, third, third, rest - 2 * third))[:most]:
            if sum(p) == cap and all(x > 0 and hist[x] for x in p):
                found.add(tuple(sorted(p, reverse=True)))
    return [{x: p.count(x) for x in p} for p in sorted(found, reverse=True)]


def fit_counts(patterns: list[dict[int, int]], hist: np.ndarray, rounds: int = 400) -> np.ndarray:
    """Non-negative least squares: how often to repeat each pattern so that the lengths used come near ``hist``.

    Accelerated projected gradients on the sparse pattern matrix.
    """
    if not patterns:
        return np.empty(0)
    col = np.repeat(np.arange(len(patterns)), [len(p) for p in patterns])
    row = np.array([x for p in patterns for x in p])
    val = np.array([n for p in patterns for n in p.values()], float)
    use = lambda x: np.bincount(row, val * x[col], minlength=len(hist))
    back = lambda r: np.bincount(col, val * r[row], minlength=len(patterns))
    v = np.ones(len(patterns))
    for _ in range(30):  # the largest eigenvalue, for the step
        v = back(use(v))
        v /= np.linalg.norm(v)
    step = 1 / (1.02 * np.linalg.norm(back(use(v))))
    x = y = np.zeros(len(patterns))
    t = 1.0
    for _ in range(rounds):
        new = np.maximum(0, y - step * back(use(y) - hist))
        t, old = (1 + (1 + 4 * t * t) ** 0.5) / 2, t
        y, x = new + (old - 1) / t * (new - x), new
    return x


def best_fit(left: np.ndarray) -> list[tuple[dict[int, int], int]]:
    """Pack the histogram ``left`` best fit, longest first: (pattern, repeats) until it is used up.

    A pattern starts with the longest length left and goes on with the longest
    that fits its gap; it is repeated until one of its lengths runs out.
    """
    cap = len(left) - 1
    left = left.copy()
    lengths = [int(x) for x in np.nonzero(left)[0]]
    plan = []
    while lengths:
        pattern: dict[int, int] = {}
        gap, i = cap, len(lengths)
        while (i := bisect_right(lengths, gap, 0, i)):
            x = lengths[i - 1]
            pattern[x] = min(gap // x, int(left[x]))
            gap -= pattern[x] * x
            i -= 1
        times = min(int(left[x]) // n for x, n in pattern.items())
        for x, n in pattern.items():
            left[x] -= n * times
            if not left[x]:
                lengths.remove(x)
        plan.append((pattern, times))
    return plan


def pack_histogram(hist: np.ndarray) -> list[tuple[dict[int, int], int]]:
    """(pattern {length: pieces}, repeats) that use up ``hist``, where ``hist[n]`` counts the pieces of length n.

    Patterns of up to two, three and four pieces are fitted in turn, and the
    plan with the fewest sequences is taken: longer patterns help where short
    pieces abound, and cost where long pieces need them.
    """
    plans = []
    for most in (2, 3, 4):
        left = hist.astype(np.int64).copy()
        patterns, plan = exact_patterns(left, most), []
        counts = np.floor(fit_counts(patterns, left) + 1e-6).astype(np.int64)
        for j in np.argsort(-counts, kind="stable"):
            times = int(min(counts[j], *(left[x] // n for x, n in patterns[j].items())))
            if times > 0:
                for x, n in patterns[j].items():
                    left[x] -= n * times
                plan.append((patterns[j], times))
        plans.append(plan + best_fit(left))
    return min(plans, key=lambda plan: sum(times for _, times in plan))


def plan_table(plan: list[tuple[dict[int, int], int]]) -> np.ndarray:
    """Rows (length, first rank, first sequence, pieces a sequence, offset), sorted by length and rank."""
    rows, used, sequence = [], {}, 0
    for pattern, times in plan:
        offset = 0
        for x, n in pattern.items():
            rank = used.get(x, 0)
            rows.append((x, rank, sequence, n, offset))
            used[x] = rank + n * times
            offset += n * x
        sequence += times
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def _place(plan: np.ndarray):
    """mapInArrow over pieces with ``rank``: their sequence and offset in the plan."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shift = np.int64(1) << np.int64(48)
        keys = plan[:, 0] * shift + plan[:, 1]
        for batch in batches:
            length = batch.column(3).to_numpy(zero_copy_only=False)
            rank = batch.column(5).to_numpy(zero_copy_only=False)
            row = plan[np.searchsorted(keys, length * shift + rank, side="right") - 1]
            nth = rank - row[:, 1]
            sequence = row[:, 2] + nth // row[:, 3]
            offset = row[:, 4] + nth % row[:, 3] * length
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(5)), pa.array(sequence), pa.array(offset)],
                ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])
    return run


def pack_documents(docs: DataFrame, vocabulary: str = VOCABULARY, capacity: int = CAPACITY,
                   separator: int = SEPARATOR, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id and offset of every piece.

    ``vocabulary`` is a file of the tokenizers package's form, as a path or as
    a name that public_tokenizers.path knows; it must be one that drops white
    space.  A document's tokens are its ids and then ``separator``.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    pieces = materialize(
        docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
        .mapInArrow(trimmed(_pieces(vocabulary, capacity, separator)),
                    f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, part int, nth bigint"),
        "pieces")
    counts = pieces.groupBy("length", "part").agg(F.count("*").alias("n"))
    before = W.partitionBy("length").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    bases = materialize(counts.select("length", "part", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")),
                        "piece-bases")
    hist = np.zeros(capacity + 1, np.int64)
    for r in bases.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most ``capacity`` rows
        hist[r.length] = r.n
    plan = plan_table(pack_histogram(hist))
    # a row a task, of at most ``capacity`` + 1 numbers; there are as many as input splits, so it is no table to broadcast
    of_part = (bases.groupBy("part").agg(F.map_from_entries(F.collect_list(F.struct("length", "base"))).alias("m"))
               .select("part", F.transform(F.sequence(F.lit(0), F.lit(capacity)),
                                           lambda n: F.try_element_at("m", n.cast("bigint"))).alias("bases")))
    ranked = (pieces.join(of_part.hint("merge"), "part")
              .select("doc_id", "piece", "start", "length", "ids_crc32",
                      (F.col("nth") + F.get("bases", F.col("length").cast("int"))).alias("rank")))
    return ranked.mapInArrow(_place(plan), f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, "
                                           "sequence_id bigint, offset bigint")

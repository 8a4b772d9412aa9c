"""SentencePiece encoding and decoding by a relational lattice.

Texts are cut where no piece can cross (before a run of word marks, and
between two characters that stand side by side in no piece).  Every input
partition is cut into parts of ``PART_CHARS`` characters; the distinct segments
carry the numbers of the parts that hold them, and Spark builds the lattice:
every substring of a segment up to the longest piece is exploded and joined to
the piece table, the edges are grouped by segment and folded by a higher-order
function: ``viterbi`` takes the path with the highest sum of scores (unigram
models), ``merge`` joins the best-scored neighbours until none is left (models
whose scores are merge ranks).  The folded segments meet the texts of the parts
that hold them, which are shuffled in compressed chunks.

The piece table has a model's size, not the data's; a table over
``MAX_PIECES`` rows is refused.  Segments over ``max_segment`` characters are
folded by the task that holds them, by the same rules.

Defined cases: a null text has no ids, like an empty one; characters without
a piece become byte pieces; a model without byte pieces gives its unknown id;
repeated rows are encoded each; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import marshal
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property
from itertools import islice
from operator import add

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from proficio.llm._util import give_back, shuffle_partitions, trimmed

MARK = "▁"
MODEL = "piece_bpe_32k.model"
MAX_PIECES = 1_000_000
MAX_SEGMENT = 64
UNKNOWN_PENALTY = 10.0
PACK_ROWS = 20_000  # folded segments that a task holds before it sends them on
PART_CHARS = 32_000_000  # characters after which a partition's texts go on in another part
SLICE_CHARS = 2_000_000  # characters that are cut at a time
LATTICE_TASKS = 256  # of the lattice at least
PARTS = 4096  # numbers for the parts of a partition


@dataclass
class Pieces:
    """A model's vocabulary: (piece, id, score) of the pieces that texts can match, and the byte ids."""

    normal: dict[str, tuple[int, float]]
    bytes_at: list[int]
    unknown: int
    surface: list[bytes]

    @cached_property
    def longest(self) -> int:
        return max((len(p) for p in self.normal), default=1)

    @cached_property
    def pairs(self) -> frozenset[str]:
        """Characters that stand side by side in some piece."""
        return frozenset(p[i:i + 2] for p in self.normal for i in range(len(p) - 1))

    @cached_property
    def floor(self) -> float:
        """The score of a character without a piece, below every piece's."""
        return min((s for _, s in self.normal.values()), default=0.0) - UNKNOWN_PENALTY


def read_pieces(model: str = MODEL) -> Pieces:
    """The piece table of a sentencepiece model file (a path, or a name public_tokenizers.path knows)."""
    import os

    import sentencepiece
    if not os.path.isabs(model):
        import public_tokenizers
        model = public_tokenizers.path(model)
    p = sentencepiece.SentencePieceProcessor(model_file=model)
    if p.get_piece_size() > MAX_PIECES:
        raise ValueError(f"a piece table of over {MAX_PIECES} rows can't be broadcast")
    normal, by_byte, surface = {}, [p.unk_id()] * 256, []
    for i in range(p.get_piece_size()):
        piece = p.id_to_piece(i)
        if p.is_byte(i):
            by_byte[int(piece[3:5], 16)] = i
            surface.append(bytes([int(piece[3:5], 16)]))
        elif p.is_control(i) or p.is_unknown(i) or p.is_unused(i):
            surface.append(b"")
        else:
            normal[piece] = (i, p.get_score(i))
            surface.append(piece.replace(MARK, " ").encode())
    return Pieces(normal, by_byte, p.unk_id(), surface)


def marked(text: str | None) -> str:
    """The text as the model sees it: a word mark in front and in place of each space."""
    return MARK + text.replace(" ", MARK) if text else ""


_WORD = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


class Segmenter:
    """Cuts texts into segments that no piece crosses; the cuts of a word are kept."""

    def __init__(self, pairs: frozenset[str], keep: int = 200_000):
        self.pairs, self.keep, self.memo = pairs, keep, {}

    def word(self, word: str) -> list[str]:
        got = self.memo.get(word)
        if got is None:
            pairs = self.pairs
            cuts = [i for i, pair in enumerate(map(add, word, word[1:]), 1) if pair not in pairs]
            got = [word[a:b] for a, b in zip([0, *cuts], [*cuts, len(word)], strict=True)] if cuts else [word]
            if len(self.memo) >= self.keep:
                self.memo.clear()
            self.memo[word] = got
        return got


def _merge_short(segment: str, pieces: Pieces) -> list[str]:
    """The pieces of a short segment; each step looks at all neighbours."""
    get, parts = pieces.normal.get, list(segment)
    joined = [get(a + b) for a, b in zip(parts, parts[1:], strict=False)]
    while True:
        top, at = -np.inf, -1
        for i, got in enumerate(joined):
            if got is not None and got[1] > top:
                top, at = got[1], i
        if at < 0:
            return parts
        parts[at:at + 2] = [parts[at] + parts[at + 1]]
        del joined[at]
        if at < len(joined):
            joined[at] = get(parts[at] + parts[at + 1])
        if at:
            joined[at - 1] = get(parts[at - 1] + parts[at])


def fold_merge(segment: str, pieces: Pieces) -> list[int]:
    """Ids of one segment: the best-scored neighbours are joined first, the leftmost of equals."""
    n = len(segment)
    if n <= MAX_SEGMENT:
        return [i for p in _merge_short(segment, pieces) for i in _ids_of(p, pieces)]
    after, before, size = list(range(1, n + 1)), list(range(-1, n - 1)), [1] * n
    heap: list[tuple[float, int, int]] = []

    def offer(i: int) -> None:
        j = after[i]
        if j < n:
            got = pieces.normal.get(segment[i:j + size[j]])
            if got:
                heapq.heappush(heap, (-got[1], i, size[i] + size[j]))
    for i in range(n - 1):
        offer(i)
    while heap:
        _, i, length = heapq.heappop(heap)
        j = after[i] if size[i] else n
        if j >= n or size[i] + size[j] != length:
            continue
        size[i], size[j] = length, 0
        after[i] = after[j]
        if after[j] < n:
            before[after[j]] = i
        offer(i)
        if before[i] >= 0:
            offer(before[i])
    ids: list[int] = []
    for i in range(n):
        if size[i]:
            ids += _ids_of(segment[i:i + size[i]], pieces)
    return ids


def fold_viterbi(segment: str, pieces: Pieces) -> list[int]:
    """Ids of one segment: the path with the highest sum of scores, of equals the one whose last piece is longest."""
    best: list[tuple[float, int]] = [(0.0, 0)]
    floor, longest = pieces.floor, pieces.longest
    for end in range(1, len(segment) + 1):
        top = (-np.inf, end - 1)
        for start in range(max(0, end - longest), end):
            got = pieces.normal.get(segment[start:end])
            score = got[1] if got else floor if end - start == 1 else None
            if score is not None and best[start][0] + score > top[0]:
                top = (best[start][0] + score, start)
        best.append(top)
    cuts, end = [], len(segment)
    while end:
        cuts.append((best[end][1], end))
        end = best[end][1]
    return [i for a, b in reversed(cuts) for i in _ids_of(segment[a:b], pieces)]


def _ids_of(symbol: str, pieces: Pieces) -> list[int]:
    got = pieces.normal.get(symbol)
    return [got[0]] if got else [pieces.bytes_at[b] for b in symbol.encode()]


FOLDS = {"merge": fold_merge, "viterbi": fold_viterbi}


class Cutter:
    """Cuts texts into words and words into segments, as ``_WORD`` and :class:`Segmenter` do, many at a time."""

    def __init__(self, pairs: frozenset[str]):
        letters = sorted({c for pair in pairs for c in pair})
        self.number = np.zeros(0x110000, np.int32)  # 0: in no pair
        self.number[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
        self.width = len(letters) + 1
        self.joined = np.array(sorted(int(self.number[ord(a)]) * self.width + int(self.number[ord(b)])
                                      for a, b in pairs), np.int64)
        self.table = None
        if self.width <= 4096:
            self.table = np.zeros(self.width ** 2, bool)
            self.table[self.joined] = True

    def beside(self, chars: np.ndarray) -> np.ndarray:
        """Whether each character but the first stands side by side with the one before it in some piece."""
        of = self.number[chars]
        if self.table is not None:
            return self.table[of[:-1] * self.width + of[1:]]
        pair = of[:-1].astype(np.int64) * self.width + of[1:]
        at = np.searchsorted(self.joined, pair)
        return np.append(self.joined, -1)[at] == pair

    def words(self, texts: list[str | None]) -> tuple[pa.StringArray, np.ndarray]:
        """The words of all texts one after the other, and the first word's number of each text and of the end."""
        own = [marked(t) for t in texts]
        joined = "".join(own)
        chars = _characters(joined)
        begin = np.cumsum([0, *map(len, own)])
        mark = chars == ord(MARK)
        first = mark.copy()
        first[1:] &= ~mark[:-1]
        first[begin[:-1][np.diff(begin) > 0]] = True  # a text may end in a mark
        at = np.flatnonzero(first)
        return _parts(joined.encode(), chars, at), np.searchsorted(at, begin)

    def segments(self, words: pa.StringArray) -> tuple[pa.StringArray, np.ndarray, np.ndarray]:
        """The segments of all words, their lengths, and the first segment's number of each word and of the end."""
        offsets = np.frombuffer(words.buffers()[1], np.int32)[words.offset:words.offset + len(words) + 1]
        joined = words.buffers()[2][offsets[0]:offsets[-1]].to_pybytes() if len(words) else b""
        chars = _characters(joined.decode())
        begin = np.append(0, np.cumsum(pc.utf8_length(words).to_numpy(zero_copy_only=False), dtype=np.int64))
        first = np.zeros(len(chars), bool)
        first[1:] = ~self.beside(chars) if len(chars) else False
        first[begin[:-1]] = True  # no word is empty
        at = np.flatnonzero(first)
        return _parts(joined, chars, at), np.diff(np.append(at, len(chars))), np.searchsorted(at, begin)


def _characters(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), "<u4")


def _parts(joined: bytes, chars: np.ndarray, at: np.ndarray) -> pa.StringArray:
    """``joined``, whose characters are ``chars``, cut at the characters numbered ``at`` (0 is one of them)."""
    if len(joined) > len(chars):
        size = np.ones(len(chars), np.int8)
        for least in (0x80, 0x800, 0x10000):
            size += chars >= least
        at = (np.cumsum(size, dtype=np.int32) - size)[at]
    return pa.StringArray.from_buffers(len(at), pa.py_buffer(np.append(at, len(joined)).astype(np.int32)),
                                       pa.py_buffer(joined))


def _slices(rows: Iterator, chars: int) -> Iterator[list]:
    """Lists of (id, text) rows of about ``chars`` characters."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[1] or "")
        if size >= chars:
            yield held
            held, size = [], 0
    if held:
        yield held


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.Array, list]]:
    """(part, ids, rows) of a partition's rows (id, text) in order; a part has ``PART_CHARS`` characters or a row more.

    Parts do not depend on where batches begin, so that they are the same whenever a partition is read.
    """
    part, size = TaskContext.get().partitionId() * PARTS, 0
    for batch in batches:
        ids, at = batch.column(0), 0
        for rows in _slices(zip(range(batch.num_rows), batch.column(1).to_pylist(), strict=True), SLICE_CHARS):
            while rows:
                n = 0
                for n, (_, text) in enumerate(rows, 1):  # noqa: B007
                    size += len(text or "")
                    if size >= PART_CHARS:
                        break
                yield part, ids.slice(at, n), rows[:n]
                at, rows = at + n, rows[n:]
                if size >= PART_CHARS:
                    part, size = part + 1, 0


def _segment_batches(pairs: frozenset[str], max_segment: int):
    """mapInArrow (doc_id, text): the distinct segments of each of the partition's parts, for the lattice."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut = Cutter(pairs)
        held: list[pa.Array] = []

        def distinct(part: int) -> Iterator[pa.RecordBatch]:
            found, sizes, _ = cut.segments(pa.concat_arrays(held).unique())
            found = found.filter(pa.array(sizes <= max_segment)).unique()
            found = found.take(pc.sort_indices(found))
            for at in range(0, len(found), 10_000):
                some = found.slice(at, 10_000)
                yield pa.RecordBatch.from_arrays([some, pa.array(np.full(len(some), part, np.int32))],
                                                 ["segment", "part"])
        last = None
        for part, _, rows in _numbered(batches):
            if held and part != last:
                yield from distinct(last)
                held.clear()
            last = part
            held.append(cut.words([t for _, t in rows])[0].unique())
        if held:
            yield from distinct(last)
    return run


def _text_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """mapInArrow (doc_id, text): the rows of each part in compressed chunks."""
    options = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 3))
    for part, ids, rows in _numbered(batches):
        chunk = pa.RecordBatch.from_arrays([ids, pa.array([t for _, t in rows], pa.string())], ["doc_id", "text"])
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, chunk.schema, options=options) as out:
            out.write_batch(chunk)
        yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([sink.getvalue().to_pybytes()],
                                                                                 pa.binary())], ["part", "chunk"])


def piece_table(spark, pieces: Pieces) -> DataFrame:
    """piece, id, score, and ``code``: the score's rank (highest first) and the id, as edges for merging hold them."""
    import pandas as pd
    scores = np.array([s for _, s in pieces.normal.values()], np.float64)
    ids = np.array([i for i, _ in pieces.normal.values()], np.int32)
    rank = np.unique(-scores, return_inverse=True)[1].astype(np.int64)
    return spark.createDataFrame(pd.DataFrame(
        {"piece": list(pieces.normal), "id": ids, "score": scores, "code": (rank - 2 ** 19) * 2 ** 44 + ids}))


def lattice(segments: DataFrame, pieces: Pieces, how: str = "viterbi") -> DataFrame:
    """(segment, parts, edges): for each segment the (start, end, id, score) of all its substrings that are pieces.

    For merging an edge is one number that sorts by score, highest first, and
    by start: 20 bits of the score's rank, 12 of the start, 12 of the end, 20
    of the id.  Single characters without a piece are edges without an id,
    which merging has no use for; a segment without a piece has no edges then.
    """
    spark = segments.sparkSession
    # a fixed number of partitions: a segment becomes many edges, more than its bytes tell adaptive execution
    grouped = (segments.repartition(max(LATTICE_TASKS, 2 * shuffle_partitions(spark)), "segment")
               .groupBy("segment").agg(F.collect_set("part").alias("parts"))
               .withColumn("number", F.monotonically_increasing_id()))  # edges come in its order: cheap to sort
    n = F.length("segment")
    exploded = (grouped.withColumn("start", F.explode(F.sequence(F.lit(0), n - 1)))
                .withColumn("size", F.explode(F.sequence(F.lit(1), F.least(F.lit(pieces.longest), n - F.col("start")))))
                .withColumn("piece", F.substring(F.col("segment"), F.col("start") + 1, F.col("size"))))
    table = piece_table(spark, pieces)  # at most MAX_PIECES rows
    if how == "merge":
        edges = exploded.join(F.broadcast(table.select("piece", "code")), "piece")
        edge = F.expr(f"code + start * {2 ** 32}L + (start + size) * {2 ** 20}L")
    else:
        edges = exploded.join(F.broadcast(table.drop("code")), "piece", "left").where("id is not null or size = 1")
        edge = F.struct("start", (F.col("start") + F.col("size")).alias("end"), "id", "score")
    return (edges.groupBy("number", "segment").agg(F.first("parts").alias("parts"), F.collect_list(edge).alias("edges"))
            .drop("number"))


def _byte_ids(pieces: Pieces) -> str:
    return "array(" + ",".join(map(str, pieces.bytes_at)) + ")"


def _byte_fallback(pieces: Pieces, at: str) -> str:
    """SQL of the byte ids of the character at place ``at`` (from 0) of ``segment``."""
    char = f"substring(segment, {at} + 1, 1)"
    return f"""transform(sequence(0, octet_length({char}) - 1), k ->
        {_byte_ids(pieces)}[cast(conv(substring(hex(encode({char}, 'UTF-8')), k * 2 + 1, 2), 16, 10) as int)])"""


def _merge_ids(pieces: Pieces) -> str:
    """SQL of the ids after merging.

    The state: for every place the place of the next cut (-1: no cut here),
    and the edges that can still be taken, best first.  Each step takes the
    first edge with one cut inside, and drops those that begin or end there.
    """
    start, end = "cast(shiftright({0}, 32) & 4095 as int)", "cast(shiftright({0}, 20) & 4095 as int)"
    step = f"""
        transform(array(get(filter(x.open, e -> get(x.next, get(x.next, {start.format("e")})) = {end.format("e")}), 0)), best ->
            if(best is null, named_struct('next', x.next, 'open', slice(x.open, 1, 0)),
               transform(array(named_struct('a', {start.format("best")}, 'b', {end.format("best")},
                                            'cut', get(x.next, {start.format("best")}))), t -> named_struct(
                   'next', transform(x.next, (v, i) -> if(i = t.a, t.b, if(i = t.cut, -1, v))),
                   'open', filter(x.open, e -> e <> best and {start.format("e")} <> t.cut and {end.format("e")} <> t.cut)))[0]
            ))[0]"""
    joined = f"""
        aggregate(sequence(1, n), named_struct(
                'next', transform(sequence(1, n + 1), i -> if(i > n, -1, i)),
                'open', filter(array_sort(edges), e -> {end.format("e")} - {start.format("e")} > 1)),
            (x, step) -> if(size(x.open) = 0, x, {step}), x -> x.next)"""
    # tokens hold start and id; a cut without a token is a character without a piece
    tokens = f"""array_sort(transform(filter(edges, e -> get(next, {start.format("e")}) = {end.format("e")}),
        e -> (shiftright(e, 32) & 4095) * {2 ** 20} + (e & {2 ** 20 - 1})))"""
    return f"""
        transform(array({joined}), next -> transform(array({tokens}), tokens ->
            if(size(tokens) = size(filter(next, v -> v > 0)), transform(tokens, t -> cast(t & {2 ** 20 - 1} as int)),
               flatten(transform(filter(sequence(0, n - 1), i -> get(next, i) > 0), i ->
                   transform(array(get(filter(tokens, t -> shiftright(t, 20) = i), 0)), t -> if(t is not null,
                       array(cast(t & {2 ** 20 - 1} as int)), {_byte_fallback(pieces, "i")}))[0]))))[0])[0]"""


def _viterbi_ids(pieces: Pieces) -> str:
    """SQL of the ids on the best path: the maps from a substring's ends are bound as a lambda's variable, once a segment."""
    by_ends = "map_from_entries(transform(filter(edges, e -> e.id is not null), " \
              "e -> named_struct('k', e.start * 4096 + e.end, 'v', e.{})))"
    # the ways hold the best score and start of every end so far, of equals the longest last piece
    cuts = f"""
        transform(array(aggregate(sequence(1, n), array(named_struct('s', 0.0D, 'at', 0)), (w, stop) ->
            array_append(w, array_max(transform(filter(edges, e -> e.end = stop), e -> named_struct(
                's', w[e.start].s + coalesce(e.score, {pieces.floor!r}D), 'at', -e.start)))))),
          ways -> reverse(aggregate(sequence(1, n), array(n), (c, step) -> if(element_at(c, -1) = 0, c,
            array_append(c, -ways[element_at(c, -1)].at)))))[0]"""
    return f"""
        transform(array(named_struct('ids', {by_ends.format("id")})), m ->
            transform(array({cuts}), cuts -> flatten(transform(sequence(0, size(cuts) - 2), i ->
                transform(array(m.ids[cuts[i] * 4096 + cuts[i + 1]]), id -> if(id is not null, array(id),
                    {_byte_fallback(pieces, "cuts[i]")}))[0])))[0])[0]"""


def fold(edges: DataFrame, pieces: Pieces, how: str) -> DataFrame:
    """(segment, parts, ids): each segment's ids by a higher-order fold over its edges."""
    ids = _merge_ids(pieces) if how == "merge" else _viterbi_ids(pieces)
    return (edges.withColumn("n", F.length("segment")).withColumn("ids", F.expr(ids))
            .select("segment", "parts", "ids"))


def _pack_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """mapInArrow (part, segment, ids): one compressed block of (segments, ids) for each part."""
    held: dict[int, tuple[list[str], list[bytes]]] = {}

    def flush():
        rows = [(p, zlib.compress(marshal.dumps(x), 1)) for p, x in held.items()]
        return pa.RecordBatch.from_arrays([pa.array([p for p, _ in rows], pa.int32()),
                                           pa.array([b for _, b in rows], pa.binary())], ["part", "block"])
    rows = 0
    for batch in batches:
        ids = batch.column(2)
        values = np.asarray(ids.values).astype("<u4")
        offsets = np.asarray(ids.offsets)
        for i, (part, segment) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)):
            a, b = held.setdefault(part, ([], []))
            a.append(segment)
            b.append(values[offsets[i]:offsets[i + 1]].tobytes())
        rows += batch.num_rows
        if rows > PACK_ROWS:
            yield flush()
            held, rows = {}, 0
    if held:
        yield flush()


def _runs(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The runs of ``values`` that begin at ``starts``, one after the other."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return values[np.repeat(starts - (ends - sizes), sizes) + np.arange(total)]


def _encode_part(pieces: Pieces, how: str, max_segment: int):
    """The ids of the texts of one part, from its own blocks of folded segments.

    Segments over ``max_segment`` characters are folded here, and so are those without an edge: their ids are bytes.
    """
    normal = pieces.normal
    cut = Cutter(pieces.pairs)

    def folded_here(s: str) -> np.ndarray:
        if len(s) <= max_segment and any(c in normal for c in s):
            raise KeyError(f"the lattice has not folded {s!r}")
        return np.array(FOLDS[how](s, pieces), "<u4")

    def run(pair):
        rows, blocks = pair
        names: list[str] = []
        packed: list[bytes] = []
        for block in blocks:
            segments, ids = marshal.loads(zlib.decompress(block))
            names += segments
            packed += ids
        known = pa.array(names, pa.string())
        own = [np.frombuffer(b"".join(packed), "<u4")]
        sizes = np.array([len(x) // 4 for x in packed], np.int64)
        names.clear()
        packed.clear()
        for some in _slices(iter(rows), SLICE_CHARS):
            words, first_word = cut.words([t for _, t in some])
            coded = words.dictionary_encode()
            segments, _, first = cut.segments(coded.dictionary)
            at = pc.index_in(segments, value_set=known)
            if at.null_count:
                others = segments.filter(pc.is_null(at)).unique()
                own += [folded_here(s) for s in others.to_pylist()]
                sizes = np.append(sizes, [len(x) for x in own[1:]]).astype(np.int64)
                known, own = pa.concat_arrays([known, others]), [np.concatenate(own)]
                at = pc.index_in(segments, value_set=known)
            at = at.to_numpy()
            # first the ids of each distinct word, then those of all words
            ends = np.append(0, np.cumsum(sizes[at]))
            ids = _runs(own[0], (np.cumsum(sizes) - sizes)[at], sizes[at])
            begin, length = ends[first[:-1]], np.diff(ends[first])
            which = coded.indices.to_numpy()
            ids = _runs(ids, begin[which], length[which])
            ends = np.append(0, np.cumsum(length[which]))[first_word].tolist()
            for (doc_id, _), a, b in zip(some, ends, ends[1:], strict=False):
                yield doc_id, b - a, ids[a:b].tobytes()
        for held in (rows, blocks):
            held.clear()
        give_back()
    return run


class _ChunkRows:
    """The texts of chunks with their places; a chunk is read when its turn comes."""

    def __init__(self, chunks: list[pa.Buffer]):
        self.chunks, self.ids = chunks, []

    def __iter__(self) -> Iterator[tuple[int, str | None]]:
        while self.chunks:
            read = pa.ipc.open_stream(self.chunks.pop(0)).read_all()
            self.ids += read["doc_id"].chunks
            yield from enumerate(read["text"].to_pylist())

    def clear(self) -> None:
        self.chunks.clear()


def _encode_chunks(pieces: Pieces, how: str, max_segment: int):
    """cogroup by part: doc_id, n_tokens and ids of the rows in a part's chunks, by its blocks."""
    def run(chunks: pa.Table, blocks: pa.Table) -> pa.Table:
        give_back()  # what the part before has returned
        rows = _ChunkRows([c.as_buffer() for c in chunks["chunk"]])
        encoded = _encode_part(pieces, how, max_segment)((rows, blocks["block"].to_pylist()))
        counts, ids = [], []
        while some := list(islice(encoded, 1_000)):
            counts.append(pa.array([n for _, n, _ in some], pa.int64()))
            ids.append(pa.array([x for _, _, x in some], pa.binary()))
        return pa.table([pa.chunked_array(rows.ids), pa.chunked_array(counts), pa.chunked_array(ids)],
                        ["doc_id", "n_tokens", "ids"])
    return run


def encode(docs: DataFrame, pieces: Pieces, how: str = "merge", id_col: str = "doc_id", text_col: str = "text",
           max_segment: int = MAX_SEGMENT) -> DataFrame:
    """doc_id, n_tokens and ids (little-endian unsigned 32-bit numbers) of every row of ``docs``.

    ``how``: ``merge`` for models of merge ranks, ``viterbi`` for unigram models.
    """
    if how not in FOLDS:
        raise ValueError(f"how must be one of {sorted(FOLDS)}")
    max_segment = min(max_segment, 4095)  # an edge has 12 bits for a place
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    # both read the same rows, and so find the same parts
    segments = rows.mapInArrow(trimmed(_segment_batches(pieces.pairs, max_segment)), "segment string, part int")
    chunks = rows.mapInArrow(trimmed(_text_chunks), "part int, chunk binary")
    folded = fold(lattice(segments, pieces, how), pieces, how)
    packed = (folded.select(F.explode("parts").alias("part"), "segment", "ids")
              .mapInArrow(trimmed(_pack_parts), "part int, block binary"))
    return chunks.groupBy("part").cogroup(packed.groupBy("part")).applyInArrow(
        _encode_chunks(pieces, how, max_segment), T.StructType([
            T.StructField("doc_id", docs.schema[id_col].dataType), T.StructField("n_tokens", T.LongType()),
            T.StructField("ids", T.BinaryType())]))


def decoder(pieces: Pieces):
    """A function from ids (as bytes) to text: the pieces' bytes one after the other, without the first mark."""
    surface = np.array(pieces.surface, object)

    def text(ids: bytes) -> str:
        joined = b"".join(surface[np.frombuffer(ids, "<u4")].tolist())
        return (joined[1:] if joined.startswith(b" ") else joined).decode("utf-8", "replace")
    return text


def decode(encoded: DataFrame, pieces: Pieces, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """doc_id and text of every row of ids; null ids give the empty text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        text = decoder(pieces)
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(batch.num_columns - 1)),
                 pa.array([text(x.as_py() or b"") for x in batch.column(batch.num_columns - 1)], pa.string())],
                [*batch.schema.names[:-1], "text"])
    others = [c for c in encoded.columns if c != ids_col]
    schema = T.StructType([encoded.schema[c] for c in others] + [T.StructField("text", T.StringType())])
    return encoded.select(*others, ids_col).mapInArrow(trimmed(run), schema)

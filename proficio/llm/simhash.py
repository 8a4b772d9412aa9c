"""Near-duplicate documents by SimHash fingerprints and pigeonhole blocks.

A 64-bit fingerprint takes each bit's majority over the XXH64 hashes (seed
42) of a text's word shingles.  Fingerprints within ``max_bits`` differing
bits agree on at least ``blocks - max_bits`` of ``blocks`` blocks, so each
distinct fingerprint is keyed by every choice of that many blocks, equal keys
meet in one sorted run, and the Hamming distance is verified.  A run yields a
spanning forest of its links, not its pairs; runs longer than ``run_rows``
are dealt out as pairs of slices.  Components follow from the links.

Defined cases: a null text has no words, like an empty one: fingerprint zero,
linked like any other; fewer words than a shingle give one shingle of all;
component_id is the smallest doc_id that is not null; repeated rows share
their fingerprint; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from proficio.llm._util import fresh, trimmed
from proficio.llm.components import components
from proficio.session import materialize

SEED = 42
SHINGLE = 4
MAX_BITS = 4
BLOCKS = 7
RUN_ROWS = 2048
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_SLICE = 1 << 15


def simhash(text: str | None, shingle: int = SHINGLE) -> int:
    """The unsigned 64-bit fingerprint of one text."""
    words = (text or "").encode().translate(_LOWER).split()  # bytes split at \x20 and \x09-\x0D
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    joined = b" ".join(words)
    ends = list(accumulate((len(w) + 1 for w in words)))
    starts = [0, *ends[:n - 1]]
    ends = ends[min(shingle, len(words)) - 1:]
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for i in range(0, n, _SLICE):
        h = np.array([digest(joined[a:b - 1], SEED) for a, b in zip(starts[i:i + _SLICE], ends[i:i + _SLICE],
                                                                   strict=True)], np.uint64)
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(ones * 2 > n, bitorder="little").view(np.uint64)[0])


def _fingerprint_batches(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.fromiter((simhash(t.as_py(), shingle) for t in batch.column(2)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(fps.view(np.int64))],
                                             ["doc_id", "text_hash", "fp"])
    return run


def fingerprint_table(docs: DataFrame, shingle: int = SHINGLE, id_col: str = "doc_id",
                      text_col: str = "text") -> DataFrame:
    """doc_id, text_hash and fp (the fingerprint as a signed bigint) of every row."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("text_hash"),
                       F.col(text_col).alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(trimmed(_fingerprint_batches(shingle)), f"doc_id {kind}, text_hash bigint, fp bigint")


def block_masks(blocks: int = BLOCKS) -> list[int]:
    """Masks of ``blocks`` runs of nearly equal width that make up 64 bits."""
    cuts = [64 * i // blocks for i in range(blocks + 1)]
    return [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(cuts, cuts[1:], strict=False)]


def block_choices(blocks: int, max_bits: int) -> list[tuple[int, ...]]:
    if not 0 <= max_bits < blocks <= 64:
        raise ValueError("0 <= max_bits < blocks <= 64 is needed")
    return list(combinations(range(blocks), blocks - max_bits))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def key_rows(fps: DataFrame, blocks: int, max_bits: int) -> DataFrame:
    """(choice, key, fp): the fingerprint's bits in each choice of blocks."""
    masks = block_masks(blocks)
    keys = [F.struct(F.lit(i).alias("choice"),
                     F.col("fp").bitwiseAND(F.lit(_signed(sum(masks[b] for b in c))).cast("bigint")).alias("key"))
            for i, c in enumerate(block_choices(blocks, max_bits))]
    return fps.select(F.explode(F.array(*keys)).alias("k"), "fp").select("k.choice", "k.key", "fp")


def _first_choice(x: np.ndarray, masks: np.ndarray, choice: tuple[int, ...]) -> np.ndarray:
    """Where ``choice`` is the first choice of blocks on which a pair with differing bits ``x`` agrees.

    A pair agrees on ``choice`` already; it is the first if every block that
    comes before the choice's last one and is not in it differs.
    """
    ok = np.ones(x.shape, bool)
    for b in range(choice[-1] if choice else 0):
        if b not in choice:
            ok &= (x & masks[b]) != 0
    return ok


def _forest(fps: np.ndarray, masks: np.ndarray, choice: tuple[int, ...], max_bits: int) -> np.ndarray:
    """Rows (root, member) that connect what is linked within one run of distinct fingerprints."""
    n = len(fps)
    label = np.arange(n)
    for i in range(0, n, 256):
        x = fps[i:i + 256, None] ^ fps[None, :]
        near = (np.bitwise_count(x) <= max_bits) & _first_choice(x, masks, choice)
        a, b = np.nonzero(near)
        a += i
        a, b = a[a < b], b[a < b]
        while True:  # hook the larger root of each link on the smaller, then jump to the roots
            la, lb = label[a], label[b]
            open_ = la != lb
            if not open_.any():
                break
            a, b, la, lb = a[open_], b[open_], la[open_], lb[open_]
            np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
            while (label[label] != label).any():
                label = label[label]
    member = np.nonzero(label != np.arange(n))[0]
    return np.stack([fps[label[member]], fps[member]], axis=1)


def _link_runs(blocks: int, max_bits: int, run_rows: int):
    """mapInArrow over rows sorted by (choice, key): links of each run, and the rows of runs too long."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        masks = np.array(block_masks(blocks), np.uint64)
        choices = block_choices(blocks, max_bits)
        held: tuple[int, int] | None = None
        rows: list[np.ndarray] = []
        spilling = False

        def out(choice, key, a, b):
            return pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(a), choice, np.int32)), pa.array(np.full(len(a), key, np.int64)),
                 pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["choice", "key", "a", "b"])

        def close():
            if held is None:
                return
            fps = np.concatenate(rows) if rows else np.empty(0, np.uint64)
            if spilling:
                if len(fps):
                    yield out(*held, fps, fps)
            elif len(fps) > 1:
                links = _forest(fps, masks, choices[held[0]], max_bits)
                if len(links):
                    yield out(-1, 0, np.ascontiguousarray(links[:, 0]), np.ascontiguousarray(links[:, 1]))

        for batch in batches:
            if not batch.num_rows:
                continue
            choice = batch.column(0).to_numpy(zero_copy_only=False)
            key = batch.column(1).to_numpy(zero_copy_only=False)
            fp = np.ascontiguousarray(batch.column(2).to_numpy(zero_copy_only=False)).view(np.uint64)
            new = np.nonzero((choice[1:] != choice[:-1]) | (key[1:] != key[:-1]))[0] + 1
            starts, ends = np.concatenate([[0], new]), np.concatenate([new, [len(key)]])
            # runs of one row within the batch have no links; the first and last may go on in others
            worth = np.nonzero(ends - starts > 1)[0]
            for r in sorted({0, len(starts) - 1, *worth.tolist()}):
                at = (int(choice[starts[r]]), int(key[starts[r]]))
                if at != held:
                    yield from close()
                    held, rows, spilling = at, [], False
                rows.append(fp[starts[r]:ends[r]])
                if sum(map(len, rows)) > run_rows:
                    spilling = True
                if spilling:
                    yield from close()
                    rows = []
        yield from close()
    return run


def _link_slices(blocks: int, max_bits: int):
    masks = np.array(block_masks(blocks), np.uint64)
    choices = block_choices(blocks, max_bits)

    def run(group: pd.DataFrame) -> pd.DataFrame:
        fps = group["a"].to_numpy(np.int64).view(np.uint64)
        links = _forest(fps, masks, choices[int(group["choice"].iloc[0])], max_bits)
        return pd.DataFrame({"a": links[:, 0].copy().view(np.int64), "b": links[:, 1].copy().view(np.int64)})
    return run


def fingerprint_links(fps: DataFrame, blocks: int = BLOCKS, max_bits: int = MAX_BITS,
                      run_rows: int = RUN_ROWS) -> DataFrame:
    """(a, b) links that connect all distinct fingerprints ``fp`` within ``max_bits`` bits.

    Each close pair is looked at under the first choice of blocks it agrees
    on; every run or pair of slices gives at most as many links as it has
    fingerprints.
    """
    keyed = key_rows(fps, blocks, max_bits)
    ran = materialize(
        keyed.repartition("choice", "key").sortWithinPartitions("choice", "key")
        .mapInArrow(trimmed(_link_runs(blocks, max_bits, run_rows)), "choice int, key bigint, a bigint, b bigint"),
        "simhash-runs")
    links = ran.where("choice < 0").select("a", "b")
    long = ran.where("choice >= 0").select("choice", "key", "a")
    if long.isEmpty():
        return links
    slices = long.groupBy("choice", "key").agg(F.ceil(F.count("*") / (run_rows // 2)).cast("int").alias("n"))
    dealt = (long.join(slices, ["choice", "key"])
             .withColumn("s", F.pmod(F.xxhash64("a"), F.col("n")).cast("int"))
             .withColumn("t", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
             .withColumn("i", F.least("s", "t")).withColumn("j", F.greatest("s", "t")))
    more = dealt.groupBy("choice", "key", "i", "j").applyInPandas(_link_slices(blocks, max_bits), "a bigint, b bigint")
    return links.unionByName(more)


def fingerprint_hex(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def simhash_groups(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, blocks: int = BLOCKS,
                   run_rows: int = RUN_ROWS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text_hash, fingerprint, component_id and kept of every row of ``docs``.

    ``kept`` marks the rows of one (doc_id, text) of each component, the one
    with the smallest doc_id (nulls last, ties by text hash).
    """
    rows = materialize(fingerprint_table(docs, shingle, id_col, text_col), "simhash-rows")
    per_fp = materialize(rows.groupBy("fp").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("least")), "simhash-fps")
    roots = components(fingerprint_links(per_fp.select("fp"), blocks, max_bits, run_rows))
    named = per_fp.join(roots.select(F.col("a").alias("fp"), F.col("b").alias("up")), "fp", "left") \
        .withColumn("root", F.coalesce("up", "fp"))
    best = named.groupBy("root").agg(F.min("least").alias("best"))
    of_fp = named.join(best, "root").select("fp", "best")
    judged = rows.join(of_fp, "fp")
    return judged.select("doc_id", "text_hash", fingerprint_hex(F.col("fp")).alias("fingerprint"),
                         F.col("best.doc_id").alias("component_id"),
                         (F.col("doc_id").eqNullSafe(F.col("best.doc_id"))
                          & F.col("text_hash").eqNullSafe(F.col("best.text_hash"))).alias("kept"))


def drop_near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS,
                         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, one document of each component, with all their columns."""
    kept = materialize(simhash_groups(docs, shingle, max_bits, id_col=id_col, text_col=text_col)
                       .where("kept").groupBy("doc_id", "text_hash").agg(F.count("*").alias("copies")), "simhash-kept")
    hashed, k_id, k_hash = (fresh(docs, c) for c in ("text_hash_64", "k_id", "k_hash"))
    keyed = docs.withColumn(hashed, F.xxhash64(text_col))
    left = keyed.join(kept.select(F.col("doc_id").alias(k_id), F.col("text_hash").alias(k_hash)),
                      keyed[id_col].eqNullSafe(F.col(k_id)) & (keyed[hashed] == F.col(k_hash)), "left_semi")
    if not kept.where("copies > 1").isEmpty():  # rows repeated with the same doc_id and text
        left = left.dropDuplicates([id_col, hashed])
    return left.drop(hashed)

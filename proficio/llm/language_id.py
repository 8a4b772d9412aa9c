"""Language identification by character language models.

One interpolated Kneser-Ney model of ``order`` characters per language is
counted on a bounded, labelled sample: at most ``train_docs`` documents of
every language, and of a text over ``max_train_chars`` characters a span of
that length at a place chosen by hash.  The models of ``BLOCK_LANGUAGES``
languages at a time are merged into sorted arrays of n-gram hashes, one per
order, with a row of log probabilities (a column per language) for each hash,
and back-off weights by context, so the model grows in step with the number of
languages.  Labels whose models would take over ``max_model_bytes`` stop the
training with an error; none is left out.  A text is scored whole, letters
lower-cased and everything else as one space; the language with the lowest
cross-entropy per character wins.

Other documents, at most ``calibration_docs`` of every language, are kept out
of the counts: on them the temperature of the score and the limit of rejection
are fitted.  A text is rejected when its cross-entropy lies further above its
language's usual one, in standard errors for its length, than the limit: the
quantile that ``false_rejects`` of the calibration texts exceed.  Where fewer
than ``TAIL_TEXTS`` texts would lie above it, it is carried on from the
quantile that so many exceed (see :func:`tail_quantile`), so a few odd texts
among the labelled ones do not set it.

Defined cases: a text that is null or has no letter is ``und``, scored 0 and
not accepted; so is every text when there is nothing to learn from; equal
cross-entropies go to the first language in alphabetical order; repeated rows
are judged alike, and learned from once; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from statistics import NormalDist

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from proficio.llm._util import give_back, trimmed, worker_store
from proficio.llm.windows import gram_hashes
from proficio.session import materialize

ORDER = 4
TRAIN_DOCS = 400
MAX_TRAIN_CHARS = 20_000
BLOCK_LANGUAGES = 8
MAX_MODEL_BYTES = 512 << 20
CALIBRATION_SHARE = 4      # every so manieth sampled document is kept out of the counts
CALIBRATION_DOCS = 4000    # a language; those beyond the sample are all kept out
TAIL_TEXTS = 10            # calibration texts above any quantile that is used as it stands
UNKNOWN = "und"
_BASE = 0x9E3779B97F4A7C15
_SPACE, _PAD = 32, 1
_CHUNK = 1 << 18
_BUCKET_BITS = 18
_FLOOR = -20.0             # log2 of a character among about a million


def letter_table() -> np.ndarray:
    """Per code point: its lower-case letter, or a space if it is no letter."""
    store = worker_store()
    if "letters" not in store:
        table = np.full(0x110000, _SPACE, np.uint32)
        for i in range(0x110000):
            c = chr(i)
            if c.isalpha():
                low = c.lower()
                table[i] = ord(low) if len(low) == 1 else i
        store["letters"] = table
    return store["letters"]


def characters(texts: list[str | None], order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(code points of all texts, the text each belongs to, letters per text).

    Each text begins with ``order - 1`` pad characters; runs of other than
    letters are one space, and none stands at the beginning.
    """
    texts = [t or "" for t in texts]
    pad = "\x01" * (order - 1)
    raw = np.frombuffer((pad + pad.join(texts)).encode("utf-32-le"), np.uint32)
    sizes = np.array([len(t) + order - 1 for t in texts], np.int64)
    owner = np.repeat(np.arange(len(texts)), sizes)
    place = np.arange(len(raw)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    mapped = letter_table()[raw]
    mapped[place < order - 1] = _PAD
    before = np.concatenate([[_PAD], mapped[:-1]])
    keep = (mapped != _SPACE) | ((before != _SPACE) & (before != _PAD))
    letters = np.bincount(owner[(mapped != _SPACE) & (mapped != _PAD)], minlength=len(texts))
    return mapped[keep], owner[keep], letters


def _gram_columns(codes: np.ndarray, order: int) -> list[np.ndarray]:
    """Per n up to ``order``, the hash of the n characters that end at each position (0 before there are n)."""
    codes = codes.astype(np.uint64) + np.uint64(1)
    out = []
    for n in range(1, order + 1):
        h = gram_hashes(codes, n, _BASE + 2 * n)
        out.append(np.concatenate([np.zeros(len(codes) - len(h), np.uint64), h]))
    return out


def _count_batches(order: int):
    """mapInArrow (lang, text): distinct n-grams with context and suffix hashes and their counts, per batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = np.array(batch.column(0).to_pylist(), object)
            texts = batch.column(1).to_pylist()
            for lang in sorted(set(langs)):
                codes, _, _ = characters([t for t, x in zip(texts, langs, strict=True) if x == lang], order)
                grams = _gram_columns(codes, order)
                real = np.nonzero(codes != _PAD)[0]
                for n in range(1, order + 1):
                    own = grams[n - 1][real]
                    # the context ends one character earlier; the suffix is the next shorter gram here
                    context = grams[n - 2][real - 1] if n > 1 else np.zeros(len(real), np.uint64)
                    suffix = grams[n - 2][real] if n > 1 else np.zeros(len(real), np.uint64)
                    g, first, counts = np.unique(own, return_index=True, return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(g), pa.string()), pa.array(np.full(len(g), n, np.int32)),
                         pa.array(g.view(np.int64)), pa.array(context[first].view(np.int64)),
                         pa.array(suffix[first].view(np.int64)), pa.array(counts.astype(np.int64))],
                        ["lang", "n", "gram", "context", "suffix", "count"])
    return run


@dataclass
class HashRows:
    """Sorted hashes with a row of floats each, found through the buckets of their leading bits."""

    hashes: np.ndarray
    rows: np.ndarray
    shift: np.uint64 = field(init=False)
    starts: np.ndarray = field(init=False)
    probes: int = field(init=False)

    def __post_init__(self):
        bits = min(_BUCKET_BITS, len(self.hashes).bit_length() + 1)
        self.shift = np.uint64(64 - bits)
        top = (self.hashes >> self.shift).astype(np.int64)
        self.starts = np.searchsorted(top, np.arange((1 << bits) + 1)).astype(np.int32)
        self.probes = int(np.diff(self.starts).max()) if len(self.hashes) else 0

    def find(self, wanted: np.ndarray) -> np.ndarray:
        """The position of each hash, or -1."""
        at = self.starts[(wanted >> self.shift).astype(np.int64)]
        found = np.full(len(wanted), -1, np.int32)
        for k in range(self.probes):
            here = np.minimum(at + k, len(self.hashes) - 1)
            found = np.where(self.hashes[here] == wanted, here, found)
        return found


@dataclass
class Block:
    """Merged Kneser-Ney models; ``grams[n-1]`` and ``backoff[n-1]`` hold log2 values per language."""

    languages: list[str]
    grams: list[HashRows]
    backoff: list[HashRows]

    def nbytes(self) -> int:
        return sum(t.hashes.nbytes + t.rows.nbytes + t.starts.nbytes for t in self.grams + self.backoff)

    def log2(self, grams: list[np.ndarray], place: np.ndarray, floor: float) -> np.ndarray:
        values = np.zeros((len(place), len(self.languages)), np.float32)
        todo = np.arange(len(place))
        for n in range(len(self.grams), 0, -1):
            table = self.grams[n - 1]
            found = table.find(grams[n - 1][place[todo]])
            hit = found >= 0
            values[todo[hit]] += table.rows[found[hit]]
            todo = todo[~hit]
            if not len(todo):
                return values
            if n > 1:
                weights = self.backoff[n - 1]
                known = weights.find(grams[n - 2][place[todo] - 1])
                values[todo[known >= 0]] += weights.rows[known[known >= 0]]
        values[todo] += np.float32(floor)
        return values


@dataclass
class LanguageModel:
    """The models of all languages, ``BLOCK_LANGUAGES`` in a block."""

    order: int
    languages: list[str]
    blocks: list[Block]
    floor: float
    mean: np.ndarray | None = None       # usual bits per character of each language
    spread: tuple[float, float] = (0.0, 1.0)  # variance of documents, and of characters
    limit: float = float("inf")          # standard errors above the mean that are rejected
    temperature: float = 1.0

    def bits(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(bits per text and language, characters, letters), over the whole texts."""
        total = np.zeros((len(texts), len(self.languages)))
        length = np.zeros(len(texts), np.int64)
        letters = np.zeros(len(texts), np.int64)
        at = 0
        while at < len(texts):
            end, size = at, 0
            while end < len(texts) and (end == at or size < _CHUNK):
                size += len(texts[end] or "")
                end += 1
            codes, owner, letters[at:end] = characters(texts[at:end], self.order)
            real = np.nonzero(codes != _PAD)[0]
            grams = _gram_columns(codes, self.order)
            for i in range(0, len(real), _CHUNK):  # a single text may be longer than a chunk
                place = real[i:i + _CHUNK]
                own = owner[place]
                length[at:end] += np.bincount(own, minlength=end - at)
                k = 0
                for block in self.blocks:
                    values = block.log2(grams, place, self.floor)
                    for column in range(values.shape[1]):
                        total[at:end, k] -= np.bincount(own, values[:, column], minlength=end - at)
                        k += 1
            at = end
        return total, length, letters

    def judge(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """(language, score, accepted) of each text."""
        bits, length, letters = self.bits(texts)
        per_char = bits / np.maximum(length, 1)[:, None]
        best = per_char.argmin(axis=1)
        logits = -self.temperature * np.minimum(length, 64)[:, None] * (per_char - per_char.min(axis=1, keepdims=True))
        score = 1 / np.exp(logits).sum(axis=1)
        known = letters > 0
        error = np.sqrt(self.spread[0] + self.spread[1] / np.maximum(length, 1))
        above = (per_char.min(axis=1) - (self.mean[best] if self.mean is not None else 0)) / error
        langs = [self.languages[b] if k else UNKNOWN for b, k in zip(best, known, strict=True)]
        return langs, np.where(known, score, 0.0), known & (above <= self.limit)


def kneser_ney(counts: pd.DataFrame, order: int) -> Block:
    """Merge the counted n-grams of a few languages into one block of log2 probabilities."""
    languages = sorted(counts["lang"].unique())
    place = {x: i for i, x in enumerate(languages)}
    grams: list[HashRows] = []
    backoff: list[HashRows] = []
    lower: HashRows | None = None
    for n in range(1, order + 1):
        own = counts[counts["n"] == n]
        hashes, first = np.unique(own["gram"].to_numpy(np.int64).view(np.uint64), return_index=True)
        suffix = own["suffix"].to_numpy(np.int64).view(np.uint64)[first]
        context = own["context"].to_numpy(np.int64).view(np.uint64)[first]
        contexts, context_at = np.unique(context, return_inverse=True)
        if lower is None:
            base = np.full((len(hashes), len(languages)), 2.0 ** _FLOOR)
        else:                            # every suffix of a counted n-gram was counted as well
            base = np.exp2(lower.rows[np.searchsorted(lower.hashes, suffix)].astype(float))
        probability = np.zeros((len(hashes), len(languages)))
        weight = np.ones((len(contexts), len(languages)))
        for lang, k in place.items():
            c = np.zeros(len(hashes))
            if n == order:
                rows = own[own["lang"] == lang]
                at = np.searchsorted(hashes, rows["gram"].to_numpy(np.int64).view(np.uint64))
                c[at] = rows["count"].to_numpy(float)
            else:                        # in how many longer n-gram types it is the end
                longer = counts[(counts["n"] == n + 1) & (counts["lang"] == lang)]
                at = np.searchsorted(hashes, longer["suffix"].to_numpy(np.int64).view(np.uint64))
                np.add.at(c, at, 1.0)
            n1, n2 = (c == 1).sum(), (c == 2).sum()
            discount = n1 / (n1 + 2 * n2) if n1 and n2 else 0.5
            mass = np.bincount(context_at, c, minlength=len(contexts))
            kinds = np.bincount(context_at, c > 0, minlength=len(contexts))
            seen = mass > 0
            weight[seen, k] = discount * kinds[seen] / mass[seen]
            share = np.maximum(c - discount, 0) / np.where(seen, mass, 1)[context_at]
            probability[:, k] = share + weight[context_at, k] * base[:, k]
        lower = HashRows(hashes, np.log2(probability).astype(np.float32))
        grams.append(lower)
        backoff.append(HashRows(contexts, np.log2(weight).astype(np.float32)))
    return Block(languages, grams, backoff)


def merged_model(counted: DataFrame, languages: list[str], order: int, max_model_bytes: int) -> LanguageModel:
    """The model of all ``languages`` from the written n-gram counts, a block of languages at a time."""
    blocks: list[Block] = []
    size = 0
    for i in range(0, len(languages), BLOCK_LANGUAGES):
        own = languages[i:i + BLOCK_LANGUAGES]
        blocks.append(kneser_ney(counted.where(F.col("lang").isin(own)).toPandas(), order))
        size += blocks[-1].nbytes()
        if size > max_model_bytes:
            raise ValueError(f"the models of {i + len(own)} of {len(languages)} languages take {size} bytes, over "
                             f"max_model_bytes={max_model_bytes}: raise it, or lower train_docs or max_train_chars")
    # a character that no language knows takes the lowest order's back-off, too
    floor = _FLOOR + float(np.mean(np.concatenate([b.backoff[0].rows.ravel() for b in blocks])))
    return LanguageModel(order, languages, blocks, floor)


_TEMPERATURES = [2.0 ** e for e in range(-8, 3)]


def tail_quantile(values: np.ndarray, share: float) -> float:
    """What ``share`` of the values exceed, with ``TAIL_TEXTS`` values above every sample quantile used.

    With fewer values than that takes, the quantile that ``TAIL_TEXTS`` of
    them exceed (the upper quartile at most) is carried on along an
    exponential tail through the one that five times as many exceed.
    """
    high = max(share, min(TAIL_TEXTS / len(values), 0.25))
    at = float(np.quantile(values, 1 - high))
    if high <= share:
        return at
    low = min(5 * high, 0.5)
    return at + (at - float(np.quantile(values, 1 - low))) * np.log(high / share) / np.log(low / high)


def calibration_rows(model: LanguageModel, texts: list[str | None], langs: list[str]) -> pd.DataFrame:
    """own, right, length, bits a character in the own language and loss per temperature of each labelled text."""
    bits, length, letters = model.bits(texts)
    place = {x: i for i, x in enumerate(model.languages)}
    own = np.array([place.get(x, -1) for x in langs], np.int64)
    use = (letters > 0) & (own >= 0)
    own, length = own[use], length[use]
    per_char = bits[use] / length[:, None]
    rows = np.arange(len(own))
    gaps = np.minimum(length, 64)[:, None] * (per_char - per_char.min(axis=1, keepdims=True))
    loss = [np.log(np.exp(-t * gaps).sum(axis=1)) + t * gaps[rows, own] for t in _TEMPERATURES]
    return pd.DataFrame({"own": own, "right": per_char.argmin(axis=1) == own, "length": length,
                         "truth": per_char[rows, own], "loss": list(np.array(loss).T)})


def calibrate(model: LanguageModel, seen: pd.DataFrame, false_rejects: float) -> None:
    """Fit usual cross-entropies, their spread, the rejection limit and the score's temperature."""
    model.mean = np.zeros(len(model.languages))
    if not len(seen):
        return
    own, right, length, truth = (seen[c].to_numpy() for c in ("own", "right", "length", "truth"))
    model.temperature = _TEMPERATURES[int(np.mean(np.stack(seen["loss"].to_list()), axis=0).argmin())]
    overall = float(np.median(truth[right] if right.any() else truth))
    for k in range(len(model.languages)):
        mine = truth[(own == k) & right]
        model.mean[k] = np.median(mine) if len(mine) else overall
    if not right.any():
        return
    off, length = (truth - model.mean[own])[right], length[right]
    long = off[length >= 500]
    if len(long) > 1:                    # odd texts do not widen the spread
        long = long[long <= tail_quantile(long, false_rejects)]
    document = max(float(np.var(long)) if len(long) > 1 else 0.0, 0.02 ** 2)
    model.spread = (document, float(np.median(np.maximum(off ** 2 - document, 0) * length)) * 2 + 1.0)
    error = np.sqrt(model.spread[0] + model.spread[1] / length)
    # not below what errors of the normal distribution would give
    model.limit = max(NormalDist().inv_cdf(1 - false_rejects), tail_quantile(off / error, false_rejects))


def training_sample(train: DataFrame, id_col: str, text_col: str, lang_col: str, train_docs: int,
                    max_train_chars: int, calibration_docs: int = 0) -> DataFrame:
    """(lang, text, calibration): documents of each language, chosen by a hash of the id; of the first ``train_docs``
    every ``CALIBRATION_SHARE``-th is for calibration, as are up to ``calibration_docs`` in all;
    of a longer text a span of ``max_train_chars`` characters, its place chosen by a hash, too."""
    rows = train.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text")) \
        .where("lang is not null and length(text) > 0").withColumn("t", F.xxhash64("text"))
    picked = (rows.select("id", "lang", "t").withColumn("h", F.xxhash64("id", "lang"))
              .withColumn("nth", F.row_number().over(W.partitionBy("lang").orderBy("h", "id", "t")))
              .where(F.col("nth") <= train_docs + max(calibration_docs - train_docs // CALIBRATION_SHARE, 0)))
    chosen = (picked.groupBy(F.col("id").alias("c_id"), F.col("lang").alias("c_lang"), F.col("t").alias("c_t"))
              .agg(F.min("nth").alias("nth")))
    begin = F.pmod(F.xxhash64("t", "id"), F.greatest(F.length("text") - max_train_chars, F.lit(0)) + 1) + 1
    span = F.substring(F.col("text"), begin.cast("int"), F.lit(max_train_chars))
    return (rows.join(F.broadcast(chosen), F.col("id").eqNullSafe(F.col("c_id")) & (F.col("lang") == F.col("c_lang"))
                      & (F.col("t") == F.col("c_t")))
            .select("id", "lang", "t", span.alias("text"), "nth")
            .groupBy("id", "lang", "t").agg(F.first("text").alias("text"), F.first("nth").alias("nth"))
            .select("lang", "text", ((F.col("nth") > train_docs) | ((F.col("nth") % CALIBRATION_SHARE) == 0))
                    .alias("calibration")))


def train_model(train: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                order: int = ORDER, train_docs: int = TRAIN_DOCS, max_train_chars: int = MAX_TRAIN_CHARS,
                max_model_bytes: int = MAX_MODEL_BYTES, false_rejects: float = 0.001,
                calibration_docs: int = CALIBRATION_DOCS) -> LanguageModel | None:
    """The model of every language among the labelled rows ``train``, or None if there are none.

    What reaches the driver is bounded by the sample: the n-gram counts of
    ``BLOCK_LANGUAGES`` languages at a time, the models, up to
    ``max_model_bytes``, and a few numbers per calibration text, which the
    tasks that hold the texts compute.
    """
    sample = materialize(training_sample(train, id_col, text_col, lang_col, train_docs, max_train_chars,
                                         calibration_docs), "language-sample")
    counted = (sample.where("not calibration").select("lang", "text")
               .mapInArrow(trimmed(_count_batches(order)),
                           "lang string, n int, gram bigint, context bigint, suffix bigint, count bigint")
               .groupBy("lang", "n", "gram").agg(F.first("context").alias("context"),
                                                 F.first("suffix").alias("suffix"), F.sum("count").alias("count")))
    counted = materialize(counted, "language-counts")
    languages = sorted(r.lang for r in counted.select("lang").distinct().collect())
    if not languages:
        return None
    model = merged_model(counted, languages, order, max_model_bytes)
    def seen(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            yield calibration_rows(model, part["text"].tolist(), part["lang"].tolist())
    kept = sample.where("calibration").select("lang", "text").mapInPandas(
        seen, "own bigint, right boolean, length bigint, truth double, loss array<double>")
    calibrate(model, kept.toPandas(), false_rejects)
    return model


def judged(text: Column, model: LanguageModel | None) -> Column:
    """struct<lang, score, accepted> of a text column; the model, bounded by its sample, travels with the function."""
    kind = "struct<lang:string,score:double,accepted:boolean>"
    if model is None:
        return F.struct(F.lit(UNKNOWN).alias("lang"), F.lit(0.0).alias("score"), F.lit(False).alias("accepted"))

    @F.pandas_udf(kind)
    def judge(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for part in texts:
            lang, score, accepted = model.judge([t if isinstance(t, str) else None for t in part])
            yield pd.DataFrame({"lang": lang, "score": score, "accepted": accepted})
        give_back()
    return judge(text)


def identify(docs: DataFrame, model: LanguageModel | None, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score and accepted of every row of ``docs``, each text scored whole."""
    got = docs.select(F.col(id_col).alias("doc_id"), judged(F.col(text_col), model).alias("j"))
    return got.select("doc_id", F.col("j.lang").alias("lang_pred"), "j.score", "j.accepted")

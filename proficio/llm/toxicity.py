"""Toxicity by multiple-instance learning: documents are bags of sentences.

A sentence's score is the logistic of a sum over its words; a word's weight
is the sum of the weights of its features (the word, its beginnings and its
endings).  A document is toxic unless every sentence is clean
(noisy-or), so its label teaches the sentences which of them is to blame.
The weights are fitted on a bounded sample of labelled documents: Spark counts
which features toxic documents have more often, and gradient descent on the
documents' likelihood weighs these few.  A fifth of the sample, kept out of
the fit, calibrates the documents' scores.  Scoring reads every whole text, in
the tasks that hold it, with a memo of word weights; the sentences with the
highest scores are the offending ones.

Defined cases: null and empty texts, and texts without letters, have no
sentence: they get the lowest score of the calibration.  Very long texts are
scored whole, sentence by sentence.  Repeated rows are scored alike; a
document with several labels is toxic if one of them says so; labels of
null, or of ids that ``docs`` lacks, are not used.  With no toxic or no clean
labelled document there is no model and every score is 0.  Empty tables give
empty results; other columns of ``docs`` and ``labels`` are neither read nor
returned, whatever their names.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from proficio.llm._util import worker_store
from proficio.session import materialize

#: Bounds of the fit: labelled documents of either class, and characters of each.
TRAIN_DOCS = 4_000
MAX_TRAIN_CHARS = 20_000
#: Of the sample, every so-manieth document calibrates.
CALIBRATION_SHARE = 5
#: Features kept for the fit: toxic documents with it, and its share among them against that among the clean ones.
MIN_DOCS = 3
LIFT = 3.0
MEMO_WORDS = 200_000
COUNT_FEATURES = 200_000
SAMPLE = "toxic int, calibration boolean, t_hash bigint, text string"
THRESHOLD = 0.3

_SENTENCE = re.compile(r"[^.!?\n]+[.!?]*")
_WORD = re.compile(r"[^\W\d_]+")
_AFFIX = range(3, 9)


def word_features(word: str) -> list[str]:
    """Features of a lower-case word: itself, its beginnings and its endings of 3 to 8 characters."""
    found = [f"^{word}$"]
    for n in _AFFIX:
        if n >= len(word):
            break
        found += ["^" + word[:n], word[-n:] + "$"]
    return found


def sentence_words(text: str | None) -> list[tuple[int, int, list[str]]]:
    """(begin, end, words) of every sentence that has a letter; offsets are code points of the text."""
    found = []
    for m in _SENTENCE.finditer(text or ""):
        words = _WORD.findall(m.group().lower())
        if words:
            found.append((m.start(), m.end(), words))
    return found


@dataclass
class ToxicityModel:
    """Feature weights, bias and the calibration (slope, offset) of the documents' log-odds."""
    weights: dict[str, float]
    bias: float
    slope: float = 1.0
    offset: float = 0.0

    def calibrated(self, clean: np.ndarray) -> np.ndarray:
        """Document scores from the log-probabilities that all of a document's sentences are clean."""
        return logistic(self.slope * log_odds(clean) + self.offset)

    def word_weight(self, word: str) -> float:
        return sum(map(self.weights.get, filter(self.weights.__contains__, word_features(word))))

    def weigher(self):
        """A function from words to their weights, with a memo kept in the worker."""
        key = (self.bias, self.slope, self.offset, len(self.weights), sum(self.weights.values()))
        memo = worker_store().setdefault("toxicity_memo", {}).setdefault(key, {})

        def weigh(words: list[str]) -> list[float]:
            found = list(map(memo.get, words))
            if None in found:
                if len(memo) > MEMO_WORDS:
                    memo.clear()
                for i, x in enumerate(found):
                    if x is None:
                        found[i] = memo[words[i]] = self.word_weight(words[i])
            return found
        return weigh


def log_odds(clean: np.ndarray) -> np.ndarray:
    """log((1 - q) / q) of ``clean`` = log q, within -15 to 15."""
    clean = np.minimum(clean, -1e-12)
    return np.clip(np.log(-np.expm1(clean)) - clean, -15, 15)


def logistic(z: np.ndarray) -> np.ndarray:
    return np.exp(-np.logaddexp(0, -z))


def softplus(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, z)


def _feature_counts(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(feature, bad, good): toxic and clean documents of a batch with each feature."""
    for part in parts:
        counts: tuple[Counter, Counter] = (Counter(), Counter())
        for text, toxic in zip(part["text"], part["toxic"], strict=True):
            words = {w for _, _, found in sentence_words(text) for w in found}
            counts[toxic].update({f for w in words for f in word_features(w)})
            if sum(map(len, counts)) > COUNT_FEATURES:
                yield _counted(counts)
                counts = (Counter(), Counter())
        yield _counted(counts)


def _counted(counts: tuple[Counter, Counter]) -> pd.DataFrame:
    names = list(counts[0].keys() | counts[1].keys())
    return pd.DataFrame({"feature": pd.Series(names, dtype=object), "bad": [counts[1][f] for f in names],
                         "good": [counts[0][f] for f in names]})


def screened(sample: DataFrame) -> list[str]:
    """The features that are kept for the fit, counted over the sample's learning part.

    Kept are those of at least ``MIN_DOCS`` toxic documents whose share among
    the toxic ones is over ``LIFT`` times that among the clean ones.
    """
    learn = sample.where("not calibration")
    size = {r["toxic"]: r["count"] for r in learn.groupBy("toxic").count().collect()}
    found = (learn.select("text", "toxic").mapInPandas(_feature_counts, "feature string, bad bigint, good bigint")
             .groupBy("feature").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
             .where((F.col("bad") >= MIN_DOCS)
                    & (F.col("bad") / max(size.get(1, 0), 1) > LIFT * (F.col("good") + 1) / max(size.get(0, 0), 1))))
    return sorted(r["feature"] for r in found.select("feature").collect())


def _hits(kept: list[str]):
    """A function that finds the kept features of every sentence of the sample's texts."""
    place = {f: i for i, f in enumerate(kept)}

    def find(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        memo: dict[str, list[int]] = {}
        for part in parts:
            out = []
            for text in part["text"]:
                sent, feature, bag = [], [], sentence_words(text)
                for i, (_, _, words) in enumerate(bag):
                    for w in words:
                        if w not in memo:
                            memo[w] = [place[f] for f in word_features(w) if f in place]
                        if memo[w]:
                            feature += memo[w]
                            sent += [i] * len(memo[w])
                if len(memo) > MEMO_WORDS:
                    memo.clear()
                out.append((len(bag), sent, feature))
            n, sent, feature = zip(*out, strict=True) if out else ((), (), ())
            yield part[["toxic", "calibration", "t_hash"]].assign(n=n, sent=sent, feature=feature)
    return find


def fit(sample: DataFrame, rounds: int = 200, rate: float = 0.1,
        penalties: tuple[float, ...] = (0.3, 1.0, 3.0)) -> ToxicityModel:
    """The model of a labelled sample (toxic, calibration, t_hash, text).

    What reaches the driver is the kept features and where each document of
    the sample has them.  The calibration rows are kept out of the fit: they
    choose among the ``penalties`` (per unit of weight, divided by the number
    of texts) and calibrate the scores.  Weights are not negative: words can
    make a sentence toxic, none makes up for another.
    """
    kept = screened(sample)
    rows = (sample.mapInPandas(_hits(kept), "toxic int, calibration boolean, t_hash bigint, n bigint, sent array<int>, feature array<int>")
            .toPandas().sort_values(["t_hash", "n"], kind="stable"))
    design = Design.of(rows, len(kept))
    y, learn = rows["toxic"].to_numpy(float), ~rows["calibration"].to_numpy(bool)
    best = None
    for penalty in penalties:
        w, bias = descend(design, y, learn, rounds, rate, penalty / max(learn.sum(), 1))
        model = ToxicityModel({f: float(x) for f, x in zip(kept, w, strict=True) if x > 1e-3}, float(bias))
        clean = design.clean(w, bias)
        calibrate(model, clean[~learn], y[~learn])
        p = np.clip(model.calibrated(clean[~learn]), 1e-4, 1 - 1e-4)
        loss = -float(np.mean(np.where(y[~learn] > 0, np.log(p), np.log(1 - p)))) if len(p) else 0.0
        if best is None or loss < best[0]:
            best = (loss, model)
    return best[1]


@dataclass
class Design:
    """The sentences that have kept features, with these; ``plain`` counts each document's other sentences."""
    sent: np.ndarray
    feature: np.ndarray
    doc: np.ndarray
    plain: np.ndarray
    n_features: int

    @classmethod
    def of(cls, rows: pd.DataFrame, n_features: int) -> Design:
        per_doc = rows["feature"].map(len).to_numpy(np.int64)
        doc = np.repeat(np.arange(len(rows)), per_doc)
        flat = lambda c: np.concatenate([np.zeros(0, np.int64), *map(np.asarray, rows[c])]).astype(np.int64)
        key, sent = np.unique(doc << 32 | flat("sent"), return_inverse=True)
        doc = key >> 32
        return cls(sent, flat("feature"), doc, rows["n"].to_numpy(float) - np.bincount(doc, minlength=len(rows)), n_features)

    def log_odds(self, w: np.ndarray, bias: float) -> np.ndarray:
        return bias + np.bincount(self.sent, w[self.feature], minlength=len(self.doc))

    def clean(self, w: np.ndarray, bias: float) -> np.ndarray:
        """The log-probability that all of a document's sentences are clean."""
        return (-np.bincount(self.doc, softplus(self.log_odds(w, bias)), minlength=len(self.plain))
                - self.plain * softplus(np.array(bias)))


def descend(design: Design, y: np.ndarray, learn: np.ndarray, rounds: int, rate: float,
            penalty: float) -> tuple[np.ndarray, float]:
    """Weights (not negative) and bias that fit the noisy-or of the sentences to the documents' labels."""
    share = learn / max(learn.sum(), 1)
    x = np.append(np.zeros(design.n_features), -5.0)
    first, second = np.zeros(len(x)), np.zeros(len(x))
    for t in range(1, rounds + 1):
        z = design.log_odds(x[:-1], x[-1])
        clean = np.minimum(design.clean(x[:-1], x[-1]), -1e-12)
        odds = np.exp(clean) / -np.expm1(clean)
        gd = share * np.where(y > 0, -odds, 1.0)
        gz = gd[design.doc] * logistic(z)
        g = np.append(np.bincount(design.feature, gz[design.sent], minlength=design.n_features) + penalty,
                      gz.sum() + (gd * design.plain).sum() * logistic(np.array(x[-1])))
        first, second = 0.9 * first + 0.1 * g, 0.99 * second + 0.01 * g * g
        x = x - rate * (first / (1 - 0.9 ** t)) / (np.sqrt(second / (1 - 0.99 ** t)) + 1e-8)
        x[:-1] = np.maximum(x[:-1], 0)
    return x[:-1], float(x[-1])


def calibrate(model: ToxicityModel, clean: np.ndarray, y: np.ndarray) -> None:
    """Slope and offset of a logistic regression of the labels on the documents' log-odds.

    A weak prior (two documents, one of each label, at the ends) keeps the slope finite where all are told apart.
    """
    if not len(y) or y.min() == y.max():
        return
    x = np.append(log_odds(clean), [-6.0, 6.0]) / 5
    y = np.append(y, [0.0, 1.0])
    a, b = 5.0, 0.0
    for _ in range(50):                                       # Newton steps on two numbers
        p = logistic(a * x + b)
        r, v = p - y, np.maximum(p * (1 - p), 1e-9)
        g = np.array([(r * x).sum() + 1e-2 * (a - 5.0), r.sum()])
        h = np.array([[(v * x * x).sum() + 1e-2, (v * x).sum()], [(v * x).sum(), v.sum() + 1e-9]])
        da, db = np.clip(np.linalg.solve(h, g), -2, 2)
        a, b = a - da, b - db
    model.slope, model.offset = float(max(a, 0.5) / 5), float(b)


def training_sample(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    label_col: str = "toxic", train_docs: int = TRAIN_DOCS,
                    max_train_chars: int = MAX_TRAIN_CHARS) -> DataFrame:
    """(toxic, calibration, t_hash, text): up to ``train_docs`` labelled documents of either class, chosen by a hash of the id.

    The ids are chosen among the labels alone: the classes are counted, a
    hash threshold leaves little more than is wanted, and the smallest hashes
    of the rest are taken.  Only these ids (at most ``2 * train_docs``, hence
    the broadcast) meet the documents.  Of a longer text a span of
    ``max_train_chars`` characters is taken, its place chosen by a hash.
    """
    known = (labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
             .groupBy(F.col(id_col).alias("t_id")).agg(F.max(F.col(label_col).cast("int")).alias("t_toxic"))
             .withColumn("t_hash", F.pmod(F.xxhash64("t_id"), F.lit(1 << 30))))
    counts = {r["t_toxic"]: r["count"] for r in known.groupBy("t_toxic").count().collect() if r["t_toxic"] in (0, 1)}
    if len(counts) < 2:
        return docs.sparkSession.createDataFrame([], SAMPLE)
    parts = [known.where((F.col("t_toxic") == k) & (F.col("t_hash") <= (1 << 30) * min(1.0, 2 * train_docs / n)))
             .orderBy("t_hash", "t_id").limit(train_docs) for k, n in sorted(counts.items())]
    chosen = materialize(parts[0].unionByName(parts[1]), "toxicity-ids")
    text = F.col(text_col)
    begin = F.pmod(F.xxhash64(text), F.greatest(F.length(text) - max_train_chars, F.lit(0)) + 1) + 1
    rows = docs.select(F.col(id_col).alias("d_id"),
                       F.substring(text, begin.cast("int"), F.lit(max_train_chars)).alias("text")).where("text is not null")
    return (rows.join(F.broadcast(chosen), F.col("d_id") == F.col("t_id"))
            .groupBy("t_id", "t_hash", "t_toxic").agg(F.min("text").alias("text"))
            .select(F.col("t_toxic").alias("toxic"), (F.col("t_hash") % CALIBRATION_SHARE == 0).alias("calibration"), "t_hash", "text"))


def train_model(docs: DataFrame, labels: DataFrame, **options) -> ToxicityModel | None:
    """The model of a bounded sample of the labelled documents (see :func:`training_sample`), or None without both classes."""
    sample = materialize(training_sample(docs, labels, **options), "toxicity-sample")
    if sample.where("not calibration").select("toxic").distinct().count() < 2:
        return None
    return fit(sample)


def _scored(model: ToxicityModel, text: str | None, weigh) -> tuple[list[tuple[int, int, list[str]]], np.ndarray]:
    """The sentences of a text and their log-odds."""
    found = sentence_words(text)
    return found, np.array([model.bias + sum(weigh(words)) for _, _, words in found])


def score_documents(docs: DataFrame, model: ToxicityModel | None, id_col: str = "doc_id", text_col: str = "text",
                    threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, score, predicted, n_sentences, n_offending and worst_begin (offset of the worst sentence) of every row."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = "score double, n_sentences bigint, n_offending bigint, worst_begin bigint"
    if model is None:
        return rows.select("doc_id", F.lit(0.0).alias("score"), F.lit(0).alias("predicted"),
                           *[F.lit(0).cast("bigint").alias(c) for c in ("n_sentences", "n_offending")],
                           F.lit(None).cast("bigint").alias("worst_begin"))

    @F.pandas_udf(f"struct<{kind.replace(' ', ':').replace(',:', ',')}>")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        weigh = model.weigher()
        for part in texts:
            out = []
            for text in part:
                found, z = _scored(model, text if isinstance(text, str) else None, weigh)
                worst = found[int(z.argmax())][0] if found else None
                out.append((-softplus(z).sum() if found else 0.0, len(found), int((z >= 0).sum()), worst))
            clean, n, bad, worst = zip(*out, strict=True) if out else ((), (), (), ())
            yield pd.DataFrame({"score": model.calibrated(np.array(clean, float)), "n_sentences": n,
                                "n_offending": bad, "worst_begin": pd.array(worst, "Int64")})
    got = rows.select("doc_id", score("text").alias("s")).select("doc_id", "s.*")
    return got.select("doc_id", "score", (F.col("score") >= threshold).cast("int").alias("predicted"),
                      "n_sentences", "n_offending", "worst_begin")


def offending_sentences(docs: DataFrame, model: ToxicityModel | None, id_col: str = "doc_id",
                        text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """doc_id, begin, length (code points), score and text of every sentence that scores ``threshold`` or more."""
    kind = "begin bigint, length bigint, score double, sentence string"
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    if model is None:
        return rows.selectExpr("doc_id", "0L as begin", "0L as length", "0D as score", "text as sentence").where("false")

    @F.pandas_udf(f"array<struct<{kind.replace(' ', ':').replace(',:', ',')}>>")
    def locate(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        weigh = model.weigher()
        for part in texts:
            out = []
            for text in part:
                found, z = _scored(model, text if isinstance(text, str) else None, weigh)
                p = logistic(z)
                out.append([{"begin": b, "length": e - b, "score": float(s), "sentence": text[b:e]}
                            for (b, e, _), s in zip(found, p, strict=True) if s >= threshold])
            yield pd.Series(out)
    return rows.select("doc_id", F.explode(locate("text")).alias("s")).select("doc_id", "s.*")

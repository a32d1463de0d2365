"""Toxicity by two class-conditional Kneser-Ney bigram models with shared backoff counts."""

from __future__ import annotations

from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cafetal.llm.common import column, hashed_sample, materialise, slices

BITS = 19  # words are hashed to so many bits: what a model holds is bounded
_START = (1 << BITS) - 1  # the context of a text's first word
_BLANK = bytes(b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


def word_ids(text: str) -> np.ndarray:
    """Hashed words (runs of letters, lower case) of a text."""
    ws = text.lower().encode().translate(_BLANK).split()
    return np.fromiter(map(crc32, ws), np.int64, len(ws)) & _START


def pair_keys(ids: np.ndarray) -> np.ndarray:
    """Each word with the word before it, as one integer."""
    return np.append(_START, ids[:-1]) << BITS | ids if len(ids) else ids


@dataclass
class Model:
    """Log probability ratios of the two classes, as arrays of fixed size.

    ``word``: per class, the Kneser-Ney probability of a word from the number of its
    left neighbours, backed off to both classes' shared count.  ``back``: per class
    and context, the weight of that lower order.  ``pairs``: sorted keys of the
    pairs that keep mass of their own, and ``share``: that mass, per class.
    ``offset``: the difference at a word that neither class prefers; it is taken off
    every word, so that ordinary prose is at 0 whatever its length.
    """

    word: np.ndarray
    back: np.ndarray
    pairs: np.ndarray
    share: np.ndarray
    offset: float
    weights: np.ndarray

    def features(self, text: str) -> np.ndarray:
        """The log-likelihood difference, toxic less ordinary, over the length and over its root."""
        ids = word_ids(text)
        n = len(ids)
        if not n:
            return np.zeros(2)
        keys = pair_keys(ids)
        at = np.searchsorted(self.pairs, keys)
        at[at == len(self.pairs)] = 0
        hit = self.pairs[at] == keys if len(self.pairs) else np.zeros(n, bool)
        p = self.back[:, keys >> BITS] * self.word[:, ids]
        p[:, hit] += self.share[:, at[hit]]
        total = float(np.log(p[1] / p[0]).sum(dtype=np.float64)) - n * self.offset
        return np.array([total / n, total / np.sqrt(n)])

    def score(self, text: str) -> float:
        z = float(self.features(text) @ self.weights[:2] + self.weights[2])
        return float(1 / (1 + np.exp(-np.clip(z, -500, 500))))


def _excess(n: np.ndarray, totals: np.ndarray, least: float, times: float) -> np.ndarray:
    """Discounted counts of both classes (rows).

    The absolute discount grows with the other class's count: what that class
    would explain, ``times`` over and with ``least`` more occurrences than it has
    shown, plus ``least``.  So only expressions that one class clearly prefers
    keep mass of their own; rare and common ones are left to the shared counts.
    """
    totals = np.maximum(totals, 1)
    return np.maximum(n - least - times * totals * (n[::-1] + least) / totals[::-1], 0)


def _kneser_ney(words, contexts, pairs, discount: float, least: tuple[float, float],
                times: tuple[float, float]) -> Model:
    """Model without calibration from bounded tables of counts; class 0 is ordinary, 1 toxic."""
    size = 1 << BITS
    n = np.zeros((3, size))
    n[:, words.u.to_numpy()] = words[["o", "t", "both"]].to_numpy().T
    shared = np.maximum(n[2] - discount, 0) / max(n[2].sum(), 1)
    shared += (1 - shared.sum()) / size
    total = np.maximum(n[:2].sum(axis=1, keepdims=True), 1)
    word = _excess(n[:2], total, least[0], times[0]) / total
    rest = 1 - word.sum(axis=1, keepdims=True)
    word += rest * shared
    seen = np.zeros((2, size))
    seen[:, contexts.v.to_numpy()] = contexts[["o", "t"]].to_numpy().T
    context = pairs.k.to_numpy() >> BITS
    share = (_excess(pairs[["o", "t"]].to_numpy().T.astype(float), seen[:, context], least[1], times[1])
             / np.maximum(seen[:, context], 1))
    back = np.ones((2, size))  # what the pairs of a context don't hold goes to the lower order
    for c in (0, 1):
        np.subtract.at(back[c], context, share[c])
    kept = share.any(axis=0)
    return Model(word.astype(np.float32), back.astype(np.float32), pairs.k.to_numpy()[kept],
                 share[:, kept].astype(np.float32), float(np.log(rest[1, 0] / rest[0, 0])), np.zeros(3))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, rounds: int = 50) -> np.ndarray:
    """Weights (and an intercept) of a logistic fit in which both classes weigh the same."""
    scale = x.std(axis=0) + 1e-12
    x = np.column_stack([x / scale, np.ones(len(x))])
    w = np.where(y == 1, 0.5 / max(y.mean(), 1e-9), 0.5 / max(1 - y.mean(), 1e-9)) / max(len(y), 1)
    b = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -50, 50)))
        grad = x.T @ (w * (p - y)) + ridge * b
        hess = (x.T * (w * p * (1 - p))) @ x + ridge * np.eye(len(b))
        step = np.linalg.solve(hess, grad)
        b -= step / max(1.0, np.abs(step).max() / 2)
        if np.abs(step).max() < 1e-8:
            break
    return np.append(b[:-1] / scale, b[-1])


def _pair_counts(batches):
    """For each pair the ordinary and the toxic texts that hold it."""
    for b in slices(batches, 4096):
        toxic = np.array(column(b, "__toxic"), bool)
        texts = column(b, "__body")
        out = []
        for c in (False, True):
            keys = [np.unique(pair_keys(word_ids(t))) for t, y in zip(texts, toxic, strict=True) if y == c]
            out.append(np.unique(np.concatenate(keys), return_counts=True) if keys else
                       (np.zeros(0, np.int64), np.zeros(0, np.int64)))
        (k0, n0), (k1, n1) = out
        zero = [np.zeros(len(k), np.int64) for k in (k0, k1)]
        yield pa.RecordBatch.from_arrays([pa.array(np.append(k0, k1)), pa.array(np.append(n0, zero[1])),
                                          pa.array(np.append(zero[0], n1))], names=["k", "o", "t"])


def train(docs: DataFrame, labels: DataFrame, per_class: int = 25_000, pairs: int = 1 << 17, discount: float = 0.75,
          least: tuple[int, int] = (3, 10), times: tuple[float, float] = (2, 4), id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Fit on a bounded sample: up to ``per_class`` distinct labelled texts of each class.

    ``labels`` has ``doc_id`` and ``toxic``; rows with a null in either, or whose
    document is missing, are left out.  A text that occurs in several documents
    counts once, with its commonest label.  Texts are taken in the order of their
    hash.  Four fifths give the counts, the rest the calibration.
    With labelled texts of one class only, a text without words scores 0.5 less a hair.

    The upper order counts texts that hold a pair, the lower one (Kneser-Ney) the
    distinct left neighbours of a word, so copies don't raise it; ``least`` and
    ``times`` are the discounts of words and of pairs (see :func:`_excess`).

    What comes to the driver is bounded by parameters: 2^19 hashed words and
    contexts, at most ``pairs`` pairs, and the calibration's features.
    """
    body = F.coalesce(F.col(text_col), F.lit(""))
    hashed = docs.select(F.col(id_col).cast("long").alias("__id"), F.xxhash64(body).alias("__h"))
    known = (labels.select(F.col("doc_id").cast("long").alias("__lid"), F.col("toxic").cast("double").alias("__y"))
             .dropna().groupBy("__lid").agg(F.avg("__y").alias("__y")))
    texts = materialise(
        hashed.join(known, F.col("__id") == F.col("__lid")).groupBy("__h")
        .agg(F.min("__id").alias("__id"), (F.avg("__y") >= 0.5).alias("__toxic")), "toxicity-texts")
    total = {r["__toxic"]: r["count"] for r in texts.groupBy("__toxic").count().collect()}
    picked = [hashed_sample(texts.filter(F.col("__toxic") == c), "__h", per_class, total.get(c, 0)) for c in (True, False)]
    chosen = materialise(picked[0].union(picked[1]).select(F.col("__h").alias("__ch"), F.col("__id").alias("__cid"),
                                                           "__toxic"), "toxicity-sample")
    # a bounded sample of ids: 2 * per_class rows
    sample = (docs.select(F.col(id_col).cast("long").alias("__id"), F.xxhash64(body).alias("__h"), body.alias("__body"))
              .join(F.broadcast(chosen), (F.col("__id") == F.col("__cid")) & (F.col("__h") == F.col("__ch")))
              .select("__id", "__h", "__toxic", "__body").withColumn("__fold", F.pmod("__h", F.lit(5))))
    counts = materialise(
        sample.filter("__fold > 0").select("__toxic", "__body").mapInArrow(_pair_counts, "k long, o long, t long")
        .groupBy("k").agg(F.sum("o").alias("o"), F.sum("t").alias("t")), "toxicity-pairs")
    seen = {c: F.sum((F.col(c) > 0).cast("long")).alias(c) for c in "ot"}
    words = (counts.groupBy((F.col("k").bitwiseAND(_START)).cast("int").alias("u"))
             .agg(seen["o"], seen["t"], F.count("*").alias("both")).toPandas())
    contexts = (counts.groupBy(F.shiftright("k", BITS).cast("int").alias("v"))
                .agg(F.sum("o").alias("o"), F.sum("t").alias("t")).toPandas())
    common = (counts.filter(F.greatest("o", "t") > least[1]).orderBy(F.greatest("o", "t").desc(), "k")
              .limit(pairs).toPandas().sort_values("k"))
    model = _kneser_ney(words, contexts, common, discount, least, times)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def features(batches):
        for b in slices(batches):
            x = [shared.value.features(t) for t in column(b, "__body")]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([float(v[0]) for v in x], pa.float64()),
                                              pa.array([float(v[1]) for v in x], pa.float64())], names=["y", "a", "b"])

    got = (sample.filter("__fold = 0").select("__toxic", "__body")
           .mapInArrow(features, "y boolean, a double, b double").toPandas())
    y = got.y.to_numpy().astype(float)
    if len(y) and 0 < y.mean() < 1:
        model.weights = logistic(got[["a", "b"]].to_numpy(), y)
    else:  # one class at most to calibrate on: the bare comparison
        model.weights = np.array([0.0, 1.0, -1e-6])
    shared.unpersist()
    return model


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``score`` (0 to 1) and ``predicted`` (1 from 0.5 on) for every row, from its whole text.

    A null text is scored as the empty one, which has no words and gets the
    calibration's intercept.  Null ids are passed on; other columns don't matter.
    No shuffle; the broadcast model is bounded by the parameters of :func:`train`.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for b in slices(batches):
            s = np.array([shared.value.score(t) for t in column(b, "__body")], float)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(s), pa.array((s >= 0.5).astype(np.int32))],
                                             names=["doc_id", "score", "predicted"])

    return (docs.select(F.col(id_col).cast("long").alias("__id"), F.coalesce(text_col, F.lit("")).alias("__body"))
            .mapInArrow(run, "doc_id long, score double, predicted int"))


def keep_clean(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that score under 0.5, unchanged; judged where they are read, without a shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for b in slices(batches):
            yield b.filter(pa.array([shared.value.score(t or "") < 0.5 for t in column(b, text_col)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def fold(id_col: str = "doc_id", folds: int = 5):
    """The remainder that says which rows are held out: crc32 of the id as text."""
    return F.crc32(F.col(id_col).cast("long").cast("string").cast("binary")) % folds

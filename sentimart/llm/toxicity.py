"""Toxicity by non-negative positive-unlabelled learning.

A linear classifier over hashed word presence, fitted in numpy on a
bounded sample: confirmed toxic texts and texts taken as unlabelled.  With
``prior`` the share of toxic texts, the negative part of the risk is what
the unlabelled texts cost as negatives less ``prior`` times what the
positives would; where that estimate falls below zero (it fits the sample
too closely) the step goes against it, after Kiryo et al. (2017).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zlib
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import intermediates, stored, text_bytes
from .decontaminate import words_of

#: hashed features; bounds on the sample
FEATURES = 1 << 18
MAX_POSITIVE = 4_000
MAX_UNLABELLED = 16_000
#: a feature enters the model if it occurs in so many sample texts and its
#: rates in the two samples differ by so many standard errors
LEAST_TEXTS = 5
LEAST_Z = 5.0
_STEM = 5
_STEPS, _RATE, _DECAY = 200, 0.05, 1e-4


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    bias: float


def features(text: bytes) -> np.ndarray:
    """Numbers of a text's distinct words and word beginnings (lower-cased
    ASCII, see ``words_of``); the beginnings stand for inflected forms."""
    crc, low = zlib.crc32, FEATURES - 1
    words = set(words_of(text))
    stems = {w[:_STEM] for w in words}
    return np.array(list({crc(w) & low for w in words} | {crc(w, 1) & low for w in stems}), dtype=np.int64)


class _Rows:
    """Texts as sparse rows of the features that a model uses."""

    def __init__(self, at: np.ndarray, of: np.ndarray, n: int):
        self.at, self.of, self.n = at, of, n

    def margins(self, weights, bias):
        return np.bincount(self.of, weights[self.at], minlength=self.n) + bias

    def gradient(self, per_row, n_columns):
        return np.bincount(self.at, per_row[self.of], minlength=n_columns)


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def _seen(words: np.ndarray) -> np.ndarray:
    """How often each feature occurs, counted piece by piece."""
    out = np.zeros(FEATURES, dtype=np.int64)
    for at in range(0, len(words), 1 << 20):
        out += np.bincount(words[at:at + (1 << 20)], minlength=FEATURES)
    return out


def _telling(seen_p: np.ndarray, seen_u: np.ndarray, n_p: int, n_u: int) -> np.ndarray:
    """The features whose rates differ clearly between the samples, by the
    numbers of texts that hold them."""
    rate = (seen_p + seen_u) / (n_p + n_u)
    error = np.sqrt(np.maximum(rate * (1 - rate) * (1 / n_p + 1 / n_u), 1e-12))
    z = np.abs(seen_p / n_p - seen_u / n_u) / error
    return np.flatnonzero((z >= LEAST_Z) & (seen_p + seen_u >= LEAST_TEXTS))


def fit(words: np.ndarray, sizes: np.ndarray, positive: np.ndarray, prior: float) -> Model:
    """Minimise the non-negative PU risk with the logistic loss (Adam, full
    batches, from the prior: the same sample gives the same model).  Text i
    holds the next ``sizes[i]`` feature numbers of ``words`` and is a
    confirmed toxic one if ``positive[i]``, else unlabelled."""
    weights = np.zeros(FEATURES)
    prior = min(max(prior, 1e-4), 1 - 1e-4)
    bias = float(np.log(prior / (1 - prior)))
    n_p, n_u = int(positive.sum()), int((~positive).sum())
    if not n_p or not n_u:
        return Model(weights.astype(np.float32), bias)
    toxic = np.repeat(positive, sizes)
    seen_p = _seen(words[toxic])
    frequent = _telling(seen_p, _seen(words) - seen_p, n_p, n_u)
    column = np.full(FEATURES, -1, dtype=np.int32)
    column[frequent] = np.arange(len(frequent))
    used = np.flatnonzero(column[words] >= 0)
    number = np.where(positive, np.cumsum(positive), np.cumsum(~positive)) - 1     # among its own kind
    at, of, toxic = column[words[used]], np.repeat(number.astype(np.int32), sizes)[used], toxic[used]
    p, u = _Rows(at[toxic], of[toxic], n_p), _Rows(at[~toxic], of[~toxic], n_u)
    w = np.zeros(len(frequent) + 1)              # the bias comes last
    w[-1] = bias
    mean, square = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, _STEPS + 1):
        zp, zu = p.margins(w[:-1], w[-1]), u.margins(w[:-1], w[-1])
        negative = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        as_positive = -prior * _sigmoid(-zp) / p.n
        as_negative_p, as_negative_u = -prior * _sigmoid(zp) / p.n, _sigmoid(zu) / u.n
        if negative >= 0:
            gp, gu = as_positive + as_negative_p, as_negative_u
        else:
            gp, gu = -as_negative_p, -as_negative_u
        g = np.append(p.gradient(gp, len(frequent)) + u.gradient(gu, len(frequent)), gp.sum() + gu.sum())
        g[:-1] += _DECAY * w[:-1]
        mean = 0.9 * mean + 0.1 * g
        square = 0.99 * square + 0.01 * g * g
        w -= _RATE * (mean / (1 - 0.9 ** step)) / (np.sqrt(square / (1 - 0.99 ** step)) + 1e-8)
    weights[frequent] = w[:-1]
    return Model(weights.astype(np.float32), float(w[-1]))


def _features(batches):
    schema = pa.schema([("positive", pa.bool_()), ("doc_id", pa.int64()), ("text_key", pa.int64()),
                        ("words", pa.list_(pa.int32()))])
    for batch in batches:
        yield pa.RecordBatch.from_arrays(
            [batch.column("positive"), batch.column("doc_id"), batch.column("text_key"),
             pa.array([features(t).astype(np.int32) for t in text_bytes(batch.column("text"))], pa.list_(pa.int32()))],
            schema=schema)


def _fitted(prior: float):
    """Fits one model to a sample that is all in one group: its size is
    bounded by the limits of ``learn``."""
    def run(sample: pa.Table) -> pa.Table:
        words = sample.column("words").combine_chunks()
        sizes = np.diff(words.offsets.to_numpy())
        model = fit(words.flatten().to_numpy(), sizes,
                    sample.column("positive").to_numpy(), prior)
        return pa.table({"weights": pa.array([model.weights.tobytes()], pa.binary()), "bias": [model.bias]})
    return run


def learn(docs: DataFrame, labels: DataFrame, learnable, max_positive: int = MAX_POSITIVE,
          max_unlabelled: int = MAX_UNLABELLED) -> Model:
    """Fit on the rows of ``docs`` (doc_id, text) for which the column
    ``learnable`` holds: the confirmed ones (``labels.toxic`` = 1) and
    unlabelled ones, each at most ``max_...`` rows of different doc_id and
    text, taken by a hash of the doc_id.  The prior is the toxic share of all labelled learnable rows."""
    ids = docs.filter(learnable & F.col("doc_id").isNotNull()).select("doc_id")
    marks = labels.filter("toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = ids.join(marks, "doc_id")
    n, toxic = known.agg(F.count("*"), F.sum((F.col("toxic") == 1).cast("long"))).first()
    order = F.xxhash64("doc_id")
    positive = known.filter("toxic = 1").select("doc_id").distinct().orderBy(order, "doc_id").limit(max_positive)
    unlabelled = ids.distinct().orderBy(order, "doc_id").limit(max_unlabelled)
    sample = (positive.withColumn("positive", F.lit(True))
              .unionByName(unlabelled.withColumn("positive", F.lit(False))))
    prior = (toxic or 0) / n if n else 0.0
    # one doc_id may have many rows: equal ones are one, and the limits hold
    # for what is left
    texts = stored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_key"))
                   .join(F.broadcast(sample), "doc_id")         # bounded by the two limits
                   .select("positive", "doc_id", "text_key", "text")
                   .mapInArrow(_features, "positive boolean, doc_id long, text_key long, words array<int>")
                   .dropDuplicates(["positive", "doc_id", "text_key"]), "sample")
    kinds = [texts.filter(kind).orderBy(order, "doc_id", "text_key").limit(most).select("positive", "words")
             for kind, most in (("positive", max_positive), ("not positive", max_unlabelled))]
    fitted = (kinds[0].unionByName(kinds[1])
              .groupBy(F.lit(0).alias("all")).applyInArrow(_fitted(prior), "weights binary, bias double").first())
    if fitted is None:
        none = np.zeros(0, dtype=np.int32)
        return fit(none, none, none.astype(bool), prior)
    return Model(np.frombuffer(fitted["weights"], dtype=np.float32), fitted["bias"])


def toxicity(spark, model: Model):
    """A column function: the text's probability of being toxic (null and
    empty texts: the model's bias alone)."""
    shared = spark.sparkContext.broadcast(model)

    def run(texts: pa.Array) -> pa.Array:
        m = shared.value
        return pa.array(_sigmoid(np.array([m.weights[features(t)].sum(dtype=np.float64) + m.bias
                                           for t in text_bytes(texts)], dtype=np.float64)), pa.float64())
    return F.arrow_udf(run, "double")


def score_toxicity(docs: DataFrame, labels: DataFrame, folds: int = 5) -> DataFrame:
    """(document, held_out, score, predicted) of every row of ``docs``
    (with doc_id and text; ``document`` holds all its columns).  Rows whose
    crc32 of the doc_id as text leaves 0 modulo ``folds`` are held out from
    learning; ``predicted`` is 1 from a score of 0.5.

    Only the text is scored.  Null texts score like empty ones; rows with a
    null doc_id are scored and never learnt from (held_out is false); labels
    without a row, or null, are ignored, and several labels of one doc_id
    count as toxic if any is; without labels or rows the score is the
    prior's."""
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % folds == 0, F.lit(False))
    with intermediates(docs.sparkSession):
        model = learn(docs.select("doc_id", "text"), labels, ~held_out)
    score = toxicity(docs.sparkSession, model)
    return (docs.select(F.struct("*").alias("document"), held_out.alias("held_out"))
            .select("document", "held_out", score("document.text").alias("score"))
            .withColumn("predicted", (F.col("score") >= 0.5).cast("int")))

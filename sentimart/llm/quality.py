"""Quality by a regularised quadratic discriminant.

Each text becomes a vector of transformed document statistics.  A class is
a Gaussian over them; its covariance is shrunk towards the pooled one and
that towards its diagonal (Friedman 1989).  The cluster sums moments by
fold and class, the driver gets only those sums; how far to shrink is
chosen by the cross-validated log loss over all labelled texts.  A score is
the logistic function of the difference of the two log-densities, whose
Mahalanobis distances use Cholesky factors that are cached in the model.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import intermediates, stored, text_bytes

#: a text's distinct words, word triples and lines are counted in pieces
_PIECE = 1 << 20
#: shrinkage that is tried: towards the pooled covariance, towards its diagonal
POOLED = (0.02, 0.1, 0.3, 0.6)
DIAGONAL = (0.01, 0.1, 0.3)
#: standard deviations at which a statistic is cut off
_CUT = 6.0
_LOG_ODDS = 40.0

_KINDS = ("space", "lower", "upper", "digit", "punctuation", "symbol", "other")


def _kinds() -> np.ndarray:
    kind = np.full(256, _KINDS.index("other"), dtype=np.int8)
    kind[:128] = _KINDS.index("symbol")
    for name, members in (("space", b" \t\n\v\f\r"), ("lower", bytes(range(97, 123))), ("upper", bytes(range(65, 91))),
                          ("digit", b"0123456789"), ("punctuation", b".,;:!?'\"()-")):
        kind[list(members)] = _KINDS.index(name)
    return kind


_KIND = _kinds()
_OF_KIND = (_KIND[:, None] == np.arange(len(_KINDS))).astype(np.int64)
STATISTICS = ("words", "word_length", "letters", "upper", "digits", "punctuation", "symbols", "exclamations", "pipes",
              "symbol_words", "letterless_words", "upper_words", "short_words", "long_words", "distinct_words",
              "top_word", "repeated_triples", "line_words", "repeated_lines", "ended_lines", "entropy", "marks")
_DIM = len(STATISTICS)


def _cut(text: bytes) -> Iterator[bytes]:
    """The text in pieces of up to 1 MB, cut after white space if there is any."""
    at = 0
    while at < len(text):
        end = at + _PIECE
        if end < len(text):
            end = max(text.rfind(b" ", at, end), text.rfind(b"\n", at, end)) + 1 or end
        yield text[at:end]
        at = end


def _counted(piece: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The piece's histogram of bytes, and counts of words, triples, lines."""
    raw = np.frombuffer(piece, dtype=np.uint8)
    seen = np.bincount(raw, minlength=256)
    kind = _KIND[raw]
    inside = np.concatenate([[False], kind != 0, [False]])
    starts = np.flatnonzero(inside[1:-1] & ~inside[:-2])
    if not len(starts):
        return seen, np.zeros(13)
    lengths = np.flatnonzero(inside[1:-1] & ~inside[2:]) + 1 - starts
    of_word = [np.add.reduceat((kind == _KINDS.index(k)).astype(np.int32), starts)
               for k in ("lower", "upper", "symbol", "other")]
    lower, upper, symbol, other = of_word
    words = piece.split()
    number: dict[bytes, int] = {}
    codes = np.array([number.setdefault(w, len(number)) for w in words], dtype=np.int64)
    triples = (codes[:-2] * len(number) + codes[1:-1]) * len(number) + codes[2:]
    lines = [x for x in (line.strip() for line in piece.split(b"\n")) if x]
    return seen, np.array([
        len(starts), (symbol > 0).sum(), (lower + upper + other == 0).sum(), ((upper > 1) & (lower + other == 0)).sum(),
        (lengths <= 3).sum(), (lengths > 12).sum(), len(number), np.bincount(codes).max(), len(triples),
        len(triples) - len(np.unique(triples)), len(lines), len(lines) - len(Counter(lines)),
        sum(x[-1] in b".!?\"'" for x in lines)], dtype=np.float64)


def statistics(text: bytes) -> np.ndarray:
    """Transformed statistics of a text: logarithms of lengths, arcsines of
    the square roots of shares; an empty text: all zero."""
    seen, n = np.zeros(256, dtype=np.int64), np.zeros(13)
    for piece in _cut(text):
        more = _counted(piece)
        seen, n = seen + more[0], n + more[1]
    words, symbol_words, letterless, capitals, short, long, distinct, top, triples, repeated, lines, same, ended = n
    if not words:
        return np.zeros(_DIM)
    kinds = dict(zip(_KINDS, seen @ _OF_KIND))
    marks = len(text) - kinds["space"]
    letters = kinds["lower"] + kinds["upper"]

    def share(part, whole):
        return float(np.arcsin(np.sqrt(min(part / whole, 1.0)))) if whole else 0.0
    used = seen[seen > 0] / len(text)
    ends = seen[list(b".!?")].sum()
    return np.array([
        np.log1p(words), np.log1p(marks / words), share(letters + kinds["other"], marks), share(kinds["upper"], letters),
        share(kinds["digit"], marks), share(kinds["punctuation"], marks), share(kinds["symbol"], marks),
        share(seen[ord("!")], marks), share(seen[ord("|")], marks), share(symbol_words, words), share(letterless, words),
        share(capitals, words), share(short, words), share(long, words), share(distinct, words), share(top, words),
        share(repeated, triples), np.log1p(words / max(lines, 1)), share(same, lines), share(ended, lines),
        -(used * np.log2(used)).sum(), np.log1p(words / (1 + ends))])


@dataclass(frozen=True)
class Model:
    """Standardisation, and for both classes the mean, the inverse of the
    covariance's Cholesky factor, and log prior less half its log determinant."""
    centre: np.ndarray
    scale: np.ndarray
    means: np.ndarray
    factors: np.ndarray
    offsets: np.ndarray

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        """How much more likely class 1 is than class 0, for rows of
        statistics."""
        z = np.clip((x - self.centre) / self.scale, -_CUT, _CUT)
        density = []
        for k in (0, 1):
            mapped = (z - self.means[k]) @ self.factors[k].T
            density.append(self.offsets[k] - 0.5 * (mapped ** 2).sum(axis=1))
        return density[1] - density[0]


def _standard(n: np.ndarray, first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    centre = first.sum(axis=0) / n.sum()
    variance = np.diagonal(second.sum(axis=0)) / n.sum() - centre ** 2
    return centre, np.sqrt(np.maximum(variance, 1e-6))


def fit(n: np.ndarray, first: np.ndarray, second: np.ndarray, centre: np.ndarray, scale: np.ndarray,
        pooled: float, diagonal: float) -> Model:
    """A model from the classes' moments of standardised and cut-off
    statistics: counts (2), sums (2, d), sums of products (2, d, d)."""
    means = first / np.maximum(n, 1)[:, None]
    scatter = second - n[:, None, None] * means[:, :, None] * means[:, None, :]
    common = scatter.sum(axis=0) / max(n.sum(), 1)
    factors, offsets = [], []
    for k in (0, 1):
        own = scatter[k] / max(n[k], 1)
        mixed = (1 - pooled) * own + pooled * common
        mixed = (1 - diagonal) * mixed + diagonal * np.diag(np.diagonal(mixed)) + 1e-4 * np.eye(len(mixed))
        lower = np.linalg.cholesky(mixed)
        factors.append(np.linalg.inv(lower))
        offsets.append(np.log((n[k] + 1) / (n.sum() + 2)) - np.log(np.diagonal(lower)).sum())
    return Model(centre, scale, means, np.array(factors), np.array(offsets))


def _vectors(batches):
    """Statistics of texts in place of the texts."""
    for batch in batches:
        x = [statistics(t).tolist() for t in text_bytes(batch.column("text"))]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("text_key"), pa.array(x, pa.list_(pa.float64()))],
            names=["doc_id", "text_key", "x"])


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy().reshape(-1, _DIM)


def _moments(standard):
    """A task's sums by fold and class: rows (fold, class, cell, total), the
    cells being the count, the sums and the sums of products."""
    def run(batches):
        held: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            x, fold, label = _matrix(batch.column("x")), *(batch.column(c).to_numpy() for c in ("fold", "label"))
            if standard is not None:
                x = np.clip((x - standard[0]) / standard[1], -_CUT, _CUT)
            for key in {*zip(fold.tolist(), label.tolist())}:
                rows = x[(fold == key[0]) & (label == key[1])]
                sums = np.concatenate([[len(rows)], rows.sum(axis=0), (rows.T @ rows).ravel()])
                held[key] = held.get(key, 0) + sums
        for (fold, label), sums in held.items():
            m = len(sums)
            yield pa.RecordBatch.from_pydict({
                "fold": pa.array(np.full(m, fold), pa.int32()), "label": pa.array(np.full(m, label), pa.int32()),
                "cell": pa.array(np.arange(m), pa.int32()), "total": pa.array(sums, pa.float64())})
    return run


def _summed(rows: DataFrame, folds: int, standard=None):
    """Counts (folds, 2), sums and sums of products over the cluster; what
    the driver gets is fixed in size."""
    out = np.zeros((folds, 2, 1 + _DIM + _DIM * _DIM))
    cells = (rows.select("fold", "label", "x")
             .mapInArrow(_moments(standard), "fold int, label int, cell int, total double")
             .groupBy("fold", "label", "cell").agg(F.sum("total").alias("total")))
    for r in cells.collect():
        out[r["fold"], r["label"], r["cell"]] = r["total"]
    return out[..., 0], out[..., 1:1 + _DIM], out[..., 1 + _DIM:].reshape(folds, 2, _DIM, _DIM)


def _losses(models: dict[int, list[Model]]):
    """Log loss of every candidate model of a row's fold, summed by task."""
    def run(batches):
        total = None
        for batch in batches:
            x, fold, label = _matrix(batch.column("x")), *(batch.column(c).to_numpy() for c in ("fold", "label"))
            for f in set(fold.tolist()):
                at = fold == f
                sign = np.where(label[at] == 1, 1.0, -1.0)
                loss = np.array([np.logaddexp(0, -sign * np.clip(m.log_odds(x[at]), -_LOG_ODDS, _LOG_ODDS)).sum()
                                 for m in models[f]])
                total = loss if total is None else total + loss
        if total is not None:
            yield pa.RecordBatch.from_pydict({"candidate": pa.array(range(len(total)), pa.int32()),
                                              "loss": pa.array(total, pa.float64())})
    return run


def learn(docs: DataFrame, labels: DataFrame, folds: int = 5) -> Model | None:
    """Fit on every labelled row of ``docs`` (doc_id, text) whose crc32 of
    the doc_id as text is not 0 modulo ``folds``; the other folds serve to
    choose the shrinkage.  None where a class has no row."""
    fold = (F.crc32(F.col("doc_id").cast("string")) % folds).cast("int")
    marks = labels.filter("quality is not null").groupBy("doc_id").agg((F.min("quality") > 0).cast("int").alias("label"))
    keyed = (docs.filter(F.col("doc_id").isNotNull() & (fold != 0))
             .select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), "text"))
    rows = stored(keyed.mapInArrow(_vectors, "doc_id long, text_key long, x array<double>")
                  .join(marks, "doc_id").dropDuplicates(["doc_id", "text_key"])
                  .select(fold.alias("fold"), "label", "x"), "statistics")
    n, first, second = (a.sum(axis=0) for a in _summed(rows, folds))
    if not n.all():
        return None
    standard = _standard(n, first, second)
    n, first, second = _summed(rows, folds, standard)
    choices = [(p, d) for p in POOLED for d in DIAGONAL]

    def fitted(keep: list[int]) -> list[Model]:
        moments = [a[keep].sum(axis=0) for a in (n, first, second)]
        return [fit(*moments, *standard, p, d) for p, d in choices]
    every = list(range(folds))
    models = {f: fitted([g for g in every if g != f]) for f in every[1:]}
    losses = (rows.mapInArrow(_losses(models), "candidate int, loss double")
              .groupBy("candidate").agg(F.sum("loss").alias("loss")).collect())
    best = min(losses, key=lambda r: (round(r["loss"], 6), r["candidate"]))["candidate"]
    return fitted(every)[best]


def quality(spark, model: Model | None):
    """A column function: the probability that a text is of class 1."""
    shared = spark.sparkContext.broadcast(model)      # a few matrices

    def run(texts: pa.Array) -> pa.Array:
        m = shared.value
        if m is None:
            return pa.array(np.full(len(texts), 0.5), pa.float64())
        x = np.array([statistics(t) for t in text_bytes(texts)]).reshape(-1, _DIM)
        return pa.array(1 / (1 + np.exp(-np.clip(m.log_odds(x), -_LOG_ODDS, _LOG_ODDS))), pa.float64())
    return F.arrow_udf(run, "double")


def score_quality(docs: DataFrame, labels: DataFrame, folds: int = 5, threshold: float = 0.3) -> DataFrame:
    """(document, held_out, score, predicted) of every row of ``docs``
    (with doc_id and text; ``document`` holds all its columns): the
    probability of ``labels.quality`` = 1 as far as the text tells, and 1
    where it reaches ``threshold``.  Rows whose crc32 of the doc_id as text
    leaves 0 modulo ``folds`` are held out from learning.

    Only the text is scored, all of it.  Null texts score like empty ones;
    rows with a null doc_id are scored and never learnt from (held_out is
    false); rows that repeat doc_id and text are learnt from once, different
    texts under one doc_id each; labels without a row, or null, are ignored,
    and of several labels of a doc_id the smallest counts.  Without rows of
    both classes every score is 0.5; an empty table gives an empty result."""
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % folds == 0, F.lit(False))
    with intermediates(docs.sparkSession):
        model = learn(docs.select("doc_id", "text"), labels, folds)
    score = quality(docs.sparkSession, model)
    return (docs.select(F.struct("*").alias("document"), held_out.alias("held_out"))
            .select("document", "held_out", score("document.text").alias("score"))
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))

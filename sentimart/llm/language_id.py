"""Language identification with segmentation-marginalised unigrams.

Each language gives every piece of a fixed public vocabulary a
probability.  A word's probability is the sum over all its segmentations
into pieces, by the forward algorithm; the pieces' probabilities are
learnt by expectation-maximisation with the same sums (forward-backward),
over all texts that may be learnt from.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_pieces, sliced
from .windows import _powers, mix

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
UNKNOWN = "und"
#: values of lang that may be learnt
MAX_LANGUAGES = 400
_START = "▁"        # the vocabulary's mark of a word's start
_LONGEST_WORD = 24       # longer words are swept with scaled sums
_FLOOR = 1e-7            # probability of a single letter that is no piece
_SMOOTHING = 0.1
_TEXT = 4 << 20          # characters of text handled at once
_WORDS = 1 << 15         # words in one forward sweep
_CELLS = 1 << 17         # letters of long words handled at once
_GATHER = 400_000        # distinct words a task gathers or remembers
_GROUPS = (*range(2, 17), 20, _LONGEST_WORD + 1)     # longest words of the sweeps
_LETTERS = re.compile(r"[^\W\d_]+")


class Pieces:
    """The vocabulary's letter pieces in a hash table that numpy can probe."""

    def __init__(self, pieces: list[str]):
        self.pieces = pieces
        self.longest = max(map(len, pieces), default=1)
        n = len(pieces)
        self._mask = np.uint64((1 << max(4, (4 * n).bit_length())) - 1)
        self._keys = np.zeros(int(self._mask) + 1, dtype=np.uint64)
        self._ids = np.full(int(self._mask) + 1, -1, dtype=np.int32)
        for number, key in enumerate(_hash_all(pieces).tolist()):
            slot = key & int(self._mask)
            while self._ids[slot] >= 0:
                slot = (slot + 1) & int(self._mask)
            self._keys[slot], self._ids[slot] = key, number

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Numbers of the pieces with these hashes, -1 where there is none."""
        slots = (keys & self._mask).astype(np.int64)
        out = self._ids[slots]
        left = np.flatnonzero((out >= 0) & (self._keys[slots] != keys))
        while len(left):
            slots[left] = (slots[left] + 1) & int(self._mask)
            out[left] = self._ids[slots[left]]
            left = left[(out[left] >= 0) & (self._keys[slots[left]] != keys[left])]
        return out


def _symbols(words: list[str], width: int) -> np.ndarray:
    """Words as rows of hashed code points (0 beyond their ends)."""
    raw = "".join(w.ljust(width, "\0") for w in words).encode("utf-32-le", "surrogatepass")
    codes = np.frombuffer(raw, dtype="<u4").reshape(len(words), width)
    return np.where(codes > 0, mix(codes.astype(np.uint64) + np.uint64(1)), np.uint64(0))


def _sums(symbols: np.ndarray) -> np.ndarray:
    up, _ = _powers(symbols.shape[1] + 1)
    out = np.zeros((symbols.shape[0], symbols.shape[1] + 1), dtype=np.uint64)
    np.cumsum(symbols * up[:symbols.shape[1]], axis=1, out=out[:, 1:])
    return out


def _slice_hash(sums: np.ndarray, i: int, j: int) -> np.ndarray:
    _, down = _powers(sums.shape[1])
    return mix((sums[:, j] - sums[:, i]) * down[i] + np.uint64(j - i))


def _hash_all(words: list[str]) -> np.ndarray:
    out = np.zeros(len(words), dtype=np.uint64)
    for size in sorted({len(w) for w in words}):
        at = [i for i, w in enumerate(words) if len(w) == size]
        out[at] = _slice_hash(_sums(_symbols([words[i] for i in at], size)), 0, size)
    return out


def load_pieces(path: str = VOCABULARY) -> Pieces:
    """Pieces of a public sentencepiece vocabulary that are letters, with or
    without the mark of a word's start."""
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    names = {model.id_to_piece(i) for i in range(model.get_piece_size())}
    return Pieces(sorted(p for p in names if p.removeprefix(_START).isalpha()))


@dataclass(frozen=True)
class Model:
    languages: list[str]
    shares: np.ndarray           # of the learnt documents
    probabilities: np.ndarray    # pieces x languages


def _batches(words: list[str]):
    """Numbers of words of similar length, few at a time; words of more
    than ``_LONGEST_WORD`` letters are left to ``_long_batches``."""
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    least = 0
    for most in _GROUPS:
        of = np.flatnonzero((sizes > least) & (sizes <= most))
        for at in range(0, len(of), _WORDS):
            yield of[at:at + _WORDS], sizes[of[at:at + _WORDS]]
        least = most


def _long_batches(words: list[str]):
    """Numbers of the longer words, by length, about ``_CELLS`` letters (or
    one word) at a time; the longest of a batch is last and at most a
    quarter longer than the first."""
    sizes = {i: len(w) for i, w in enumerate(words) if len(w) > _GROUPS[-1]}
    batch: list[int] = []
    for i in sorted(sizes, key=sizes.get):
        if batch and (4 * sizes[i] > 5 * sizes[batch[0]] or sizes[i] * (len(batch) + 1) > _CELLS):
            yield batch
            batch = []
        batch.append(i)
    if batch:
        yield batch


class _Lattice:
    """All pieces inside a batch of words, and the forward sums over them."""

    def __init__(self, pieces: Pieces, probabilities: np.ndarray, words: list[str], sizes: np.ndarray):
        self.width, self.sizes, self._longest = int(sizes.max()), sizes, pieces.longest
        sums = _sums(_symbols(words, self.width))
        self._probabilities = probabilities
        self.found = {}      # by (from, to): the words with a piece there, its numbers
        for j in range(1, self.width + 1):
            for i in range(max(0, j - pieces.longest), j):
                ids = pieces.find(_slice_hash(sums, i, j))
                at = np.flatnonzero(ids >= 0)
                if len(at):
                    self.found[i, j] = at, ids[at]
        self.forward = np.zeros((self.width + 1, len(words), probabilities.shape[1]))
        self.forward[0] = 1
        for j in range(1, self.width + 1):
            here = self.forward[j]
            for i in range(max(0, j - pieces.longest), j):
                if (i, j) in self.found:
                    at, ids = self.found[i, j]
                    here[at] += self.forward[i][at] * probabilities[ids]
            lone = self._lone(j)
            here[lone] += self.forward[j - 1][lone] * _FLOOR
        self.total = self.forward[sizes, np.arange(len(words))]

    def _lone(self, j: int) -> np.ndarray:
        """Words whose letter before ``j`` is no piece."""
        alone = np.ones(len(self.sizes), dtype=bool)
        if (j - 1, j) in self.found:
            alone[self.found[j - 1, j][0]] = False
        return np.flatnonzero(alone)

    def expected(self, counts: np.ndarray) -> np.ndarray:
        """Expected uses of each piece by language, for words that occur
        ``counts`` (words x languages) times."""
        backward = np.zeros_like(self.forward)
        backward[self.sizes, np.arange(len(self.sizes))] = 1
        out = np.zeros_like(self._probabilities)
        scale = counts / self.total
        for i in range(self.width - 1, -1, -1):
            here, uses_here = backward[i], self.forward[i] * scale
            for j in range(i + 1, min(self.width, i + self._longest) + 1):
                if (i, j) in self.found:
                    at, ids = self.found[i, j]
                    through = self._probabilities[ids] * backward[j][at]
                    here[at] += through
                    uses = uses_here[at] * through
                    for language in range(uses.shape[1]):
                        out[:, language] += np.bincount(ids, uses[:, language], len(out))
            lone = self._lone(i + 1)
            here[lone] += backward[i + 1][lone] * _FLOOR
        return out


class _Sweep:
    """The sums of ``_Lattice`` over words of any length.

    Only ratios of neighbouring forward sums are kept, so nothing
    underflows: a piece's weight is the share of the sum at its end that
    comes through it.  Words are taken ``_CELLS`` letters at a time; the
    way back computes a stretch's weights again from the ratios kept at
    its start."""

    def __init__(self, pieces: Pieces, probabilities: np.ndarray, words: list[str]):
        self._pieces, self._words = pieces, words
        # the last row is that of a letter that is no piece
        self._probabilities = np.vstack((probabilities, np.full(probabilities.shape[1], _FLOOR)))
        self.sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        self._step = max(1, _CELLS // len(words))
        # sums at the last places, as multiples of the latest one
        last = np.zeros((pieces.longest, len(words), probabilities.shape[1]))
        last[0] = 1
        self.log_total = np.zeros(last.shape[1:])
        self._kept = []
        for start in range(0, int(self.sizes.max()), self._step):
            self._kept.append(last.copy())
            self._stretch(start, last, self.log_total)

    def _found(self, start: int, end: int):
        """All pieces that end in (start, end], by end and word: ends (from
        0), words, lengths and numbers."""
        before = max(0, start - self._pieces.longest + 1)
        sums = _sums(_symbols([w[before:end] for w in self._words], end - before))
        down = _powers(sums.shape[1])[1]
        found = []
        for size in range(1, min(self._pieces.longest, end - before) + 1):
            first = max(0, start + 1 - size - before)        # the earliest beginning
            raw = (sums[:, first + size:] - sums[:, first:-size]) * down[first:sums.shape[1] - size]
            ids = self._pieces.find(mix(raw + np.uint64(size)).ravel()).reshape(raw.shape)
            if size == 1:
                ids[ids < 0] = len(self._probabilities) - 1
            word, at = np.nonzero(ids >= 0)
            found.append((at + (before + first + size - 1 - start), word, np.full(len(at), size), ids[word, at]))
        ends, word, size, ids = (np.concatenate(c) for c in zip(*found))
        order = np.lexsort((word, ends))
        return ends[order], word[order], size[order], ids[order]

    def _stretch(self, start: int, last: np.ndarray, logs: np.ndarray | None = None):
        """Pieces that end in the stretch from ``start`` and their weights;
        ``last`` and ``logs`` are carried on."""
        end = min(int(self.sizes.max()), start + self._step)
        ends, word, size, ids = self._found(start, end)
        edges = np.searchsorted(ends, np.arange(end - start + 1))
        weights = np.empty((len(ids), last.shape[2]))
        for j, (a, b) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist())):
            of = word[a:b]
            through = self._probabilities[ids[a:b]] * last[size[a:b] - 1, of]
            # every word has an entry at every place: its single letter
            ratio = np.add.reduceat(through, np.flatnonzero(np.diff(of, prepend=-1)), axis=0)
            weights[a:b] = through / ratio[of]
            last[1:] = last[:-1] / ratio
            last[0] = 1
            if logs is not None:
                logs += np.where((start + j < self.sizes)[:, None], np.log(ratio), 0.0)
        return edges, word, size, ids, weights

    def expected(self, counts: np.ndarray) -> np.ndarray:
        """As ``_Lattice.expected``."""
        out = np.zeros_like(self._probabilities)
        # uses of the pieces that begin at a place, for it and those before it
        ahead = np.zeros((self._pieces.longest + 1, *counts.shape))
        for number in range(len(self._kept) - 1, -1, -1):
            start = number * self._step
            edges, word, size, ids, weights = self._stretch(start, self._kept[number].copy())
            for j in range(len(edges) - 2, -1, -1):
                a, b = edges[j], edges[j + 1]
                ending = self.sizes == start + j + 1
                ahead[0][ending] = counts[ending]
                weights[a:b] *= ahead[0][word[a:b]]
                ahead[size[a:b], word[a:b]] += weights[a:b]
                ahead[:-1] = ahead[1:]
                ahead[-1] = 0
            for language in range(out.shape[1]):
                out[:, language] += np.bincount(ids, weights[:, language], len(out))
        return out[:-1]


def _expectations(shared_pieces, shared_model):
    schema = pa.schema([("piece", pa.int32()), ("language", pa.int32()), ("uses", pa.float64())])

    def run(batches):
        pieces, model = shared_pieces.value, shared_model.value
        number = {name: i for i, name in enumerate(model.languages)}
        total = np.zeros_like(model.probabilities)
        seen = [Counter() for _ in number]       # words by language

        def settle():
            row: dict[str, int] = {}
            for counter in seen:
                for word in counter:
                    row.setdefault(_START + word, len(row))
            counts = np.zeros((len(row), len(number)))
            for language, counter in enumerate(seen):
                for word, n in counter.items():
                    counts[row[_START + word], language] += n
                counter.clear()
            words = list(row)
            for of, sizes in _batches(words):
                lattice = _Lattice(pieces, model.probabilities, [words[i] for i in of.tolist()], sizes)
                total[:] += lattice.expected(counts[of])
            for of in _long_batches(words):
                total[:] += _Sweep(pieces, model.probabilities, [words[i] for i in of]).expected(counts[of])

        for batch in sliced(batches):
            for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist()):
                seen[number[lang]].update(_LETTERS.findall(text.lower()))
            if sum(map(len, seen)) >= _GATHER:
                settle()
        if any(seen):
            settle()
        piece, language = np.nonzero(total)
        for at in range(0, len(piece), 1 << 16):
            p, q = piece[at:at + (1 << 16)], language[at:at + (1 << 16)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(p.astype(np.int32)), pa.array(q.astype(np.int32)), pa.array(total[p, q])], schema=schema)
    return run


def learn(docs: DataFrame, pieces: Pieces, iterations: int = 2) -> Model:
    """Piece probabilities from all rows of ``docs`` (text, lang; both not
    null).  The model's size is the vocabulary's times the number of
    languages (at most ``MAX_LANGUAGES``, else an error); texts are read ``iterations`` times and never moved."""
    spark = docs.sparkSession
    docs = docs.filter("text is not null and lang is not null").select("text", "lang")
    found = sorted((r[0], r[1]) for r in docs.groupBy("lang").count().limit(MAX_LANGUAGES + 1).collect())
    if len(found) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} different values of lang: the model would not fit a task")
    languages = [name for name, _ in found]
    shares = np.array([n for _, n in found], dtype=np.float64)
    n = len(pieces.pieces)
    model = Model(languages, shares / max(1.0, shares.sum()), np.full((n, len(languages)), 1.0 / max(1, n)))
    shared = spark.sparkContext.broadcast(pieces)
    for _ in range(iterations if languages else 0):
        uses = (docs.mapInArrow(_expectations(shared, spark.sparkContext.broadcast(model)),
                                "piece int, language int, uses double")
                .groupBy("piece", "language").agg(F.sum("uses").alias("uses")).toArrow())
        counts = np.full((n, len(languages)), _SMOOTHING)
        counts[uses.column("piece").to_numpy(), uses.column("language").to_numpy()] += uses.column("uses").to_numpy()
        model = Model(languages, model.shares, counts / counts.sum(axis=0))
    return model


def _log_likelihoods(pieces: Pieces, model: Model, words: list[str]) -> np.ndarray:
    """Logarithm of each word's probability by language."""
    words = [_START + w for w in words]
    logs = np.zeros((len(words), len(model.languages)))
    for of, sizes in _batches(words):
        lattice = _Lattice(pieces, model.probabilities, [words[i] for i in of.tolist()], sizes)
        logs[of] = np.log(np.maximum(lattice.total, 1e-300))
    for of in _long_batches(words):
        logs[of] = _Sweep(pieces, model.probabilities, [words[i] for i in of]).log_total
    return logs


def language(spark, pieces: Pieces, model: Model):
    """A column function: struct<lang_pred, score> of a text."""
    shared_pieces, shared_model = spark.sparkContext.broadcast(pieces), spark.sparkContext.broadcast(model)

    def run(iterator: Iterator[pa.Array]) -> Iterator[pa.Array]:
        pieces, model = shared_pieces.value, shared_model.value
        known: dict[str, int] = {}               # words to rows of scores
        scores = np.zeros((_GATHER, len(model.languages)))
        prior = np.log(np.maximum(model.shares, 1e-12))
        for texts in iterator:
            names, sure = [], []
            for piece in in_pieces((t or "" for t in texts.to_pylist()), len, _TEXT):
                counted = [Counter(_LETTERS.findall(t.lower())) for t in piece]
                fresh = list(set().union(*counted) - known.keys())
                if len(known) + len(fresh) > len(scores):
                    known.clear()
                    fresh = list(set().union(*counted))
                    scores = np.zeros((max(_GATHER, len(fresh)), len(model.languages)))
                scores[len(known):len(known) + len(fresh)] = _log_likelihoods(pieces, model, fresh)
                known.update(zip(fresh, range(len(known), len(known) + len(fresh))))
                for words in counted:
                    if not model.languages or not any(letter.isalpha() for w in words for letter in w):
                        names.append(UNKNOWN)
                        sure.append(0.0)
                        continue
                    rows = np.fromiter(map(known.__getitem__, words), dtype=np.int64, count=len(words))
                    z = np.fromiter(words.values(), dtype=np.float64, count=len(words)) @ scores[rows] + prior
                    best = int(np.argmax(z))
                    names.append(model.languages[best])
                    sure.append(float(1 / np.exp(z - z[best]).sum()))
            yield pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(sure, pa.float64())],
                                             names=["lang_pred", "score"])
    return F.arrow_udf(run, "lang_pred string, score double")


def identify_language(docs: DataFrame, folds: int = 4, held: int = 2, vocabulary: str = VOCABULARY,
                      iterations: int = 2) -> DataFrame:
    """(document, held_out, lang_pred, score) of every row of ``docs``
    (doc_id, text, lang; ``document`` holds all its columns).  Rows whose
    crc32 of the doc_id as text is ``held`` modulo ``folds`` are held out
    from learning.  ``score`` is the predicted language's posterior
    probability, with the learnt documents' shares as the prior; null texts
    and texts without a letter get ``und`` and 0, as does any text if
    nothing can be learnt.

    Words are lower-cased runs of letters; digits and signs do not count.
    Rows with a null doc_id are predicted and not learnt from (held_out is
    false); rows with a null lang are only predicted; repeated rows count
    as often as they occur."""
    spark = docs.sparkSession
    fold = F.crc32(F.col("doc_id").cast("string")) % folds
    pieces = load_pieces(vocabulary)
    model = learn(docs.filter(fold != held), pieces, iterations)
    found = language(spark, pieces, model)("document.text")
    return (docs.select(F.struct("*").alias("document"), F.coalesce(fold == held, F.lit(False)).alias("held_out"))
            .select("document", "held_out", found.alias("found")).select("document", "held_out", "found.*"))

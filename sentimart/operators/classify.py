"""Comment classification (U1-U5) as one ``mapInArrow`` stage.

Each task walks its partition in slices of ``batch_size`` comments, calls
the classifier once per slice, validates the answer (one parseable line
per comment), retries with exponential back-off, and falls back to the
sentinel for the whole slice.  No shuffle: slices are cut from the rows a
task already holds, carrying a short remainder across Arrow batches, so
slice boundaries depend only on the partition's contents.

The classifier is a caller-supplied ``texts -> response text`` callable
(a model client in production).  A list of callables is spread over
partitions by ``partition_id % len`` (U4, e.g. one API key per client).
The shipped :func:`rule_based_classifier` is a deterministic stand-in
that SQL can reproduce.
"""

from __future__ import annotations

import math
import time
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ..functions.text import split_pair
from ..schemas import BATCH_SIZE, EMOTIONS, MAX_ATTEMPTS, SENTINEL

Classifier = Callable[[list[str]], str]

#: reasons of a sentinel besides the failure of a whole call
NO_TEXT = "no text"
NO_LABEL = "no label in its line"

# --- fixed values of the stand-in classifier (our own rule set) ---
# Ordered keyword rules: the first keyword found (case-sensitive substring)
# decides the emotion; no keyword -> neutral.
LEXICON: list[tuple[str, str]] = [
    ("hate", "anger"), ("sad", "sadness"), ("great", "admiration"),
    ("love", "love"), ("thank", "gratitude"), ("Thank", "gratitude"),
    ("!", "excitement"), ("?", "curiosity"),
]
# Sentiment of each emotion the stand-in can emit.
SENTIMENT_OF: dict[str, str] = {
    "anger": "negative", "sadness": "negative", "admiration": "positive",
    "love": "positive", "gratitude": "positive", "excitement": "positive",
    "curiosity": "neutral", "neutral": "neutral",
}
# --- end of fixed values ---


def rule_label(text: str) -> str:
    for kw, emotion in LEXICON:
        if kw in text:
            return f"{emotion}, {SENTIMENT_OF[emotion]}"
    return "neutral, neutral"


def rule_based_classifier(texts: list[str]) -> str:
    """Deterministic stand-in: ``Comment i: <emotion>, <sentiment>``."""
    return "\n".join(f"Comment {i}: {rule_label(t)}" for i, t in enumerate(texts, 1))


# --- further stand-ins used by tests and the registered queries ---

def picky_classifier(texts: list[str]) -> str:
    """Rule-based answers, but no parseable line for ``NO ...`` comments:
    those fail the first pass and succeed on retry."""
    return "\n".join(f"Comment {i} ?" if t.startswith("NO") else f"Comment {i}: {rule_label(t)}"
                     for i, t in enumerate(texts, 1))


def shy_classifier(texts: list[str]) -> str:
    """Like the picky one, but only ``NO ...`` comments that shout have no
    answer."""
    return "\n".join(f"Comment {i} ?" if t.startswith("NO") and "!" in t else f"Comment {i}: {rule_label(t)}"
                     for i, t in enumerate(texts, 1))


def flaky_classifier():
    """A client that fails the first call of every slice (transient error,
    retried) and answers a line without ``:`` for texts containing ``@``
    (that comment alone fails)."""
    seen: set[int] = set()

    def call(texts: list[str]) -> str:
        key = hash(tuple(texts))
        if key not in seen:
            seen.add(key)
            raise ConnectionError("transient")
        return "\n".join(f"Comment {i} unreadable" if "@" in t else f"Comment {i}: {rule_label(t)}"
                         for i, t in enumerate(texts, 1))
    return call


def build_prompt(texts: Sequence[str]) -> str:
    """Prompt for a model client: one ``Comment i: text`` line per comment,
    the emotions to choose from and the answer format (one ``Comment i:
    emotion, sentiment`` line each)."""
    body = "\n".join(f"Comment {i}: {t}" for i, t in enumerate(texts, 1))
    return (f"Classify the emotion and sentiment of each of these {len(texts)} comments.\n"
            f"{body}\n\nAnswer with exactly one line per comment, in order:\n"
            "Comment <n>: <emotion>, <positive|negative|neutral>\n"
            f"with exactly one emotion out of: {', '.join(EMOTIONS)}.")


def parse_response(response: str, n: int, check_numbers: bool = False) -> list[str]:
    """X15 + X16 for one call: labels per line (text after the first
    ``:``, stripped; a line without ``:`` is the sentinel).  Raises
    ``ValueError`` unless there is exactly one line per comment.

    Alignment is positional, as in the original job (N13).  With
    ``check_numbers`` a line whose text before the ``:`` is not
    ``Comment <its position>`` also fails the call (and is retried)."""
    lines = response.strip().split("\n")
    if len(lines) != n:
        raise ValueError(f"{len(lines)} lines for {n} comments")
    labels = []
    for i, ln in enumerate(lines, 1):
        if ":" not in ln:
            labels.append(SENTINEL)
            continue
        head, label = ln.split(":", 1)
        if check_numbers and head.strip() != f"Comment {i}":
            raise ValueError(f"line {i} is labelled {head.strip()!r}")
        labels.append(label.strip())
    return labels


def classify_slice(texts: list[str], classifier: Classifier,
                   max_attempts: int = MAX_ATTEMPTS,
                   sleep: Callable[[float], None] = time.sleep,
                   check_numbers: bool = False, reasons: list[str] | None = None) -> list[str]:
    """Up to ``max_attempts`` calls, sleeping ``2**k`` s after the k-th
    failure; the sentinel for every comment when all attempts fail.  What
    failed last is added to ``reasons``, if given."""
    for attempt in range(1, max_attempts + 1):
        try:
            return parse_response(str(classifier(texts)), len(texts), check_numbers)
        except Exception as e:  # noqa: BLE001 - any client or parse failure retries
            if attempt < max_attempts:
                sleep(2 ** attempt)
            elif reasons is not None:
                reasons.append(f"{type(e).__name__}: {e}")
    return [SENTINEL] * len(texts)


def _pick(classifier: Classifier | Sequence[Classifier]) -> Classifier:
    if callable(classifier):
        return classifier
    ctx = TaskContext.get()
    pid = ctx.partitionId() if ctx is not None else 0
    return classifier[pid % len(classifier)]


def label_partitions(df: DataFrame, text_col: str,
                     classifier: Classifier | Sequence[Classifier] = rule_based_classifier,
                     batch_size: int = BATCH_SIZE, max_attempts: int = MAX_ATTEMPTS,
                     sleep: Callable[[float], None] = time.sleep, pause: float = 0.0,
                     label_col: str = "label", concurrency: int = 1,
                     check_numbers: bool = False, reason_col: str | None = None) -> DataFrame:
    """Add ``label_col`` (``"emotion, sentiment"`` or the sentinel).

    Runs as ``mapInArrow``: record batches pass through untouched (no
    pandas conversion, so nullable BIGINTs stay exact) and only the text
    column is read in Python.  A NULL text never reaches the classifier:
    it gets the sentinel.  ``pause`` seconds are slept after each call (U5
    rate limit).  ``concurrency`` > 1 keeps that many calls in flight per
    task (model calls wait on the network, not the CPU); labels keep input
    order and the classifier must then be thread-safe.  ``reason_col`` adds
    why a comment has the sentinel (NULL where it has a label)."""
    added = [label_col] + ([reason_col] if reason_col else [])
    schema = T.StructType(df.schema.fields + [T.StructField(c, T.StringType(), True) for c in added])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        clf = _pick(classifier)

        def one(sl: list[str]) -> list[tuple[str, str | None]]:
            why: list[str] = []
            res = classify_slice(sl, clf, max_attempts, sleep, check_numbers, why)
            if pause:
                sleep(pause)
            why = why or [NO_LABEL]
            return [(x, why[0] if x == SENTINEL else None) for x in res]

        def label(rb: pa.RecordBatch, texts: list) -> pa.RecordBatch:
            idx = [i for i, t in enumerate(texts) if t is not None]
            vals = [texts[i] for i in idx]
            slices = [vals[i:i + batch_size] for i in range(0, len(vals), batch_size)]
            if concurrency > 1 and len(slices) > 1:
                with ThreadPoolExecutor(max_workers=concurrency) as pool:
                    parts = list(pool.map(one, slices))
            else:
                parts = [one(sl) for sl in slices]
            labels: list[tuple[str, str | None]] = [(SENTINEL, NO_TEXT)] * len(texts)
            for i, lab in zip(idx, (x for part in parts for x in part)):
                labels[i] = lab
            for k, name in enumerate(added):
                rb = rb.append_column(name, pa.array([x[k] for x in labels], pa.string()))
            return rb

        carry: pa.RecordBatch | None = None
        for rb in batches:
            has_text = pc.is_valid(rb.column(text_col))
            no_text = rb.filter(pc.invert(has_text))
            if no_text.num_rows:  # never sent to the classifier, never held back
                yield label(no_text, [None] * no_text.num_rows)
            rb = rb.filter(has_text)
            if carry is not None and carry.num_rows:
                rb = pa.concat_batches([carry, rb])
            full = (rb.num_rows // batch_size) * batch_size
            if full:
                head = rb.slice(0, full)
                yield label(head, head.column(text_col).to_pylist())
            # fewer than batch_size texts wait for the next Arrow batch
            carry = rb.slice(full)
        if carry is not None and carry.num_rows:
            yield label(carry, carry.column(text_col).to_pylist())

    return df.mapInArrow(run, schema)


def classify_comments(df: DataFrame, text_col: str = "textoriginal",
                      classifier: Classifier | Sequence[Classifier] = rule_based_classifier,
                      parallelism: int | None = None, rows_per_task: int | None = None,
                      **kw) -> DataFrame:
    """U1 + X5/X6: ``emotion`` and ``sentimentnature`` per comment.

    ``parallelism`` (optional) spreads rows round-robin over that many
    tasks - concurrency of model calls - without keying on any column (a
    hot key cannot pile up in one task); Spark sorts before round-robin so
    a re-run task sees the same rows.  ``rows_per_task`` derives that
    number from a row count instead (one extra counting job): with a model
    at ~1 call/s, a 128 MB file split would otherwise be hours of work for
    one task.  The Python stage runs once per row only if its output is
    consumed once: materialise it (``sinks.files.materialize``) before
    routing it two ways.
    """
    if rows_per_task and not parallelism:
        parallelism = max(1, math.ceil(df.count() / rows_per_task))
    src = df.repartition(parallelism) if parallelism else df
    labelled = label_partitions(src, text_col, classifier, **kw)
    emotion, sentiment = split_pair("label")
    return labelled.withColumns({"emotion": emotion, "sentimentnature": sentiment}).drop("label")

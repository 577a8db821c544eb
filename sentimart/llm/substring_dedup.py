"""Substring deduplication by exact repeats of word windows, found with a
count-min prefilter (see ``repeats``)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import sliced, text_bytes
from .repeats import Windows, covered, removable, repeated_parts, shared_windows, with_parts


def _kept(length: int):
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()),
                        ("kept_text", pa.large_string())])

    def run(batches):
        for batch in sliced(batches):
            out = []
            for doc, text, spans in zip(batch.column("doc_id").to_pylist(), text_bytes(batch.column("text")),
                                        removable(batch.column("parts"), length)):
                words = text.split()
                gone = 0
                n = len(words)
                if spans:
                    hit = covered(n, spans)
                    gone = int(hit.sum())
                    words = [words[i] for i in np.flatnonzero(~hit).tolist()]
                out.append((doc, n, gone, b" ".join(words).decode()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out), schema.types)] if out
                else [pa.array([], t) for t in schema.types], schema=schema)
    return run


def dedup_word_windows(docs: DataFrame, length: int = 50, k: int = 25, cells: int = 1 << 26,
                       depth: int = 2) -> DataFrame:
    """Remove each word of ``docs`` (doc_id, text; other columns are not
    read) that lies in a window of ``length`` consecutive words whose word
    sequence also starts in a document with a smaller doc_id.  Windows are
    judged on the input.

    Returns (doc_id, n_words, n_removed, kept_text): one row an input row,
    the kept words joined by one space.  Words are maximal runs without
    ASCII white space, unchanged.  Null or empty texts have no words; rows
    with a null doc_id are returned whole and take no part; rows that
    repeat a doc_id do not remove each other's words; an empty table gives
    an empty result."""
    windows = Windows(length, k, words=True, cells=cells, depth=depth)
    parts = repeated_parts(
        docs, windows,
        judge=lambda rows: shared_windows(rows.withColumnRenamed("payload", "hashes"), F.col("first.doc_id")),
        earlier=lambda: F.col("first.doc_id") < F.col("doc_id"))
    return with_parts(docs, parts).mapInArrow(
        _kept(length), "doc_id long, n_words long, n_removed long, kept_text string")

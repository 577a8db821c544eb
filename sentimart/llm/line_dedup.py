"""Line deduplication by a deletion-neighbourhood join (edit bound 1).

Two lines within one edit share a string: deleting the substituted
character from both gives the same variant, deleting the inserted one
gives the other line itself.  So every line emits hashes of itself and of
all its one-character deletions, equal hashes are joined, and the pairs'
edit distance is verified.

Only lines that can have a neighbour emit variants.  An edit leaves one
half of a line untouched, so two lines within one edit agree in the first
or the second half, measured by the shorter one's length; a merged
count-min sketch over those halves finds, without loss, the lines that
share a half with a different line.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import intermediates, stored, text_bytes
from .sketch import Sketch, estimates, sketch
from .windows import SliceHashes, mix

_PIECE = 1 << 12         # lines handled at once
_SPACE = b" \t\n\r\x0b\x0c"


def _lines(batches, least: int):
    """Rows (doc_id, text_key, line number, stripped line, its characters)
    of the lines of ``least`` characters and more, in lists."""
    rows = []
    for batch in batches:
        for doc, key, text in zip(batch.column("doc_id").to_pylist(), batch.column("text_key").to_pylist(),
                                  text_bytes(batch.column("text"))):
            for number, line in enumerate(text.split(b"\n")):
                line = line.strip(_SPACE)
                if len(line) < least:
                    continue
                chars = line.decode()
                if len(chars) >= least:
                    rows.append((doc, key, number, line, chars))
            if len(rows) >= _PIECE:
                yield rows
                rows = []
    if rows:
        yield rows


def _ids(rows) -> np.ndarray:
    """128-bit hashes of the lines as two columns."""
    return np.frombuffer(b"".join(xxhash.xxh3_128_digest(r[3]) for r in rows), dtype="<u8").reshape(-1, 2)


def _halves(chars: str) -> list[int]:
    """Keys of a line's halves, as the shorter or equal one of a pair and
    as the longer one."""
    out, n, digest = [], len(chars), xxhash.xxh64_intdigest
    for shorter in (n, n - 1):
        front = shorter // 2
        out.append(digest(chars[:front].encode(), 2 * shorter))
        out.append(digest(chars[n - (shorter - front):].encode(), 2 * shorter + 1))
    return out


def _keys(rows) -> np.ndarray:
    return np.array([_halves(r[4]) for r in rows], dtype=np.uint64)


def _entries(min_chars: int):
    def run(batches):
        for rows in _lines(batches, min_chars):
            yield _keys(rows).ravel(), np.repeat(_ids(rows)[:, 0], 4)
    return run


_LINE = [("h1", pa.int64()), ("h2", pa.int64()), ("doc_id", pa.int64()), ("text_key", pa.int64()),
         ("line_no", pa.int64())]
_LINE_SQL = "h1 long, h2 long, doc_id long, text_key long, line_no long"


def _occurrences(least: int, min_chars: int = 0, shape: Sketch | None = None, maps=None):
    """The hash and place of every line of ``least`` characters and more;
    with ``maps`` also the text of lines that may have a neighbour (and are
    of ``min_chars`` and more)."""
    schema = pa.schema([*_LINE, *([("line", pa.string())] if maps else [])])

    def run(batches):
        for rows in _lines(batches, least):
            ids = _ids(rows).view(np.int64)
            columns = [pa.array(ids[:, 0]), pa.array(ids[:, 1]),
                       *(pa.array([r[i] for r in rows], pa.int64()) for i in range(3))]
            if maps:
                near = [i for i, r in enumerate(rows) if len(r[4]) >= min_chars]
                lines = [None] * len(rows)
                if near:
                    keys = _keys([rows[i] for i in near]).ravel()
                    mixed = estimates(shape, maps.value, keys, ("mixed",))[0].reshape(-1, 4).any(axis=1)
                    for i, m in zip(near, mixed.tolist()):
                        lines[i] = rows[i][4] if m else None
                columns.append(pa.array(lines, pa.string()))
            yield pa.RecordBatch.from_arrays(columns, schema=schema)
    return run


def _variants(batches):
    """(variant, h1, h2): hashes of a line and of its one-character deletions."""
    for batch in batches:
        for h1, h2, line in zip(*(batch.column(c).to_pylist() for c in ("h1", "h2", "line"))):
            symbols = mix(np.frombuffer(line.encode("utf-32-le"), dtype="<u4").astype(np.uint64) + np.uint64(1))
            hashes = np.unique(SliceHashes(symbols).without_one()).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(hashes), pa.array(np.full(len(hashes), h1)), pa.array(np.full(len(hashes), h2))],
                names=["variant", "h1", "h2"])


def _near(contents: DataFrame) -> DataFrame:
    """(h1, h2) of the lines with another line, of an earlier first
    occurrence, within one edit.  A variant's group holds at most the
    distinct lines that are it or one character more, however large the
    corpus is.

    The joins are merge joins by hint: the planner takes the variants to be
    smaller than their lines, of which each has as many as characters, and
    the lines to be as small as they are compressed; it would broadcast them
    through the driver."""
    lines = contents.filter("line is not null").select("h1", "h2", "first", "line")
    variants = lines.select("h1", "h2", "line").mapInArrow(_variants, "variant long, h1 long, h2 long")
    other = variants.select("variant", F.col("h1").alias("o1"), F.col("h2").alias("o2"))
    pairs = (variants.join(other.hint("merge"), "variant").filter("o1 < h1 or (o1 = h1 and o2 < h2)")
             .select("h1", "h2", "o1", "o2").distinct())
    others = lines.select(*(F.col(c).alias(o) for c, o in (("h1", "o1"), ("h2", "o2"), ("first", "o_first"), ("line", "o_line"))))
    earlier = F.col("o_first") < F.col("first")
    return (pairs.join(lines.hint("merge"), ["h1", "h2"]).join(others.hint("merge"), ["o1", "o2"])
            .filter(F.levenshtein("line", "o_line", 1) >= 0)
            .select(*(F.when(earlier, F.col(c)).otherwise(F.col(o)).alias(c) for c, o in (("h1", "o1"), ("h2", "o2")))).distinct())


def _rebuild(texts: pa.Array, removed: pa.Array) -> pa.Array:
    kept, n_lines, gone = [], [], []
    for text, numbers in zip(text_bytes(texts), removed.to_pylist()):
        lines = text.split(b"\n")
        n_lines.append(len(lines))
        drop = set(numbers or ())
        gone.append(len(drop))
        kept.append((b"\n".join(x for i, x in enumerate(lines) if i not in drop) if drop else text).decode())
    return pa.StructArray.from_arrays(
        [pa.array(kept, pa.string()), pa.array(n_lines, pa.int64()), pa.array(gone, pa.int64())],
        names=["kept_text", "n_lines", "n_removed"])


def dedup_lines(docs: DataFrame, min_chars: int = 20, cells: int = 1 << 27,
                min_exact: int | None = None) -> DataFrame:
    """(document, kept_text, n_lines, n_removed) of every row of ``docs``
    (with doc_id and text; ``document`` holds all its columns): a line goes
    if an earlier line (smaller doc_id, or before it in its document) is
    within one character edit of it; lines are judged on the input.

    Lines are separated by LF and compared without surrounding ASCII white
    space.  Lines of fewer than ``min_chars`` characters are not compared
    by edits: one edit makes another word or number of a short line.  They
    go as exact repeats from ``min_exact`` characters on (default:
    ``min_chars``; 1: every line that is not empty); shorter ones stay and
    take no part.  Null texts have one empty line and give an empty kept_text; rows
    with a null doc_id are returned whole and take no part; repeated rows
    (same doc_id and text) count as one document; an empty table gives an
    empty result."""
    spark = docs.sparkSession
    least = min_chars if min_exact is None else max(1, min(min_exact, min_chars))
    keyed = (docs.filter(F.col("doc_id").isNotNull() & F.col("text").isNotNull())
             .select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_key"), "text"))
    shape = Sketch(cells)
    with intermediates(spark):
        maps = spark.sparkContext.broadcast(sketch(keyed, shape, _entries(min_chars)))
        place = ("doc_id", "text_key", "line_no")
        contents = stored(
            keyed.mapInArrow(_occurrences(least, min_chars, shape, maps), f"{_LINE_SQL}, line string")
            .groupBy("h1", "h2").agg(F.min(F.struct(*place)).alias("first"), F.max(F.struct(*place)).alias("last"),
                                     F.first("line", ignorenulls=True).alias("line"))
            .filter("line is not null or first <> last"), "lines")
        maps.destroy()
        near = stored(_near(contents), "near").withColumn("near", F.lit(True))
        # stored, so that the next join has one exchange a side and AQE can
        # split a line with very many occurrences
        verdicts = stored(contents.drop("line").join(near, ["h1", "h2"], "left").filter("near or first <> last"), "verdicts")
        met = keyed.mapInArrow(_occurrences(least), _LINE_SQL).join(verdicts, ["h1", "h2"])
        removed = stored(met.filter(F.col("near") | (F.struct(*place) != F.col("first")))
                         .groupBy("doc_id", "text_key").agg(F.collect_set("line_no").alias("removed")), "removed",
                         keep=True)
    whole = docs.select(F.struct("*").alias("document"), F.col("doc_id").cast("long").alias("doc_id"),
                        F.xxhash64("text").alias("text_key"))
    out = whole.join(removed.hint("shuffle_hash"), ["doc_id", "text_key"], "left")
    rebuilt = F.arrow_udf(_rebuild, "kept_text string, n_lines long, n_removed long")("document.text", "removed")
    return out.select("document", rebuilt.alias("rebuilt")).select("document", "rebuilt.*")

"""SimHash near-duplicate groups by multi-index hashing."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import intermediates, stored, text_bytes
from .components import components

_SEED = 42
_LANES = np.arange(8, dtype=np.int64) * 256
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
_CHUNK = 1 << 17         # shingles counted at once


def fingerprint(text: bytes, shingle: int) -> int:
    """64-bit SimHash of a text: A-Z lower-cased, words split at ASCII
    white space, shingles with repeats (fewer words than a shingle: the
    whole sequence; none: 0).  A bit is 1 if it is set in more than half of
    the shingles' XXH64 values."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    n = max(1, len(words) - shingle + 1)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    last = ends[min(shingle, len(words)) - 1:]
    counts = np.zeros(64, dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, n, _CHUNK):
        hashes = np.array([digest(joined[a:b], _SEED) for a, b in
                           zip(starts[at:min(n, at + _CHUNK)].tolist(), last[at:at + _CHUNK].tolist())],
                          dtype="<u8")
        lanes = hashes.view(np.uint8).reshape(-1, 8) + _LANES
        counts += (np.bincount(lanes.ravel(), minlength=2048).reshape(8, 256) @ _BITS).ravel()
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def _fingerprints(shingle: int):
    schema = pa.schema([("doc_id", pa.int64()), ("text_key", pa.int64()), ("fingerprint", pa.int64())])

    def run(batches):
        for batch in batches:
            values = np.array([fingerprint(t, shingle) for t in text_bytes(batch.column("text"))], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), batch.column("text_key"), pa.array(values.view(np.int64))],
                schema=schema)
    return run


def _segments(max_bits: int) -> list[tuple[int, int]]:
    """(first bit, bits) of as many segments as make one of them differ by
    one bit at most."""
    m = max_bits // 2 + 1
    edges = [64 * i // m for i in range(m + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def _value(column, first: int, bits: int):
    shifted = F.shiftrightunsigned(column, first)
    return shifted if bits == 64 else shifted.bitwiseAND(F.lit((1 << bits) - 1))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def links(fingerprints: DataFrame, max_bits: int) -> DataFrame:
    """Pairs (a, b), a < b, of the distinct ``fingerprint`` values that
    differ in at most ``max_bits`` bits.  Each value is filed under its
    segments; each value also asks, segment by segment, for every value
    within the segment's Hamming ball (radius ``max_bits // segments``: 0
    or 1).  Two values within ``max_bits`` agree within that radius in some
    segment, so they meet; the full distance is checked in the join."""
    parts = _segments(max_bits)
    radius = max_bits // len(parts)
    filed = fingerprints.select(
        F.col("fingerprint").alias("b"),
        F.posexplode(F.array(*(_value(F.col("fingerprint"), a, n) for a, n in parts))).alias("segment", "value"))
    balls = [(i, _signed(flip)) for i, (a, n) in enumerate(parts)
             for flip in [0] + ([1 << (a + j) for j in range(n)] if radius else [])]
    asked = fingerprints.select(F.col("fingerprint").alias("a"), F.explode(F.array(
        *(F.struct(F.lit(i).alias("segment"), F.lit(flip).cast("long").alias("flip")) for i, flip in balls))).alias("ball"))
    flipped = F.col("a").bitwiseXOR(F.col("ball.flip"))
    value = F.coalesce(*(F.when(F.col("ball.segment") == i, _value(flipped, a, n)) for i, (a, n) in enumerate(parts)))
    asked = asked.select("a", F.col("ball.segment").alias("segment"), value.alias("value"))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits
    return (asked.join(filed, (asked["segment"] == filed["segment"]) & (asked["value"] == filed["value"])
                       & (F.col("a") < F.col("b")) & near)
            .select("a", "b").distinct())


def _grouped(docs: DataFrame, shingle: int, max_bits: int) -> DataFrame:
    """(doc_id, text_key, fingerprint, root, component_id) of every row:
    ``text_key`` is the text's hash, ``root`` the component itself, as
    components share their smallest doc_id where doc_ids repeat."""
    with intermediates(docs.sparkSession):
        marked = stored(docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text").mapInArrow(
            _fingerprints(shingle), "doc_id long, text_key long, fingerprint long"), "fingerprints", keep=True)
        nodes = stored(marked.groupBy("fingerprint").agg(F.min("doc_id").alias("least")), "nodes")
        roots = components(links(nodes, max_bits))
        rooted = (nodes.join(roots.withColumnRenamed("node", "fingerprint"), "fingerprint", "left")
                  .withColumn("root", F.coalesce("root", "fingerprint")))
        ids = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
        labels = stored(rooted.join(ids, "root").select("fingerprint", "root", "component_id"), "labels", keep=True)
    return marked.join(labels, "fingerprint")


def simhash_heads(docs: DataFrame, shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """(doc_id, text_key, rows) of one document of each SimHash group of
    ``docs`` (doc_id, not null, and text): the one with the smallest doc_id,
    and under that the smallest ``text_key`` (``xxhash64(text)``).  ``rows``
    is how many rows have both."""
    heads = _grouped(docs, shingle, max_bits).filter("doc_id = component_id")
    heads = heads.groupBy("root", "doc_id", "text_key").agg(F.count("*").alias("rows"))
    return (heads.groupBy("root", "doc_id")
            .agg(F.min("text_key").alias("least"), F.min_by("rows", "text_key").alias("rows"))
            .select("doc_id", F.col("least").alias("text_key"), "rows"))


def simhash_groups(docs: DataFrame, shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row of ``docs``
    (doc_id, text; other columns are not read): the 64-bit fingerprint as
    16 hex digits and the smallest doc_id reachable over links between
    fingerprints that differ in at most ``max_bits`` bits.

    Equal fingerprints are one node, so copies of any number make no
    pairs.  Null and empty texts have fingerprint zero and link like any
    other; null doc_ids get a row and count as no id; repeated rows get one
    row each; an empty table gives an empty result."""
    return (_grouped(docs, shingle, max_bits)
            .select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id"))

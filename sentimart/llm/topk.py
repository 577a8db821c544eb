"""Exact top-k search by distributed histogram selection.

Every query is scored against every candidate, block against block.  The
scores themselves are not kept: each round counts, for each query, how
many fall into each bin of its current range, merges the counts over the
cluster and narrows the range to the bin that holds the k-th largest
score, until the bin is one score wide.  A last pass filters by that
score; ties at it go to the smallest ids.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import intermediates, stored

_QUERY_BLOCK = 512       # queries scored at once
_ROW_BLOCK = 4_096       # candidates scored at once
_BINS = 1 << 12
_EXACT = 1 << 53         # sums of integers below this are exact in doubles
_SCALE = 256.0

_BLOCK = pa.schema([("dim", pa.int32()), ("ids", pa.binary()), ("vectors", pa.binary()), ("largest", pa.int64())])
_BLOCK_SQL = "dim int, ids binary, vectors binary, largest long"


def _pack(size: int):
    """Blocks of up to ``size`` vectors of one dimension, as int64 of
    floor(256 * component); vectors with a null or non-finite component,
    null vectors and null ids are left out."""
    def row(dim, ids, vectors):
        matrix = np.array(vectors, dtype=np.int64).reshape(len(ids), dim)
        return pa.RecordBatch.from_pylist(
            [{"dim": dim, "ids": np.array(ids, dtype=np.int64).tobytes(), "vectors": matrix.tobytes(),
              "largest": int(np.abs(matrix).max(initial=0))}], schema=_BLOCK)

    def run(batches):
        held: dict[int, tuple[list, list]] = {}
        for batch in batches:
            for vec, values in zip(batch.column("vec_id").to_pylist(), batch.column("embedding")):
                if vec is None or not values.is_valid or values.values.null_count:
                    continue
                x = np.asarray(values.values, dtype=np.float64)
                scaled = np.floor(x * _SCALE)
                if not np.isfinite(scaled).all():
                    continue
                if np.abs(scaled).max(initial=0) >= 2.0 ** 31:
                    raise ValueError("components of 2**23 and more are beyond integer scores")
                ids, vectors = held.setdefault(len(x), ([], []))
                ids.append(vec)
                vectors.append(scaled.astype(np.int64))
                if len(ids) == size:
                    yield row(len(x), ids, vectors)
                    del held[len(x)]
        for dim, (ids, vectors) in held.items():
            yield row(dim, ids, vectors)
    return run


def _scores(q_vectors, vectors, dim: int, bound: int):
    """Integer inner products of packed blocks (queries x candidates)."""
    q = np.frombuffer(q_vectors, dtype=np.int64).reshape(-1, dim)
    c = np.frombuffer(vectors, dtype=np.int64).reshape(-1, dim)
    if bound < _EXACT:
        return (q.astype(np.float64) @ c.astype(np.float64).T).astype(np.int64)
    return q @ c.T


def _each(batches):
    """Pairs of a query block and a candidate block, with their scores and
    the mask of pairs that are not a row with itself."""
    for batch in batches:
        for r in batch.to_pylist():
            ids, q_ids = (np.frombuffer(r[n], dtype=np.int64) for n in ("ids", "q_ids"))
            if r["dim"] == 0:
                n = (len(q_ids), len(ids))
                scores = np.zeros(n, dtype=np.int64)
            else:
                scores = _scores(r["q_vectors"], r["vectors"], r["dim"], r["bound"])
            yield r, ids, q_ids, scores, q_ids[:, None] != ids[None, :]


def _histograms(width: int):
    schema = pa.schema([("query_id", pa.int64()), ("bin", pa.int32()), ("n", pa.int64())])

    def run(batches):
        for r, _, q_ids, scores, other in _each(batches):
            low = np.frombuffer(r["low"], dtype=np.int64)
            bins = (scores - low[:, None]) // width
            inside = other & (bins >= 0) & (bins < _BINS)
            query, at = np.nonzero(inside)
            keys, n = np.unique(query * _BINS + bins[query, at], return_counts=True)
            for a in range(0, len(keys), 1 << 16):
                k = keys[a:a + (1 << 16)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(q_ids[k // _BINS]), pa.array((k % _BINS).astype(np.int32)),
                     pa.array(n[a:a + (1 << 16)])], schema=schema)
    return run


def _best(k: int):
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def run(batches):
        for r, ids, q_ids, scores, other in _each(batches):
            least = np.frombuffer(r["low"], dtype=np.int64)
            out = []
            for i in range(len(q_ids)):
                at = np.flatnonzero(other[i] & (scores[i] >= least[i]))
                at = at[np.lexsort((ids[at], -scores[i][at]))][:k]
                out.append((np.full(len(at), q_ids[i]), ids[at], scores[i][at]))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], schema=schema)
    return run


def _paired(queries: DataFrame, state: DataFrame, rows: DataFrame, slots: int) -> DataFrame:
    """Each query block, with its queries' ``low`` in order, beside each
    candidate block: candidate blocks are spread over ``slots`` and every
    query block visits every slot."""
    lows = (queries.select("block", F.posexplode("query_ids").alias("at", "query_id")).join(state, "query_id")
            .groupBy("block").agg(F.sort_array(F.collect_list(F.struct("at", "low"))).alias("lows"))
            .mapInArrow(_packed_lows, "block string, low binary"))
    asked = (queries.drop("query_ids").join(lows, "block")
             .select(F.col("dim"), F.col("ids").alias("q_ids"), F.col("vectors").alias("q_vectors"), "low",
                     F.col("largest").alias("q_largest"), F.explode(F.sequence(F.lit(0), F.lit(slots - 1))).alias("slot")))
    bound = F.col("q_largest").cast("decimal(38,0)") * F.col("largest") * F.col("dim")
    return (rows.join(asked, ["slot", "dim"]).withColumn("bound", F.least(bound, F.lit(1 << 62)).cast("long"))
            .select("dim", "ids", "vectors", "q_ids", "q_vectors", "low", "bound"))


def _packed_lows(batches):
    for batch in batches:
        lows = [np.array([x["low"] for x in r], dtype=np.int64).tobytes() for r in batch.column("lows").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("block"), pa.array(lows, pa.binary())], names=["block", "low"])


def _unpacked_ids(batches):
    for batch in batches:
        ids = [np.frombuffer(b, dtype=np.int64) for b in batch.column("ids").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(ids, pa.list_(pa.int64()))], names=[*batch.schema.names, "query_ids"])


def top_k(vectors: DataFrame, queries, k: int = 5, slots: int | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score) of the ``k`` candidates with the
    largest integer inner products for each row of ``vectors`` (vec_id,
    embedding) for which the column ``queries`` holds, against every other
    row (all of them, if fewer); ties go to the smaller vec_id.

    Components x become floor(256 * x), x as double.  Null vectors, null or
    non-finite components and null ids take no part; rows of different
    dimensions are not compared; rows that share a vec_id are not each
    other's candidates, as queries they are one - the smallest of their
    vectors that take part, component by component - and as candidates of
    another row each is a result of its own; an empty table gives an empty
    result.  ``slots`` (default: the session's shuffle partitions) is
    the number of tasks that candidate blocks are spread over."""
    spark = vectors.sparkSession
    slots = slots or int(spark.conf.get("spark.sql.shuffle.partitions"))
    vectors = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>"))
    with intermediates(spark):
        rows = stored(vectors.mapInArrow(_pack(_ROW_BLOCK), _BLOCK_SQL)
                      .withColumn("slot", F.pmod(F.xxhash64("ids"), F.lit(slots)).cast("int")), "candidates")
        finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
        asked = vectors.filter(queries).filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & finite)
        asked = stored(asked.groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
                       .mapInArrow(_pack(_QUERY_BLOCK), _BLOCK_SQL)
                       .withColumn("block", F.sha2(F.col("ids"), 256))
                       .mapInArrow(_unpacked_ids, _BLOCK_SQL + ", block string, query_ids array<long>"), "queries")
        bounds = (asked.groupBy("dim").agg(F.max("largest").alias("q")).join(
            rows.groupBy("dim").agg(F.max("largest").alias("c")), "dim")
            .agg(F.max(F.col("q").cast("decimal(38,0)") * F.col("c") * F.col("dim"))).first()[0])
        bound = int(bounds or 0)
        if bound >= 1 << 61:
            raise ValueError("inner products may not fit a 64-bit integer")
        width = 1
        while width * _BINS < 2 * bound + 1:
            width *= _BINS
        ids = asked.select(F.explode("query_ids").alias("query_id"))
        state = stored(ids.select("query_id", F.lit(-bound).cast("long").alias("low"), F.lit(k).cast("long").alias("need")),
                       "ranges")
        while True:
            counts = (_paired(asked, state, rows, slots).mapInArrow(_histograms(width), "query_id long, bin int, n long")
                      .groupBy("query_id", "bin").agg(F.sum("n").alias("n")))
            # the bins of one query are few; the bin of its k-th score is the
            # largest one at which the counts from the top reach what is needed
            bins = counts.groupBy("query_id").agg(F.reverse(F.sort_array(F.collect_list(F.struct("bin", "n")))).alias("bins"))
            found = F.aggregate(
                "bins", F.struct(F.col("need").alias("need"), F.lit(-1).alias("bin")),
                lambda a, b: F.when(a["bin"] >= 0, a).when(b["n"] >= a["need"], F.struct(a["need"].alias("need"), b["bin"].alias("bin")))
                .otherwise(F.struct((a["need"] - b["n"]).alias("need"), F.lit(-1).alias("bin"))))
            # fewer candidates than k: nothing is narrowed, all of them stay
            step = state.join(bins, "query_id", "left").withColumn("found", F.when(F.col("bins").isNotNull(), found))
            hit = F.col("found.bin") >= 0
            state = stored(step.select(
                "query_id", F.when(hit, F.col("low") + F.col("found.bin") * F.lit(width)).otherwise(F.col("low")).cast("long").alias("low"),
                F.when(hit, F.col("found.need")).otherwise(F.col("need")).cast("long").alias("need")), "ranges")
            if width == 1:
                break
            width //= _BINS
        best = _paired(asked, state, rows, slots).mapInArrow(_best(k), "query_id long, vec_id long, score long")
        rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
        return stored(best.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score"),
                      "best", keep=True)

"""Key leases (U4) and a call rate per key.

Each client (an API key) is leased to exactly one task: rows are dealt into
as many partitions as there are clients, so the calls of one key follow one
another whatever the size of the table or of the cluster.  A token bucket
in the task keeps them within the key's rate.  A table that is too large
for one task a key goes in turns: a key's tasks then follow one another.
"""

from __future__ import annotations

import math
import time
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import split_pair
from ..schemas import BATCH_SIZE, MAX_ATTEMPTS, SENTINEL
from ..session import open_files, scratch_path
from ..sinks.files import OPEN_PARQUET, remove_path
from .classify import Classifier, classify_slice

#: what a row's ``call`` tells: the key, the number of its slice within the
#: key, the calls that this took, and when the first began and the last ended
CALL = T.StructType([
    T.StructField("lease", T.IntegerType()), T.StructField("slice", T.LongType()), T.StructField("attempts", T.IntegerType()),
    T.StructField("started", T.ArrayType(T.DoubleType())), T.StructField("ended", T.ArrayType(T.DoubleType()))])


class TokenBucket:
    """At most ``burst`` calls at once and ``rate`` a second on average."""

    def __init__(self, rate: float, burst: int = 1, full: bool = True,
                 clock: Callable[[], float] = time.time, sleep: Callable[[float], None] = time.sleep):
        if rate <= 0 or burst < 1:
            raise ValueError("a rate above 0 and a burst of at least 1")
        self.rate, self.burst, self.clock, self.sleep = rate, burst, clock, sleep
        self.tokens, self.at = float(burst if full else 0), clock()

    def take(self) -> float:
        """Wait for a token; returns the time at which it was there."""
        while True:
            now = self.clock()
            # a clock that was set back gives nothing
            self.tokens = min(self.burst, self.tokens + max(0.0, now - self.at) * self.rate)
            self.at = now
            if self.tokens >= 1:
                self.tokens -= 1
                return now
            self.sleep((1 - self.tokens) / self.rate)


@dataclass
class _Lease:
    """One key in its task: its calls are counted, timed and spaced."""
    key: int
    client: Classifier
    bucket: TokenBucket
    clock: Callable[[], float]

    def __post_init__(self):
        self.started: list[float] = []
        self.ended: list[float] = []

    def __call__(self, texts: list[str]) -> str:
        self.bucket.take()
        self.started.append(self.clock())
        try:
            return self.client(texts)
        finally:
            self.ended.append(self.clock())


def deal(df: DataFrame, keys: int) -> DataFrame:
    """``df`` in ``keys`` partitions of about one size, partition k being
    the rows of key k.  Rows are dealt in turn, not by a column, so that no
    hot value fills one key's partition.  The rows of a partition of ``df``
    have to come in the same order again when a task is run again, as those
    of a scan do."""
    lane = "__lane"
    dealt = df.withColumn(lane, F.pmod(F.monotonically_increasing_id(), F.lit(keys)).cast("int"))
    return dealt.repartitionById(keys, F.col(lane)).drop(lane)


def label_leased(df: DataFrame, text_col: str, clients: Sequence[Classifier], rate: float, burst: int = 1,
                 batch_size: int = BATCH_SIZE, max_attempts: int = MAX_ATTEMPTS, check_numbers: bool = False,
                 sleep: Callable[[float], None] = time.sleep, clock: Callable[[], float] = time.time,
                 barrier: bool = False, label_col: str = "label", call_col: str = "call", turn: int = 0) -> DataFrame:
    """U1-U5 with one task a key: every row of ``df`` with its label and the
    ``call`` that it came from (NULL for a NULL text, which is not sent and
    gets the sentinel).  Each call, also a repeated one, takes a token of
    its key; an attempt of a task after the first starts without any, so
    that the calls of the attempt before it are not exceeded.

    ``barrier`` runs all keys' tasks at once, or none, and never a second
    copy of one; without it the job should not run under speculation.  A
    later ``turn`` of the same keys starts without tokens too, and its slices
    are numbered after those of the turns before it."""
    schema = T.StructType([*df.schema.fields, T.StructField(label_col, T.StringType()), T.StructField(call_col, CALL)])
    calls = pa.struct([("lease", pa.int32()), ("slice", pa.int64()), ("attempts", pa.int32()),
                       ("started", pa.list_(pa.float64())), ("ended", pa.list_(pa.float64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ctx = TaskContext.get()
        key = ctx.partitionId() % len(clients)
        bucket = TokenBucket(rate, burst, turn == 0 and ctx.attemptNumber() == 0, clock, sleep)
        lease = _Lease(key, clients[key], bucket, clock)
        number = turn << 32

        def labelled(rows: pa.RecordBatch) -> pa.RecordBatch:
            nonlocal number
            lease.started, lease.ended = [], []
            labels = classify_slice(rows.column(text_col).to_pylist(), lease, max_attempts, sleep, check_numbers)
            call = {"lease": key, "slice": number, "attempts": len(lease.started), "started": lease.started, "ended": lease.ended}
            number += 1
            return (rows.append_column(label_col, pa.array(labels, pa.string()))
                    .append_column(call_col, pa.array([call] * rows.num_rows, calls)))

        held: pa.RecordBatch | None = None
        for rows in batches:
            texts = rows.column(text_col)
            none = rows.filter(pc.is_null(texts))
            if none.num_rows:
                yield (none.append_column(label_col, pa.array([SENTINEL] * none.num_rows, pa.string()))
                       .append_column(call_col, pa.nulls(none.num_rows, calls)))
            rows = rows.filter(pc.is_valid(texts))
            rows = pa.concat_batches([held, rows]) if held is not None else rows
            whole = rows.num_rows // batch_size * batch_size
            for at in range(0, whole, batch_size):
                yield labelled(rows.slice(at, batch_size))
            held = rows.slice(whole)
        if held is not None and held.num_rows:
            yield labelled(held)

    return deal(df, len(clients)).mapInArrow(run, schema, barrier)


def classify_leased(df: DataFrame, clients: Sequence[Classifier], rate: float, text_col: str = "textoriginal",
                    **kw) -> DataFrame:
    """``emotion``, ``sentimentnature`` and ``call`` of every comment, each
    of ``clients`` leased to one task and kept to ``rate`` calls a second."""
    emotion, sentiment = split_pair("label")
    return (label_leased(df, text_col, clients, rate, **kw)
            .withColumns({"emotion": emotion, "sentimentnature": sentiment}).drop("label"))


#: bytes of text that a key's task takes in one turn
TEXT_PER_TURN = 512 << 20


def store_leased(df: DataFrame, clients: Sequence[Classifier], rate: float, text_col: str = "textoriginal",
                 name: str = "leased", text_per_turn: int = TEXT_PER_TURN, **kw) -> DataFrame:
    """:func:`classify_leased`, stored.  As a key is one task's at a time,
    what the task reads grows with the table; so the rows are dealt into
    turns of about ``text_per_turn`` bytes of text a key, and a turn is a job
    that begins when the one before it has ended."""
    spark = df.sparkSession
    out, total = scratch_path(spark, name), df.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    turns = max(1, math.ceil(total / (len(clients) * text_per_turn)))
    if turns == 1:
        classify_leased(df, clients, rate, text_col, **kw).write.parquet(f"{out}/turn=0")
    else:
        dealt = scratch_path(spark, f"{name}-turns")
        with open_files(spark, OPEN_PARQUET):
            (df.withColumn("turn", F.pmod(F.monotonically_increasing_id(), F.lit(turns)).cast("int"))
             .write.partitionBy("turn").parquet(dealt))
        for turn in range(turns):
            rows = spark.read.schema(df.schema).parquet(f"{dealt}/turn={turn}")
            classify_leased(rows, clients, rate, text_col, turn=turn, **kw).write.parquet(f"{out}/turn={turn}")
        remove_path(spark, dealt)
    return spark.read.parquet(out).drop("turn")


def lease_report(calls: DataFrame, rate: float, burst: int = 1, call: str | Column = "call") -> DataFrame:
    """(lease, n_calls, n_overlapping, n_over_rate) of the rows that
    :func:`label_leased` gave, once stored: calls that began before the
    key's last one ended, and calls that began sooner than a token bucket
    lets them.  A window sorts one key's calls, a slice of rows each."""
    c = F.col(call) if isinstance(call, str) else call
    each = (calls.where(c.isNotNull()).select(c.alias("c")).select("c.lease", "c.slice", "c.started", "c.ended").distinct()
            .select("lease", "slice", F.posexplode(F.arrays_zip("started", "ended")).alias("attempt", "t"))
            .select("lease", "slice", "attempt", "t.started", "t.ended"))
    order = Window.partitionBy("lease").orderBy("slice", "attempt")
    late = F.col("started") < F.lag("ended").over(order)
    # burst + 1 calls take 1 / rate seconds at least
    soon = F.col("started") - F.lag("started", burst).over(order) < F.lit(1 / rate - 1e-3)
    return (each.withColumns({"late": F.coalesce(late, F.lit(False)), "soon": F.coalesce(soon, F.lit(False))})
            .groupBy("lease").agg(F.count("*").alias("n_calls"), F.count_if("late").alias("n_overlapping"),
                                  F.count_if("soon").alias("n_over_rate")))

"""Window operators: keyed dedup (W1), top-N per group (W2), ordinals (O5),
fixed-size batches (O6).

``row_number() = k`` filters are planned by Catalyst as a
``WindowGroupLimit`` (partial before the shuffle, final after), so a hot
key - even one holding a third of all rows - shrinks to a handful of
candidates per map task before anything crosses the network.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def total_order(df: DataFrame, keys: Sequence[str],
                first: Sequence[Column] = ()) -> list[Column]:
    """``first`` followed by every non-key column ascending, NULLs first:
    a total order up to fully identical rows, so the survivor of a dedup
    or the winner of a tie never depends on scheduling."""
    skip = {k.lower() for k in keys}
    rest = [F.col(f"`{c}`").asc_nulls_first() for c in df.columns
            if c.lower() not in skip]
    return list(first) + rest


def dedup_by_key(df: DataFrame, keys: str | Sequence[str],
                 order_by: Sequence[Column] | None = None) -> DataFrame:
    """Keep one row per key.  The survivor is the first under
    ``order_by`` (default: all remaining columns ascending, NULLs first)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    order = list(order_by) if order_by is not None else total_order(df, keys)
    w = Window.partitionBy(*[F.col(k) for k in keys]).orderBy(*order)
    return (df.withColumn("__rn", F.row_number().over(w))
            .filter(F.col("__rn") == 1).drop("__rn"))


def top_n_per_group(df: DataFrame, group: str | Sequence[str],
                    order_by: Sequence[Column], n: int = 1,
                    rank_col: str | None = "rank",
                    tie_break: Sequence[Column] | None = None) -> DataFrame:
    """The first ``n`` rows of each group under ``order_by``, with a
    ``row_number`` column named ``rank_col`` (BIGINT) kept when given.
    NULL group values form one group of their own."""
    group = [group] if isinstance(group, str) else list(group)
    order = list(order_by) + list(tie_break if tie_break is not None
                                  else total_order(df, group))
    w = Window.partitionBy(*[F.col(g) for g in group]).orderBy(*order)
    name = rank_col or "__rank"
    out = (df.withColumn(name, F.row_number().over(w))
           .filter(F.col(name) <= n)
           .withColumn(name, F.col(name).cast("bigint")))
    return out if rank_col else out.drop(name)


def add_ordinal(df: DataFrame, order_by: Sequence[Column],
                name: str = "ordinal", partitions: int | None = None) -> DataFrame:
    """0-based ordinal over ``order_by`` without funnelling the table
    through one task (a global ``row_number()`` would).

    Rows are range-partitioned and sorted by the order; within a partition
    ``monotonically_increasing_id`` already counts rows (low 33 bits), and
    each partition's start offset comes from a per-partition count, which
    is broadcast - its size is the partition count, a configured bound,
    never the row count.  ``order_by`` must be a total order (end it with a
    unique key) so a recomputed partition gets the same numbers.
    """
    from ..sinks.files import materialize
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # stored once: counts and rows must come from one and the same sampling
    # of the range bounds
    ranged = (df.repartitionByRange(n, *order_by).sortWithinPartitions(*order_by)
              .withColumn("__pid", F.spark_partition_id())
              .withColumn("__local", F.monotonically_increasing_id()
                          - F.shiftleft(F.col("__pid").cast("bigint"), 33)))
    ranged = materialize(ranged, "ordinal")
    counts = ranged.groupBy("__pid").agg(F.count("*").alias("__n"))
    offsets = counts.select("__pid", F.coalesce(F.sum("__n").over(
        Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0)).alias("__off"))
    return (ranged.join(F.broadcast(offsets), "__pid")
            .withColumn(name, (F.col("__off") + F.col("__local")).cast("bigint"))
            .drop("__pid", "__local", "__off"))


def range_shard(key: str | Column, width: int) -> Column:
    """Shard of a dense integer key: ``floor(key / width)``.  A shard holds
    at most ``width`` distinct keys whatever the table size, which bounds
    every window group built on it (a hash-modulo shard grows with the
    table)."""
    k = F.col(key) if isinstance(key, str) else key
    return F.floor(k / width).cast("bigint")


def ordinal_batches(df: DataFrame, order_by: Sequence[Column], size: int,
                    batch_col: str = "batch_id", pos_col: str = "pos") -> DataFrame:
    """O6 for keys of any type: consecutive batches of ``size`` rows of the
    whole table in the given total order, cut from its ordinals (O5); only
    the last batch is smaller.  No shard and no window group is needed."""
    numbered = add_ordinal(df, order_by, "__rn")
    return (numbered.withColumn(batch_col, F.floor(F.col("__rn") / size).cast("bigint"))
            .withColumn(pos_col, (F.col("__rn") % size + 1).cast("int")).drop("__rn"))


def batch_assign(df: DataFrame, shard: Column, order_by: Sequence[Column],
                 size: int, batch_col: str = "batch_id",
                 pos_col: str = "pos") -> DataFrame:
    """Cut each shard into consecutive batches of ``size`` rows
    (1-based ``pos`` within the batch).  Each shard is one window group,
    so the caller passes a shard of bounded size (:func:`range_shard`);
    in-task slicing (``operators.classify``) needs no shard at all."""
    w = Window.partitionBy(shard).orderBy(*order_by)
    rn = F.row_number().over(w) - 1
    return (df.withColumn("__rn", rn)
            .withColumn(batch_col, F.floor(F.col("__rn") / size).cast("bigint"))
            .withColumn(pos_col, (F.col("__rn") % size + 1).cast("int"))
            .drop("__rn"))

"""Id batching (S12): the ids of detail requests, a bounded number each.
Paged acquisition (S11) is ``sources.pages``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.windowing import batch_assign, ordinal_batches


def id_batches(ids: DataFrame, id_col: str, shard: Column | None = None, size: int = 50) -> DataFrame:
    """Ids in batches of ``size``, joined by ``,`` (one detail request
    each).  Groups are bounded by ``size``.  Ids of any type are batched over
    the whole table; with ``shard``, over each of its values (bounded ones,
    see ``range_shard``)."""
    if shard is None:
        b, keys = ordinal_batches(ids.select(id_col), [F.col(id_col)], size), ["batch_id"]
    else:
        b = batch_assign(ids.withColumn("shard", shard), F.col("shard"), [F.col(id_col)], size)
        keys = ["shard", "batch_id"]
    return b.groupBy(*keys).agg(
        F.count(F.lit(1)).cast("int").alias("n_ids"),
        F.array_join(F.array_sort(F.collect_list(id_col)), ",").alias("ids"))

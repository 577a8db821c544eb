"""Aggregations: keyed counts (A1), conditional-sum pivot (A2), whole-frame
status counts (A3), ratio to group total (W3).

All are hash aggregates with a partial (map-side) stage, so a hot key is
reduced to one row per map task before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import percent_of


def count_by_keys(df: DataFrame, keys: Sequence[str], value: str,
                  name: str = "n") -> DataFrame:
    """A1: ``COUNT(value)`` (non-NULL values) per key combination."""
    return df.groupBy(*keys).agg(F.count(F.col(value)).cast("bigint").alias(name))


def ratio_to_group_total(df: DataFrame, keys: Sequence[str], value: str,
                         partition_keys: Sequence[str], name: str = "percentage",
                         count_name: str = "n", scale: int = 2,
                         compat_scale6: bool = False) -> DataFrame:
    """``ROUND(COUNT(v) / SUM(COUNT(v)) OVER (PARTITION BY p) * 100, s)``.

    The count is partially aggregated before its shuffle; the window then
    runs over the already aggregated rows (one per key combination).
    """
    counted = count_by_keys(df, keys, value, count_name)
    total = F.sum(count_name).over(Window.partitionBy(*partition_keys))
    return counted.withColumn(name, percent_of(F.col(count_name), total, scale, compat_scale6))


def conditional_sum_pivot(df: DataFrame, keys: Sequence[str], pivot: str,
                          value: str, mapping: dict[str, str]) -> DataFrame:
    """A2: ``SUM(CASE WHEN pivot = k THEN value ELSE 0 END) AS name`` for
    each ``k -> name`` in ``mapping`` (0 when a key has no such row)."""
    aggs = [F.sum(F.when(F.col(pivot) == k, F.col(value)).otherwise(F.lit(0.0)))
            .cast("double").alias(n) for k, n in mapping.items()]
    return df.groupBy(*keys).agg(*aggs)


def status_counts(df: DataFrame, ok: Column, by: Sequence[str] = ()) -> DataFrame:
    """A3: total, processed and unprocessed rows in one pass (one job
    instead of one ``count()`` action per figure)."""
    aggs = [F.count(F.lit(1)).alias("total_rows"),
            F.count_if(ok).alias("processed_rows"),
            F.count_if(~ok | ok.isNull()).alias("unprocessed_rows")]
    g = df.groupBy(*by) if by else df.groupBy()
    return g.agg(*aggs)

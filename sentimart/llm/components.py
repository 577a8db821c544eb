"""Connected components of a link table, on Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .common import stored


def _oriented(links: DataFrame) -> DataFrame:
    return (links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
            .filter("u <> v").distinct())


def _kept(links: DataFrame) -> tuple[DataFrame, dict]:
    """The stored links, and a count and checksum observed while writing."""
    seen = Observation()
    links = links.observe(seen, F.count(F.lit(1)).alias("n"),
                          F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("checksum"))
    return stored(links, "links"), seen.get


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node in ``links`` (two columns of one ordered
    type), the root being the component's smallest node.

    Alternating large and small stars: each node links its larger
    neighbours, then its smaller ones, to the smallest node it sees, until
    nothing changes (a logarithmic number of rounds in practice).  Minima
    are aggregated before the shuffle, and a round's links are joined to
    them by plain inner joins, which AQE splits on a hot node."""
    a, b = links.columns
    now, before = _kept(_oriented(links.select(F.col(a).alias("u"), F.col(b).alias("v"))))
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.distinct()
        small = large.groupBy("u").agg(F.min("v").alias("m"))
        met = large.join(small, "u")
        now, after = _kept(_oriented(met.select(F.col("v").alias("u"), F.col("m").alias("v"))
                                     .unionByName(small.select("u", F.col("m").alias("v")))))
        if after == before:
            break
        before = after
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())

"""Joins: 1:0..1 left join (J1) and fan-out left join.

No join here carries a ``broadcast()`` hint.  Catalyst broadcasts a side
only when its estimated size is under
``spark.sql.autoBroadcastJoinThreshold``, and AQE re-decides at runtime
from the measured shuffle size
(``spark.sql.adaptive.autoBroadcastJoinThreshold``); both are size checks,
and above them the join stays a sort-merge join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def left_join_one(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """``left LEFT JOIN right USING (key)`` where ``right`` has at most
    one row per key; unmatched rows get NULLs.  Unique keys on both sides
    mean no key can be hot, so the plain join is skew-free."""
    return left.join(right, on=key, how="left")


def left_join_fanout(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """``left LEFT JOIN right USING (key)`` where ``left`` has one row
    per key and ``right`` many (one output row per match, one NULL-padded
    row when there is none).

    Written as ``inner join`` plus ``left anti join`` on the distinct right
    keys.  Unlike a left outer join this lets the planner build the hash
    table from the one-row-per-key side (only an inner join may broadcast
    its *left* side) and lets AQE split a hot key of ``right`` into several
    tasks (skew splitting is not allowed on the NULL-padded side of an
    outer join).  The anti join reads only the partially aggregated set of
    distinct keys, so a hot key costs one row per map task.
    """
    matched = left.join(right, on=key, how="inner")
    right_keys = right.select(key).where(F.col(key).isNotNull()).distinct()
    missing = left.join(right_keys, on=key, how="left_anti")
    for f in right.schema.fields:
        if f.name != key:
            missing = missing.withColumn(f.name, F.lit(None).cast(f.dataType))
    return matched.unionByName(missing)

"""Joins whose hot keys can be divided over tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_hot(rows: DataFrame, told: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """rows joined by equal keys with a side of few rows a key, such as an aggregate by them; any key may hold most rows.

    Spark divides a hot key's rows over tasks only where both sides are exchanged
    for the join itself. A side that was grouped by the keys would come as it is
    dealt, so a hash of the keys stands beside them, by which neither side is dealt
    yet. Rows with null keys match none.
    """
    hashed = F.xxhash64(*keys)
    return rows.withColumn("_dealt", hashed).join(told.withColumn("_dealt", hashed), [*keys, "_dealt"], how).drop("_dealt")


def not_broadcast(frame: DataFrame) -> DataFrame:
    """The frame, to be joined by shuffle and merge, whatever size is guessed of it.

    Behind generators and aggregates Spark takes the size of what was read, often far
    too little, and would send a side that grows with the input through the driver.
    """
    return frame.hint("merge")

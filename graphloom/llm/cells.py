"""Running sums and row numbers over groups of any size, without one task per group.

A window over a hot group would sort it in one task. Here each group is cut
into cells by a uniform hash of the row; a cell's rows fit a task, and only one
row per cell is summed up in group order to give each cell its start.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .session import not_broadcast


def hash60(value: Column) -> Column:
    """The first 60 bits of the MD5 of a string, as a long: uniform, and the same in any engine."""
    return F.conv(F.substring(F.md5(value), 1, 15), 16, 10).cast("long")


def cell_of(key: Column, cells: int) -> Column:
    """Cell (0 .. cells-1) of a 60-bit hash, in the order of the hash."""
    return F.floor(key / F.lit((1 << 60) / cells)).cast("int")


def running_start(
    rows: DataFrame,
    group: list[str],
    order: list[str],
    amount: Column,
    into: str,
    cell: str,
    rest: list[Column] | None = None,
) -> DataFrame:
    """Add column `into`: the sum of `amount` over the rows before this one in its group.

    Rows are ordered by `cell`, then `order`. `cell` must be a monotone function
    of the order's first column for the order to be the plain one. Groups are
    compared null-safely. Ties have no stated order among themselves.
    """
    safe = [F.coalesce(F.col(g).cast("string"), F.lit("")).alias(f"_g{i}") for i, g in enumerate(group)]
    nulls = [F.col(g).isNull().alias(f"_n{i}") for i, g in enumerate(group)]
    keys = [f"_g{i}" for i in range(len(group))] + [f"_n{i}" for i in range(len(group))]
    keyed = rows.select("*", *safe, *nulls, amount.alias("_amount"))
    sums = keyed.groupBy(*keys, cell).agg(F.sum("_amount").alias("_cell_sum"))
    before = Window.partitionBy(*keys).orderBy(cell).rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(*keys, cell, F.coalesce(F.sum("_cell_sum").over(before), F.lit(0)).alias("_start"))
    inner = Window.partitionBy(*keys, cell).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    within = keyed.withColumn("_within", F.coalesce(F.sum("_amount").over(inner), F.lit(0)))
    return (
        within.join(not_broadcast(starts), [*keys, cell])
        .withColumn(into, F.col("_start") + F.col("_within"))
        .drop(*keys, "_amount", "_start", "_within")
    )

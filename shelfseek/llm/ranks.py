"""Numbering rows within groups without putting a whole group into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows that one window sorts, about.
ROWS_PER_BLOCK = 8192


def numbered(rows: DataFrame, group: str, groups: DataFrame, order: list[Column], to: str) -> DataFrame:
    """``rows`` with a gapless number from 0 within each ``group``, in the order of a hash and then ``order``.

    ``rows`` has a bigint column ``_spread``, the same at each reading (read it from a stored table);
    ``groups`` has one row per group, small enough to broadcast, with the column ``_rows`` that counts its rows.
    A group is cut into blocks by ranges of ``_spread``, as many as its rows need; blocks are counted, their
    counts summed up in order, and rows numbered inside their block.
    """
    blocks = F.greatest(F.lit(1), F.ceil(F.col("_rows") / ROWS_PER_BLOCK)).cast("bigint")
    at = F.least(F.col("_blocks") - 1, F.floor(F.pmod(F.col("_spread"), F.lit(1 << 30)) * F.col("_blocks") / (1 << 30)))
    cut = rows.join(F.broadcast(groups.select(group, blocks.alias("_blocks"))), group)
    cut = cut.withColumn("_block", at.cast("bigint")).drop("_blocks")
    counts = cut.groupBy(group, "_block").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(group).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(group, "_block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(group, "_block").orderBy(F.pmod(F.col("_spread"), F.lit(1 << 30)), *order)
    ranked = cut.withColumn("_inside", F.row_number().over(inside))
    return (
        ranked.join(offsets, [group, "_block"])
        .withColumn(to, F.col("_before") + F.col("_inside") - 1)
        .drop("_block", "_before", "_inside")
    )

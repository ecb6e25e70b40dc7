"""Unbroken ranges of numbers per key: which offsets a table holds, and which of them were loaded."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Numbers of a block: a key's numbers are looked at block by block, so a hot key is no single task's.
BLOCK = 1_000_000


def ranges_of(df: DataFrame, key: Sequence[str], number: str, block: int = BLOCK) -> DataFrame:
    """(key, first, last): the maximal ranges of consecutive numbers of each key; repeated numbers count once.

    Blocks of ``block`` numbers are counted by partial aggregation. Only a block whose count does not fill the span
    between its least and greatest number is sorted, which is at most ``block`` distinct numbers at a time.
    """
    key = list(key)
    rows = df.select(*key, F.col(number).alias("_at"), F.floor(F.col(number) / F.lit(block)).cast("bigint").alias("_block"))
    rows = rows.where(F.col("_at").isNotNull())
    counts = rows.groupBy(*key, "_block").agg(F.min("_at").alias("first"), F.max("_at").alias("last"), F.count("*").alias("_n"))
    full = F.col("_n") == F.col("last") - F.col("first") + 1
    broken = counts.where(~full).select(*[F.col(k).alias(f"_of_{k}") for k in [*key, "_block"]])
    same = [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in [*key, "_block"]]
    each = rows.join(broken, same, "left_semi").distinct()
    island = F.col("_at") - F.row_number().over(Window.partitionBy(*key, "_block").orderBy("_at"))
    parts = each.withColumn("_island", island).groupBy(*key, "_block", "_island").agg(F.min("_at").alias("first"), F.max("_at").alias("last"))
    return merge_ranges(counts.where(full).select(*key, "first", "last").unionByName(parts.select(*key, "first", "last")), key)


def merge_ranges(ranges: DataFrame, key: Sequence[str]) -> DataFrame:
    """(key, first, last): ranges that overlap or follow each other without a gap are drawn together.

    Works on one row per range, not per number; the ranges of one key meet in one task.
    """
    key = list(key)
    order = Window.partitionBy(*key).orderBy("first", "last")
    before = F.max("last").over(order.rowsBetween(Window.unboundedPreceding, -1))
    new = F.when(before.isNull() | (F.col("first") > before + 1), 1).otherwise(0)
    marked = ranges.withColumn("_new", new).withColumn("_group", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return marked.groupBy(*key, "_group").agg(F.min("first").alias("first"), F.max("last").alias("last")).drop("_group")

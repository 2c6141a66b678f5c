"""Ranks, running sums and neighbours in one order over a whole table, without a task that sees all of it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.staging import dropped, staged

PART = "_part"


def ranged(df: DataFrame, *order: str | Column, rows: int = 500_000) -> DataFrame:
    """df in ranges of the order, of about `rows` rows each, with the number of the range as _part.

    Ranges are drawn from a sample, so the table is written once for all its readers.
    """
    table = staged(df, "unordered")
    parts = max(1, -(-table.count() // rows))
    out = staged(table.repartitionByRange(parts, *order).withColumn(PART, F.spark_partition_id()), "ranged")
    dropped(table)
    return out


def running_sum(table: DataFrame, order: list, value: str | Column, name: str) -> DataFrame:
    """A ranged table with `name`, the sum of `value` over all rows before each, null for the first; without _part."""
    before = Window.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    bases = table.groupBy(PART).agg(F.sum(value).alias("_sum")).select(PART, F.sum("_sum").over(before).alias("_base"))
    inside = F.sum(value).over(Window.partitionBy(PART).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1))
    base, own = F.col("_base"), F.col("_inside")
    total = F.when(base.isNull() & own.isNull(), None).otherwise(F.coalesce(base, F.lit(0)) + F.coalesce(own, F.lit(0)))
    # one row for each range: there are as many as the table has parts of `rows` rows
    return table.withColumn("_inside", inside).join(bases, PART).withColumn(name, total).drop(PART, "_inside", "_base")


def row_numbers(df: DataFrame, order: list, name: str, rows: int = 500_000) -> DataFrame:
    """df with `name`: its 1-based place in the order, which must be of no ties."""
    numbered = running_sum(ranged(df, *order, rows=rows), order, F.lit(1), name)
    return numbered.withColumn(name, F.coalesce(F.col(name), F.lit(0)).cast("long") + 1)


def members_around(members: DataFrame, asked: DataFrame, rows: int = 500_000) -> DataFrame:
    """x, next_geq, next_gt and prev_leq of every asked x: the members at or after, after, and at or before it.

    Both have a column x; each range takes its own windows, and what lies beyond comes from the ranges'
    smallest and largest members. A null x has none of them, and a null member counts for nothing.
    """
    both = members.where("x is not null").select("x", F.col("x").alias("member")).unionByName(asked.select("x", F.lit(None).cast(dict(members.dtypes)["x"]).alias("member")))
    table = ranged(both, "x", rows=rows)  # rows of equal x lie in one range
    over = Window.orderBy(PART)
    ends = table.groupBy(PART).agg(F.min("member").alias("lo"), F.max("member").alias("hi"))
    ends = ends.select(
        PART,
        F.first("lo", ignorenulls=True).over(over.rowsBetween(1, Window.unboundedFollowing)).alias("after"),
        F.last("hi", ignorenulls=True).over(over.rowsBetween(Window.unboundedPreceding, -1)).alias("before"),
    )
    # frames that grow from the first row on; those that end with the last one are summed up anew for every row
    up, down = Window.partitionBy(PART).orderBy("x"), Window.partitionBy(PART).orderBy(F.desc("x"))
    inside = table.select(
        "*",
        F.min("member").over(down.rangeBetween(Window.unboundedPreceding, 0)).alias("geq"),
        F.min("member").over(down.rangeBetween(Window.unboundedPreceding, -1)).alias("gt"),
        F.max("member").over(up.rangeBetween(Window.unboundedPreceding, 0)).alias("leq"),
    )
    pick = lambda own, beyond: F.when(F.col("x").isNotNull(), F.coalesce(own, beyond))
    return (
        inside.where("member is null")
        .join(ends, PART)
        .select("x", pick("geq", "after").alias("next_geq"), pick("gt", "after").alias("next_gt"), pick("leq", "before").alias("prev_leq"))
    )

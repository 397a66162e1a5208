"""Rows in ascending parts of bounded size, and where each part's share of a group starts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlift.sources.stages import stage

PART = "__part"


def in_parts(rows: DataFrame, order: list[Column], *, part_rows: int, name: str) -> DataFrame:
    """``rows`` in ranges of about ``part_rows`` rows that ascend by ``order``, written with the part's number.

    ``rows`` should be a written table, as it is read once for its range bounds. Equal keys
    are spread by a mark of the row, so a key on a third of all rows fills many parts.
    Part numbers are written, so a repeated task finds the same parts.
    """
    parts = max(1, -(-rows.count() // part_rows))
    dealt = rows.withColumn("__mark", F.monotonically_increasing_id())
    dealt = dealt.repartitionByRange(parts, *order, F.col("__mark")).withColumn(PART, F.spark_partition_id())
    return stage(dealt.drop("__mark"), name)


def spans(placed: DataFrame, group: str, *measures: Column) -> DataFrame:
    """(__part, group, n, first, total, tree): the share of each group in each part.

    first counts the group's rows in the parts before, total all of its rows, and tree
    numbers the groups in ascending order from 0. Aliased aggregates in ``measures`` are
    added. No window holds more rows than there are parts.
    """
    counted = placed.groupBy(PART, group).agg(F.count(F.lit(1)).alias("n"), *measures)
    earlier = Window.partitionBy(group).orderBy(PART)
    known = counted.withColumns({
        "first": F.sum("n").over(earlier) - F.col("n"),
        "total": F.sum("n").over(Window.partitionBy(group)),
        "__starts": (F.row_number().over(earlier) == 1).cast("long")})
    inside = Window.partitionBy(PART).orderBy(F.col(group).asc_nulls_first())
    known = known.withColumn("__upto", F.sum("__starts").over(inside))
    parts = known.groupBy(PART).agg(F.sum("__starts").alias("__own"))
    before = parts.select(PART, (F.sum("__own").over(Window.orderBy(PART)) - F.col("__own")).alias("__before"))
    return known.join(before, PART).withColumn("tree", F.col("__before") + F.col("__upto") - 1).drop(
        "__starts", "__upto", "__before")

"""Joining rows back to per-group facts when one group may hold most of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlift.operators.ordered import PART, in_parts, spans
from ledgerlift.sources.stages import stage

HEAVY_GROUPS = 256
HEAVY_ROWS = 20_000
SALTS = 32


def heavy_keys(groups: DataFrame, key: str, size: str) -> DataFrame:
    """At most 256 keys, the largest with 20,000 rows or more; safe to broadcast at any scale."""
    return (
        groups.filter(F.col(size) >= HEAVY_ROWS).groupBy(key).agg(F.max(size).alias("_n"))
        .orderBy(F.col("_n").desc(), F.col(key)).limit(HEAVY_GROUPS)
        .select(key, F.lit(True).alias("_heavy"))
    )


def meet(left: DataFrame, right: DataFrame, on: str | list[str], how: str = "inner") -> DataFrame:
    """A join of two tables that both grow with the rows: each side is shuffled at every size.

    Below the broadcast limit Spark would collect one side in the driver, and the many joins of
    a job add up there; a merge join sends the driver nothing but task metrics.
    """
    return left.join(right.hint("merge"), on, how)


def join_to_groups(rows: DataFrame, groups: DataFrame, key: str, size: str, spread: str,
                   known_rows: int | None = None) -> DataFrame:
    """``rows`` joined to ``groups`` (one or few rows per key) without a hot task.

    ``known_rows``, where the caller has counted the rows, skips the salting when no key
    can be heavy.

    The largest groups are known from ``size``, their row count, which stays in the result.
    Their rows are spread over 32 salts by ``spread`` and the group side repeats once per
    salt; all other keys use salt 0.
    """
    if known_rows is not None and known_rows < HEAVY_ROWS:
        return rows.join(groups, key)
    heavy = F.broadcast(heavy_keys(groups, key, size))
    salt = F.when(F.col("_heavy"), F.pmod(F.xxhash64(spread), F.lit(SALTS)).cast("int")).otherwise(0)
    salts = F.when(F.col("_heavy"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    left = rows.join(heavy, key, "left").withColumn("_salt", salt).drop("_heavy")
    right = groups.join(heavy, key, "left").withColumn("_salt", F.explode(salts)).drop("_heavy")
    return meet(left, right, [key, "_salt"]).drop("_salt")


LIST_LENGTH = 1000


def list_in_parts(rows: DataFrame, sizes: DataFrame, key: str, size: str, order: str, entry: str,
                  out: str, length: int = LIST_LENGTH, part_rows: int = 65_536) -> DataFrame:
    """(key, size, part, out): the entries of each group as text, in order, ``length`` to a part.

    Part k holds the entries of rank k * length onwards, so a group of any size has the
    same row shape and reading its parts in turn gives the whole list in order. Ranks come
    from ascending ranges of rows and prefix sums over them: no task holds a group. Equal
    entries of a group follow each other in no order of their own.
    """
    listed = stage(rows.select(F.col(key).alias("__key"), F.col(order).alias("__order"), F.col(entry).alias("__entry")).join(
        sizes.select(F.col(key).alias("__key")), "__key", "left_semi"), "list-rows")
    placed = in_parts(listed, [F.col("__key"), F.col("__order")], part_rows=part_rows, name="list-ranges")
    starts = spans(placed, "__key").select(PART, "__key", "first")
    inside = Window.partitionBy(PART, "__key").orderBy("__order", "__entry")
    ranked = placed.withColumn("__place", F.row_number().over(inside)).join(starts, [PART, "__key"]).withColumn(
        "part", F.floor((F.col("first") + F.col("__place") - 1) / length).cast("int"))
    texts = ranked.groupBy("__key", "part").agg(F.array_join(
        F.transform(F.sort_array(F.collect_list(F.struct(F.col("__order").alias("o"), F.col("__entry").alias("e")))),
                    lambda s: s["e"]), ", ").alias(out))
    return texts.join(sizes.select(F.col(key).alias("__key"), size), "__key").select(
        F.col("__key").alias(key), size, "part", out)

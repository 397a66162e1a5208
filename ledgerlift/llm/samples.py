"""Bounded, repeatable samples of labelled rows for fitting classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def fold(key: str, folds: int) -> Column:
    """crc32 of the key as text, modulo ``folds``; a null key counts as empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % folds


def sampled_keys(rows: DataFrame, *, key: str, label: str, per_label: int) -> DataFrame:
    """At most ``per_label`` different (key, label) of each label that is not null, by a hash of the key.

    The labels' counts tell below which hash about twice as many keys of a label lie; only
    those are ranked, so no task gets more of a label than that, however many tasks there
    are. A key with several labels keeps the largest.
    """
    once = rows.filter(F.col(label).isNotNull() & F.col(key).isNotNull()).groupBy(key).agg(F.max(label).alias(label))
    # a row a label; the share of keys to rank, as a bound on their hash
    share = F.least(F.lit(1.0), F.lit(2.0 * per_label + 64) / F.count(F.lit(1)))
    bounds = once.groupBy(label).agg((share * 2.0 ** 64 - 2.0 ** 63).alias("__bound"))
    once = once.join(F.broadcast(bounds), label).filter(F.xxhash64(key).cast("double") <= F.col("__bound")).drop("__bound")
    order = Window.partitionBy(label).orderBy(F.xxhash64(key), key)
    return once.withColumn("__rank", F.row_number().over(order)).filter(F.col("__rank") <= per_label).drop("__rank")


def sampled_texts(docs: DataFrame, keys: DataFrame, *, key: str, label: str, text: str, most: int) -> DataFrame:
    """(label, text) of the sampled keys, at most ``most`` rows even if keys repeat.

    ``keys`` is bounded by the sample's size, so it is broadcast and the texts stay where they are.
    """
    chosen = keys.select(F.col(key).alias("__key"), F.col(label).alias("__label"))
    return docs.join(F.broadcast(chosen), docs[key] == chosen["__key"]).select(
        F.col("__label").alias("label"), F.coalesce(F.col(text), F.lit("")).alias("text")).limit(most)

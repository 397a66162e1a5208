"""Casts, money sums and row hashes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

_INTEGERS = {"bigint", "int", "integer", "smallint", "tinyint", "long"}
MONEY = "decimal(28,2)"  # of a total, which is rounded once
EXACT = "decimal(28,8)"  # of the values that are added up


def cast_to(c: Column, sql_type: str, lenient: bool = False) -> Column:
    """Cast; fractions round to the nearest integer (halves away from zero) instead of truncating.

    Strict (default) fails on text that is no value of the type, lenient gives NULL.
    """
    kind = sql_type.strip().lower()
    kind = {"varchar": "string", "text": "string"}.get(kind, kind)
    if kind in _INTEGERS:
        # whole numbers take the direct route: a decimal detour would cost every row
        whole = c.try_cast(kind) if lenient else c.cast(kind)
        number = c.try_cast("decimal(38,10)") if lenient else c.cast("decimal(38,10)")
        return F.when(F.typeof(c).isin("bigint", "int", "smallint", "tinyint"), whole).otherwise(
            F.round(number, 0).try_cast(kind) if lenient else F.round(number, 0).cast(kind)
        )
    return c.try_cast(kind) if lenient else c.cast(kind)


def money_sum(c: Column) -> Column:
    """Sum in exact decimals, so the order of the rows cannot change it; only the sum is rounded."""
    return F.coalesce(F.sum(c.cast(EXACT)), F.lit(0).cast(EXACT)).cast(MONEY)


def row_hash(columns: Sequence[Column]) -> tuple[Column, Column]:
    """Two 64-bit hashes over (value, is-null) pairs; (1, NULL, 'a') and (1, 'a', NULL) differ.

    Two plain numbers rather than a struct keep aggregates over them in the hash aggregate.
    """
    parts: list[Column] = []
    for c in columns:
        parts += [c, c.isNull()]
    return F.xxhash64(*parts), F.xxhash64(F.lit(7), *reversed(parts))

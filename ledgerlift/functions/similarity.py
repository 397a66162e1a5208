"""Similarity of two strings."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

METRICS = ("ratio", "levenshtein")


def _ratio_udf():
    # a nested function travels to the executors by value, so they need no copy of this package
    def score(left: pd.Series, right: pd.Series) -> pd.Series:
        from difflib import SequenceMatcher

        out = []
        for a, b in zip(left, right):
            out.append(SequenceMatcher(None, a, b).ratio() if a is not None and b is not None else None)
        return pd.Series(out, dtype="float64")

    return F.pandas_udf(score, "double")


def similarity(a: Column, b: Column, metric: str = "ratio") -> Column:
    """``ratio``: twice the characters in matching blocks over all characters (Arrow batches).

    It is not symmetric: callers pass the name of the earlier row first.
    ``levenshtein``: one minus twice the edit distance over all characters (JVM only).
    """
    if metric == "levenshtein":
        total = F.length(a) + F.length(b)
        return F.when(total == 0, F.lit(1.0)).otherwise(1 - 2.0 * F.levenshtein(a, b) / total)
    if metric != "ratio":
        raise ValueError(f"metric {metric!r} is not one of {', '.join(METRICS)}")
    return _ratio_udf()(a, b)


def edit_budget(len_a: Column, len_b: Column, threshold: float) -> Column:
    """Most inserts plus deletes two strings of these lengths can be apart at ``threshold``.

    Both metrics obey it. The distance has the parity of the summed lengths; the small
    constant keeps (1 - 0.9) * 20 from landing just under 2.
    """
    total = len_a + len_b
    k = F.floor((1.0 - threshold) * total + 1e-9).cast("int")
    return k - F.pmod(total - k, F.lit(2))

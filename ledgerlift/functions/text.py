"""Text expressions; all of them stay in the JVM."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# (?U) makes \s cover Unicode spaces such as the non-breaking one
_EDGE_SPACE = r"(?U)^\s+|\s+$"
_SPACES = r"(?U)\s+"
_EDGE_MARKS = r"^[.,]+|[.,]+$"


def is_blank(c: Column) -> Column:
    """NULL, or only spaces once written as text.

    Only text can be blank without being NULL; the optimizer folds the type test, so other
    types are never written as text.
    """
    return c.isNull() | ((F.typeof(c) == "string") & (F.trim(c.cast("string")) == ""))


def strip_space(c: Column) -> Column:
    return F.regexp_replace(c, _EDGE_SPACE, "")


def name_tokens(c: Column, drop: Sequence[str]) -> Column:
    """Lower-case tokens without edge dots and commas; words in ``drop`` go wherever they stand."""
    stripped = strip_space(c)
    tokens = F.transform(
        F.split(stripped, _SPACES),
        lambda t: F.lower(F.regexp_replace(t, _EDGE_MARKS, "")),
    )
    kept = F.filter(tokens, lambda t: ~t.isin(*drop))
    return F.when(stripped == "", F.array().cast("array<string>")).otherwise(kept)


def spaced(column_name: str) -> str:
    """A column name as words."""
    return column_name.replace("_", " ")


def percent_text(score: Column) -> Column:
    """0.925 -> '92%': no decimals, halves to even."""
    return F.concat(F.bround(score * 100, 0).cast("int").cast("string"), F.lit("%"))

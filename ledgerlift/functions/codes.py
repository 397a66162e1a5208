"""Repair of codes that are recorded in several formats."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerlift.functions.text import is_blank

_TO_END = 2**31 - 1


@dataclass(frozen=True)
class CodeFormat:
    """A canonical pattern and the drifted patterns that can be repaired.

    ``repairs`` holds (pattern, number of leading characters to drop, prefix to add).
    Patterns end in ``\\z``: ``$`` would also accept a trailing line break.
    """

    canonical: str
    repairs: tuple[tuple[str, int, str], ...] = ()

    def matches(self, c: Column) -> Column:
        return c.rlike(self.canonical)

    def normalise(self, c: Column) -> Column:
        """Blank becomes NULL, known drift is repaired, anything else is left as it is."""
        out = F.when(is_blank(c), F.lit(None).cast("string")).when(self.matches(c), c)
        for pattern, drop, prefix in self.repairs:
            tail = F.substring(c, drop + 1, _TO_END)
            out = out.when(c.rlike(pattern), F.concat(F.lit(prefix), tail))
        return out.otherwise(c)

    def state(self, c: Column) -> Column:
        """left_null, already_canonical, fixed or unrecognised."""
        return (
            F.when(is_blank(c), "left_null")
            .when(self.matches(c), "already_canonical")
            .when(self.matches(self.normalise(c)), "fixed")
            .otherwise("unrecognised")
        )


# --- fixed values: cost centre formats --------------------------------------
COST_CENTRE = CodeFormat(
    canonical=r"^CC-[0-9]{3}\z",
    repairs=(
        (r"^[0-9]{3}\z", 0, "CC-"),
        (r"^C[0-9]{3}\z", 1, "CC-"),
    ),
)
# ----------------------------------------------------------------------------

"""Migration policy: which rows stay behind and which move with a flag."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ledgerlift.operators.issues import open_rows
from ledgerlift.schemas import require_issue_type
from ledgerlift.sources.spec import DomainSpec

HOLD, FLAG = "hold", "flag"

# --- fixed values: the default policy; types not listed migrate as clean -------
POLICY = (
    ("obsolete_orphaned", HOLD),
    ("accuracy", HOLD),
    ("completeness", FLAG),
    ("duplication", FLAG),
)
# -------------------------------------------------------------------------------


def with_action(issue_rows: DataFrame, policy: Sequence[tuple[str, str]] = POLICY) -> DataFrame:
    """Open issues with the action of their type; the policy is a list of at most one entry per type."""
    for issue_type, action in policy:
        require_issue_type(issue_type)
        if action not in (HOLD, FLAG):
            raise ValueError(f"action {action!r} is neither {HOLD} nor {FLAG}")
    table = F.broadcast(issue_rows.sparkSession.createDataFrame(list(policy), "issue_type string, action string"))
    return open_rows(issue_rows).join(table, "issue_type")


def held_rows(issue_rows: DataFrame, policy: Sequence[tuple[str, str]] = POLICY) -> DataFrame:
    """(domain, table_name, row_identifier, issue_id, finding_id, reason): one row per holding issue."""
    return with_action(issue_rows, policy).filter(F.col("action") == HOLD).select(
        "domain", "table_name", "row_identifier", "issue_id", "finding_id",
        F.concat("issue_type", F.lit(": "), "finding").alias("reason"))


def flagged_rows(issue_rows: DataFrame, policy: Sequence[tuple[str, str]] = POLICY) -> DataFrame:
    """(table_name, row_identifier, finding_id, issue_id): the first flagging issue of a row, by number."""
    return (
        with_action(issue_rows, policy).filter(F.col("action") == FLAG)
        .groupBy("table_name", "row_identifier")
        .agg(F.min(F.struct("finding_id", "issue_id")).alias("i"))
        .select("table_name", "row_identifier", "i.finding_id", "i.issue_id")
    )


def row_actions(issue_rows: DataFrame, policy: Sequence[tuple[str, str]] = POLICY) -> DataFrame:
    """(table_name, row_identifier, held, issue_id): both decisions per row from one aggregate."""
    flag = F.when(F.col("action") == FLAG, F.struct("finding_id", "issue_id"))
    return (
        with_action(issue_rows, policy)
        .groupBy("table_name", "row_identifier")
        .agg(F.bool_or(F.col("action") == HOLD).alias("held"), F.min(flag).alias("i"))
        .select("table_name", "row_identifier", "held", F.col("i.issue_id").alias("issue_id"))
    )


def migrate(mapped: DataFrame, spec: DomainSpec, row_id: str, actions: DataFrame,
            seen: Observation | None = None) -> DataFrame:
    """Mapped rows without the held ones, with migration_status and issue_id.

    One join serves both decisions. ``actions`` is unique per row, so no key is hot; read
    from a stage, its size decides between broadcast and shuffle. A missing id is an id like
    any other: an action on a row without id holds or flags all rows without id. ``seen``
    counts the rows that come in (source_rows), those held (held_rows) and those that move
    with a flag (flagged_rows) in the pass that writes the result.
    """
    key = spec.target_of(row_id)
    own = actions.filter(F.col("table_name") == spec.source_table).select(
        F.col("row_identifier").alias("_id"), "held", "issue_id")
    held = F.coalesce(F.col("held"), F.lit(False))
    joined = mapped.join(own, mapped[key].eqNullSafe(own["_id"]), "left")
    if seen is not None:
        joined = joined.observe(
            seen, F.count(F.lit(1)).alias("source_rows"), F.count_if(held).alias("held_rows"),
            F.count_if(~held & F.col("issue_id").isNotNull()).alias("flagged_rows"))
    return joined.filter(~held).select(
        *mapped.columns,
        F.when(F.col("issue_id").isNotNull(), "migrated_with_flag").otherwise("clean").alias("migration_status"),
        "issue_id",
    )

"""Profiling checks.

Every check returns findings. Row rules of one table are evaluated in a single scan: the
rules become one array per row, and only rows that break some rule are expanded.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlift.functions.codes import COST_CENTRE, CodeFormat
from ledgerlift.functions.text import is_blank, spaced
from ledgerlift.schemas import (
    CONFIDENCES, CURRENCIES, DOMAINS, EARLIEST_DATE, FINDING_COLUMNS, ISSUE_TYPES, Domain,
    require_issue_type,
)
from ledgerlift.sources.stages import stage, unstage

# numbering groups, in the order in which checks are reported
ORDER = {
    "null_check": 1, "negative_value": 2, "invalid_currency": 3, "date_out_of_bounds": 4,
    "cost_centre_format_drift": 5, "status_date_contradiction": 6, "exact_name_match": 7,
    "name_abbreviation": 8, "fuzzy_name_match": 9, "company_suffix_match": 10, "orphan_fk": 11,
}


@dataclass(frozen=True)
class RowRule:
    """A predicate over one row and the finding it raises."""

    breaks: Column
    column: str
    issue_type: str
    description: Column
    confidence: str
    rule: str

    def __post_init__(self) -> None:
        require_issue_type(self.issue_type)
        if self.confidence not in CONFIDENCES:
            raise ValueError(f"confidence {self.confidence!r} is not one of {', '.join(CONFIDENCES)}")


def findings_from(
    df: DataFrame, domain: str, table: str, column: str, row_id: str | Column, issue_type: str,
    description: Column, confidence: str, rule: str,
) -> DataFrame:
    """Project any DataFrame of offending rows to the findings schema."""
    require_issue_type(issue_type)
    row_id = F.col(row_id) if isinstance(row_id, str) else row_id
    return df.select(
        F.lit(ORDER.get(rule, 99)).alias("check_order"),
        F.lit(domain).alias("domain"),
        F.lit(table).alias("table_name"),
        F.lit(column).alias("column_name"),
        row_id.cast("string").alias("row_identifier"),
        F.lit(issue_type).alias("issue_type"),
        description.alias("description"),
        F.lit(confidence).alias("confidence"),
        F.lit(rule).alias("detection_rule"),
    )


def apply_rules(df: DataFrame, domain: Domain, rules: Sequence[RowRule]) -> DataFrame:
    """All row rules of a table in one scan."""
    hits = [
        F.when(
            r.breaks,
            F.struct(
                F.lit(ORDER.get(r.rule, 99)).alias("check_order"),
                F.lit(r.column).alias("column_name"),
                F.lit(r.issue_type).alias("issue_type"),
                r.description.alias("description"),
                F.lit(r.confidence).alias("confidence"),
                F.lit(r.rule).alias("detection_rule"),
            ),
        )
        for r in rules
    ]
    # clean rows leave before any array is built; the predicate also reaches the scan
    broken = df.filter(reduce(lambda a, b: a | b, [r.breaks for r in rules]))
    return broken.select(
        F.col(domain.row_id).cast("string").alias("row_identifier"),
        F.inline(F.filter(F.array(*hits), lambda h: h.isNotNull())),
    ).select(
        "check_order",
        F.lit(domain.label).alias("domain"),
        F.lit(domain.table).alias("table_name"),
        "column_name", "row_identifier", "issue_type", "description", "confidence",
        "detection_rule",
    )


# --- rule builders; the wording of the descriptions is fixed ------------------


def blank_rules(columns: Iterable[str]) -> list[RowRule]:
    return [
        RowRule(is_blank(F.col(c)), c, "completeness",
                F.lit(f"{spaced(c)} is missing (blank) on this record."), "high", "null_check")
        for c in columns
    ]


def negative_rule(column: str = "quantity", label: str = "PO quantity") -> RowRule:
    value = F.col(column)
    return RowRule(
        value < 0, column, "accuracy",
        F.concat(F.lit(f"{spaced(column).capitalize()} is negative ("), value.cast("string"),
                 F.lit(f") - not a valid {label}.")),
        "high", "negative_value",
    )


def allowed_values_rule(column: str = "currency", allowed: Sequence[str] = CURRENCIES) -> RowRule:
    value = F.col(column)
    listed = "[" + ", ".join(f"'{v}'" for v in sorted(allowed)) + "]"
    return RowRule(
        value.isNotNull() & ~value.isin(*allowed), column, "accuracy",
        F.concat(F.lit("Currency code '"), value,
                 F.lit(f"' is not a recognised code (expected one of {listed}) - likely a typo.")),
        "high", "invalid_currency",
    )


def date_range_rules(columns: Iterable[str], as_of: date, earliest: date = EARLIEST_DATE) -> list[RowRule]:
    out = []
    for c in columns:
        value = F.col(c)
        out.append(RowRule(
            value.isNotNull() & ((value < F.lit(earliest)) | (value > F.lit(as_of))), c, "accuracy",
            F.concat(F.lit(f"{spaced(c)} ("), value.cast("string"),
                     F.lit(f") falls outside the plausible range ({earliest.isoformat()} to today).")),
            "medium", "date_out_of_bounds",
        ))
    return out


def format_rule(column: str = "cost_centre", code: CodeFormat = COST_CENTRE) -> RowRule:
    value = F.col(column)
    return RowRule(
        value.isNotNull() & (value != "") & ~code.matches(value), column, "consistency",
        F.concat(F.lit(f"{column} is stored as '"), value,
                 F.lit("', which doesn't match the standard 'CC-0NN' format used elsewhere - "
                       "likely the same cost centre recorded in a different format.")),
        "high", "cost_centre_format_drift",
    )


def contradiction_rule(as_of: date) -> RowRule:
    ended = F.col("termination_date")
    return RowRule(
        (F.col("employment_status") == "Active") & ended.isNotNull() & (ended < F.lit(as_of)),
        "employment_status", "consistency",
        F.concat(F.lit("Employee is marked 'Active' but has a termination_date in the past ("),
                 ended.cast("string"), F.lit(") - contradictory record.")),
        "high", "status_date_contradiction",
    )


def standard_rules(key: str, as_of: date, earliest: date = EARLIEST_DATE) -> list[RowRule]:
    """Every single-table rule of a domain."""
    domain = DOMAINS[key]
    rules = blank_rules(domain.required)
    if key == "procurement":
        rules.append(negative_rule())
    if key in ("finance", "expenses"):
        rules.append(allowed_values_rule())
    rules += date_range_rules(domain.dates, as_of, earliest)
    rules.append(format_rule())
    if key == "hr":
        rules.append(contradiction_rule(as_of))
    return rules


def not_in_reference(df: DataFrame, column: str, reference: DataFrame, reference_column: str) -> DataFrame:
    """Rows whose value is missing from a reference list too long to inline.

    Only distinct keys are shuffled; the list of unknown values is staged so that its
    size decides between a broadcast and a shuffle join.
    """
    return orphans(df, column, reference, reference_column)


# --- referential checks -------------------------------------------------------


def orphans(fact: DataFrame, key: str, master: DataFrame, master_key: str,
            include_null: bool = False) -> DataFrame:
    """Rows of ``fact`` whose key is not in ``master``.

    Both sides shrink to distinct keys before anything is shuffled, so a key on a third of
    all rows costs one row per task. The unknown keys are staged: small ones are broadcast
    to the fact scan by their real size, and a long list falls back to a shuffle join.
    """
    known = master.select(F.col(master_key).alias(key)).filter(F.col(key).isNotNull()).distinct()
    used = fact.select(key).filter(F.col(key).isNotNull()).distinct()
    unknown = stage(used.join(known, key, "left_anti"), "unknown-keys")
    out = fact.join(unknown, key, "left_semi")
    if include_null:
        # the two branches cannot overlap: a NULL key never equals an unknown key
        out = out.unionByName(fact.filter(F.col(key).isNull()).select(*out.columns))
    return out


def orphan_vendor_findings(finance: DataFrame, procurement: DataFrame) -> DataFrame:
    d = DOMAINS["finance"]
    rows = orphans(finance.select(d.row_id, "vendor_id"), "vendor_id", procurement, "vendor_id")
    text = F.concat(F.lit("References vendor_id '"), F.col("vendor_id"),
                    F.lit("', which does not exist anywhere in Procurement - orphaned reference."))
    return findings_from(rows, d.label, d.table, "vendor_id", d.row_id, "obsolete_orphaned",
                         text, "high", "orphan_fk")


def orphan_employee_findings(expenses: DataFrame, hr: DataFrame) -> DataFrame:
    d = DOMAINS["expenses"]
    rows = orphans(expenses.select(d.row_id, "employee_id"), "employee_id", hr, "employee_id")
    text = F.concat(F.lit("References employee_id '"), F.col("employee_id"),
                    F.lit("', which does not exist in HR - likely a leaver whose record was "
                          "never deactivated or reassigned."))
    return findings_from(rows, d.label, d.table, "employee_id", d.row_id, "obsolete_orphaned",
                         text, "high", "orphan_fk")


# --- rates, numbering, summaries ----------------------------------------------


def blank_rates(df: DataFrame, domain: Domain, columns: Sequence[str] | None = None) -> DataFrame:
    """Missing count, total and percent per column, from one pass over the table."""
    columns = list(columns or domain.required)
    counts = df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        *[F.count_if(is_blank(F.col(c))).alias(f"n_{i}") for i, c in enumerate(columns)],
    )
    rows = F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"n_{i}").alias("missing_rows"))
        for i, c in enumerate(columns)
    ])
    return counts.select("total_rows", F.inline(rows)).select(
        F.lit(domain.table).alias("table_name"), "column_name", "missing_rows", "total_rows",
        F.when(F.col("total_rows") > 0, F.col("missing_rows") * 100.0 / F.col("total_rows"))
        .otherwise(0.0).alias("missing_percent"),
    )


def collect_findings(parts: Sequence[DataFrame]) -> DataFrame:
    """Union of checks, each finding with a key that survives a rebuild.

    A missing value has a mark of its own in the key, so it does not move the values after it.
    """
    union = reduce(DataFrame.unionByName, [p.select(*FINDING_COLUMNS) for p in parts])
    names = ("table_name", "column_name", "row_identifier", "detection_rule", "description")
    key = F.sha2(F.concat_ws("\u001f", *[F.coalesce(F.concat(F.lit("="), c), F.lit("-")) for c in names]), 256)
    return union.withColumn("finding_key", key)


def number_findings(findings: DataFrame) -> DataFrame:
    """Add finding_id 1..n in check order, then table, column, row and description.

    A distributed sort is written once with each row's place inside its task; the ids are
    that place plus the rows of the tasks before it. The only unpartitioned window runs
    over one row per task.
    """
    order = ["check_order", "table_name", "column_name", "row_identifier", "description"]
    # a sort reads its input twice (range bounds, then rows), so the checks run before it
    unsorted = stage(findings, "findings-unsorted")
    ranged = unsorted.orderBy(*order)
    placed = stage(
        ranged.withColumn("task", F.spark_partition_id()).withColumn(
            "place", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))),
        "findings",
    )
    unstage(unsorted, "findings-unsorted")
    sizes = placed.groupBy("task").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    numbered = placed.join(F.broadcast(offsets), "task")
    return numbered.select(
        (F.col("offset") + F.col("place") + 1).cast("bigint").alias("finding_id"),
        *FINDING_COLUMNS[1:], "finding_key",
    )


def findings_pivot(findings: DataFrame, types: Sequence[str] = ISSUE_TYPES) -> DataFrame:
    """Domain by issue type with row and column totals."""
    counts = [F.count_if(F.col("issue_type") == t).alias(t) for t in types]
    return (
        findings.rollup("domain")
        .agg(*counts, F.count(F.lit(1)).alias("total"), F.grouping("domain").alias("is_total"))
        .select(F.when(F.col("is_total") == 1, "Total").otherwise(F.col("domain")).alias("domain"),
                *types, "total")
    )


def domain_counts(findings: DataFrame) -> DataFrame:
    return findings.groupBy("domain").agg(F.count(F.lit(1)).alias("findings"))


def findings_of(findings: DataFrame, domain: str) -> DataFrame:
    return findings.filter(F.col("domain") == domain)

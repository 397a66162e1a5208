"""Spec-driven mapping and its validation."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlift.functions.codes import COST_CENTRE, CodeFormat
from ledgerlift.functions.values import cast_to
from ledgerlift.operators.checks import orphans
from ledgerlift.sources.spec import DomainSpec

CODES = {"cost_centre": COST_CENTRE}


def mapped_columns(spec: DomainSpec, codes: Mapping[str, CodeFormat] = CODES,
                   lenient: bool = False) -> list[Column]:
    """The target columns as expressions over the source; unlisted columns are dropped."""
    out = []
    for c in spec.columns:
        source = F.col(c.source)
        if c.source in codes:
            value = codes[c.source].normalise(source.cast("string"))
        else:
            value = cast_to(source, c.sql_type, lenient)
        out.append(value.alias(c.target))
    return out


def map_table(df: DataFrame, spec: DomainSpec, codes: Mapping[str, CodeFormat] = CODES,
              lenient: bool = False) -> DataFrame:
    return df.select(*mapped_columns(spec, codes, lenient))


def failed_casts(df: DataFrame, spec: DomainSpec) -> DataFrame:
    """(column_name, failed): values a lenient mapping turns into NULL, from one pass."""
    names = [c for c in spec.columns if c.source not in CODES]
    counts = df.agg(*[
        F.count_if(F.col(c.source).isNotNull() & cast_to(F.col(c.source), c.sql_type, True).isNull()).alias(f"n_{i}")
        for i, c in enumerate(names)])
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(c.source).alias("column_name"), F.col(f"n_{i}").alias("failed"))
        for i, c in enumerate(names)])))


def require_equal_counts(source: DataFrame, mapped: DataFrame, name: str) -> int:
    """A projection never adds or drops rows; raise when the written table says otherwise."""
    before, after = source.count(), mapped.count()
    if before != after:
        raise RuntimeError(f"{name} has {after} rows, its source {before}")
    return after


def code_stats(df: DataFrame, table: str, column: str = "cost_centre", code: CodeFormat = COST_CENTRE) -> DataFrame:
    """already_canonical, fixed, left_null and unrecognised values, from one aggregate."""
    state = code.state(F.col(column))
    return df.select(state.alias("state")).agg(*[
        F.count_if(F.col("state") == s).alias(s)
        for s in ("already_canonical", "fixed", "left_null", "unrecognised")
    ]).select(F.lit(table).alias("table_name"), "*")


def orphan_vendors(mapped_finance: DataFrame, vendor_master: DataFrame) -> DataFrame:
    return orphans(mapped_finance.select("gl_entry_id", "vendor_id"), "vendor_id", vendor_master, "vendor_id")


def orphan_employees(mapped_expenses: DataFrame, mapped_hr: DataFrame) -> DataFrame:
    return orphans(mapped_expenses.select("expense_id", "employee_id"), "employee_id", mapped_hr, "employee_id")


def odd_codes(mapped: Mapping[str, DataFrame], column: str = "cost_centre", code: CodeFormat = COST_CENTRE) -> DataFrame:
    """(table_name, code): distinct values outside the canonical format, per mapped table."""
    parts = [
        df.filter(F.col(column).isNotNull() & ~code.matches(F.col(column)))
        .select(F.lit(f"target_{key}").alias("table_name"), F.col(column).alias("code")).distinct()
        for key, df in mapped.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def with_issue(failures: DataFrame, row_id: str, table: str, issue_rows: DataFrame) -> DataFrame:
    """Failures with the first issue of their row, or 'not tracked'."""
    first = (
        issue_rows.filter(F.col("table_name") == table)
        .groupBy(F.col("row_identifier").alias(row_id))
        .agg(F.min(F.struct("finding_id", "issue_id", "status")).alias("i"))
    )
    return failures.join(first, row_id, "left").select(
        *failures.columns, F.col("i.issue_id").alias("issue_id"),
        F.coalesce("i.status", F.lit("not tracked")).alias("issue_status"))


def derived_status(ended: Column, as_of: date) -> Column:
    """Employment status follows from the termination date alone."""
    return F.when(ended.isNull() | (ended > F.lit(as_of)), "Active").otherwise("Terminated")


def validation_report(mapped: Mapping[str, DataFrame], sources: Mapping[str, DataFrame],
                      consolidation: DataFrame, fk_vendor: DataFrame, fk_employee: DataFrame,
                      issues: DataFrame) -> DataFrame:
    """(section, check, status, value): one row per figure of the validation report."""
    n = F.count(F.lit(1))

    def rows(df: DataFrame, section: str, check: str | Column, status: str | Column, value: Column) -> DataFrame:
        as_col = lambda x: F.lit(x) if isinstance(x, str) else x
        return df.select(F.lit(section).alias("section"), as_col(check).alias("check"),
                         as_col(status).alias("status"), value.cast("bigint").alias("value"))

    parts = []
    for key, df in mapped.items():
        parts.append(rows(df.agg(n.alias("n")), "row_count", f"target_{key}", "INFO", F.col("n")))
        stats = code_stats(sources[key], f"target_{key}")
        figures = F.inline(F.array(*[
            F.struct(F.lit(s).alias("state"), F.col(s).alias("n"))
            for s in ("already_canonical", "fixed", "left_null", "unrecognised")]))
        parts.append(rows(stats.select("table_name", figures), "cost_centre",
                          F.concat_ws(".", "table_name", "state"), "INFO", F.col("n")))
    parts.append(rows(consolidation, "vendors", "consolidated", "INFO", F.col("vendors")))
    parts.append(rows(consolidation, "vendors", "raw_variants", "INFO", F.col("raw_variants")))
    verdict = F.when(F.col("n") == 0, "PASS").otherwise("FAIL")
    parts.append(rows(fk_vendor.agg(n.alias("n")), "referential", "target_finance.vendor_id", verdict, F.col("n")))
    parts.append(rows(fk_employee.agg(n.alias("n")), "referential", "target_expenses.employee_id", verdict, F.col("n")))
    parts.append(rows(odd_codes(mapped).agg(n.alias("n")), "consistency", "cost_centre", verdict, F.col("n")))
    parts.append(rows(issues.groupBy("status").agg(n.alias("n")), "issues", F.col("status"), "INFO", F.col("n")))
    return reduce(DataFrame.unionByName, parts)



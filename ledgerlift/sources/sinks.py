"""Sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# --- fixed values: the ten headings of a problem statement, with their columns ---
STATEMENT_FIELDS = (
    ("Issue ID", "issue_id"),
    ("Domain", "domain"),
    ("Table", "table_name"),
    ("Column", "column_name"),
    ("Issue Type", "issue_type"),
    ("Description", "description"),
    ("Root Cause (hypothesis)", "root_cause"),
    ("Business Impact", "business_impact"),
    ("Status", "status"),
    ("Resolution", "resolution"),
)
# ---------------------------------------------------------------------------------


def save_table(df: DataFrame, name: str) -> None:
    """Drop-and-create table sink."""
    df.write.mode("overwrite").option("overwriteSchema", "true").saveAsTable(name)


def save_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def save_csv(df: DataFrame, path: str) -> None:
    """CSV folder with a header in every part file."""
    df.write.mode("overwrite").option("header", True).option("escape", '"').option(
        "ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


def problem_statements(issues: DataFrame) -> DataFrame:
    """One rendered document per issue, cell bars escaped."""
    rows = [
        F.concat(
            F.lit(f"| {heading} | "),
            F.regexp_replace(F.coalesce(F.col(name), F.lit("")), r"\|", r"\\|"),
            F.lit(" |"),
        )
        for heading, name in STATEMENT_FIELDS
    ]
    document = F.concat_ws(
        "\n", F.concat(F.lit("# "), F.col("issue_id")), F.lit(""),
        F.lit("| Field | Value |"), F.lit("|---|---|"), *rows, F.lit(""),
    )
    return issues.select("issue_id", document.alias("document"))


def save_statements(issues: DataFrame, path: str) -> None:
    """Write the documents as records (issue id, text).

    One file per issue would be millions of small files; a reader filters on issue_id.
    """
    problem_statements(issues).write.mode("overwrite").json(path)

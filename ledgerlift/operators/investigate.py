"""Ad-hoc questions an analyst asks before writing rules."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlift.functions.text import is_blank
from ledgerlift.operators.checks import orphans
from ledgerlift.operators.skew import list_in_parts
from ledgerlift.schemas import CURRENCIES


def missing_cost_centre(expenses: DataFrame) -> DataFrame:
    return expenses.filter(is_blank(F.col("cost_centre"))).select(
        "expense_id", "employee_id", "amount", "submitted_date")


def null_overview(df: DataFrame, columns: Sequence[str] = ("vendor_id", "material_code")) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("total_rows"),
                  *[F.count_if(F.col(c).isNull()).alias(f"missing_{c}") for c in columns])


def missing_person_facts(hr: DataFrame) -> DataFrame:
    return hr.filter(F.col("name").isNull() | F.col("hire_date").isNull()).select(
        "employee_id", "job_title", "employment_status")


def negative_amounts(procurement: DataFrame) -> DataFrame:
    return procurement.filter((F.col("quantity") < 0) | (F.col("unit_price") < 0)).select(
        "po_id", "material_code", "quantity", "unit_price")


def unknown_currencies(finance: DataFrame, allowed: Sequence[str] = CURRENCIES) -> DataFrame:
    c = F.col("currency")
    return finance.filter(c.isNotNull() & ~c.isin(*allowed)).select("gl_entry_id", "amount", "currency")


def ended_before_hired(hr: DataFrame) -> DataFrame:
    return hr.filter(F.col("termination_date").cast("date") < F.col("hire_date").cast("date")).select(
        "employee_id", "hire_date", "termination_date")


def code_lengths(finance: DataFrame) -> DataFrame:
    return finance.groupBy(F.length("cost_centre").alias("cc_length")).agg(
        F.count(F.lit(1)).alias("row_count")).orderBy(F.col("row_count").desc())


def unprefixed_codes(expenses: DataFrame) -> DataFrame:
    return expenses.filter(F.col("cost_centre").isNotNull() & ~F.col("cost_centre").like("CC-%")).select(
        "expense_id", "cost_centre")


def odd_currency_lengths(finance: DataFrame) -> DataFrame:
    return finance.filter(F.length("currency") != 3).groupBy("currency").agg(F.count(F.lit(1)).alias("occurrences"))


def _listed_groups(df: DataFrame, key: Column, key_name: str, entry: Column, order: str, out: str) -> DataFrame:
    """Groups of two and more with their entries as text, ordered by id.

    Groups are counted by partial aggregation first; a row holds up to 1,000 entries, and
    ``part`` numbers the rows of a group in order. A NULL key is a group like any other.
    """
    keyed = df.select(
        F.when(key.isNull(), "0").otherwise(F.concat(F.lit("1"), key)).alias("_key"),
        F.col(order).alias("_id"), entry.alias("_entry"))
    sizes = keyed.groupBy("_key").agg(F.count(F.lit(1)).alias("duplicate_count")).filter(
        F.col("duplicate_count") > 1)
    listed = list_in_parts(keyed, sizes, "_key", "duplicate_count", "_id", "_entry", out)
    return listed.select(
        F.when(F.col("_key") != "0", F.expr("substring(_key, 2)")).alias(key_name), "duplicate_count", "part", out)


def same_names(hr: DataFrame) -> DataFrame:
    return _listed_groups(hr, F.col("name"), "name", F.col("employee_id"), "employee_id", "employee_ids")


def near_same_names(hr: DataFrame) -> DataFrame:
    key = F.lower(F.replace(F.col("name"), F.lit(" "), F.lit("")))
    entry = F.concat("employee_id", F.lit(" ("), "name", F.lit(")"))
    return _listed_groups(hr, key, "normalized_name", entry, "employee_id", "employees")


def near_same_vendors(procurement: DataFrame) -> DataFrame:
    """Distinct vendors first: a vendor has many orders."""
    vendors = procurement.select("vendor_id", "vendor_name").distinct()
    bare = F.replace(F.replace(F.col("vendor_name"), F.lit(" Ltd"), F.lit("")), F.lit(" PLC"), F.lit(""))
    entry = F.concat("vendor_id", F.lit(" ("), "vendor_name", F.lit(")"))
    return _listed_groups(vendors, F.lower(bare), "normalized_name", entry, "vendor_id", "vendors")


def orphaned_vendors(finance: DataFrame, procurement: DataFrame) -> DataFrame:
    return orphans(finance.select("gl_entry_id", "vendor_id", "amount"), "vendor_id", procurement,
                   "vendor_id").select("gl_entry_id", "vendor_id", "amount")


def orphaned_employees(expenses: DataFrame, hr: DataFrame) -> DataFrame:
    """Unlike the profiling check, a claim without an employee is listed too."""
    return orphans(expenses.select("expense_id", "employee_id", "amount"), "employee_id", hr, "employee_id",
                   include_null=True).select("expense_id", "employee_id", "amount")


def active_but_ended(hr: DataFrame, as_of: date) -> DataFrame:
    """Inclusive of the day itself."""
    return hr.filter(
        (F.col("employment_status") == "Active") & (F.col("termination_date").cast("date") <= F.lit(as_of))
    ).select("employee_id", "name", "employment_status", "termination_date")

"""Table schemas, closed vocabularies and the per-domain rule tables."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import types as T

# --- fixed values -----------------------------------------------------------
ISSUE_TYPES = ("completeness", "accuracy", "consistency", "duplication", "obsolete_orphaned")
CONFIDENCES = ("high", "medium")
DETECTION_RULES = (
    "null_check", "negative_value", "invalid_currency", "date_out_of_bounds",
    "cost_centre_format_drift", "status_date_contradiction", "exact_name_match",
    "name_abbreviation", "fuzzy_name_match", "company_suffix_match", "orphan_fk",
)
CURRENCIES = ("EUR", "GBP", "USD")
EARLIEST_DATE = date(2010, 1, 1)
NAME_THRESHOLD = 0.90
HIRE_GAP_DAYS = 30
MONEY_TOLERANCE = 0.01
RECALL_GATE_PERCENT = 80
PERSON_TITLES = ("mr", "mrs", "ms", "miss", "dr")
COMPANY_SUFFIXES = ("limited", "ltd", "plc", "llc", "inc", "co")
# ----------------------------------------------------------------------------


@dataclass(frozen=True)
class Domain:
    """One business area: its source table, row identifier and rule columns."""

    key: str
    label: str
    table: str
    target: str
    row_id: str
    required: tuple[str, ...]
    dates: tuple[str, ...]


DOMAINS = {
    d.key: d
    for d in (
        Domain("hr", "HR", "legacy_hr", "target_hr", "employee_id",
               ("employee_id", "name", "dept_code", "job_title", "hire_date",
                "employment_status", "cost_centre"),
               ("hire_date", "termination_date")),
        Domain("finance", "Finance", "legacy_finance", "target_finance", "gl_entry_id",
               ("gl_entry_id", "cost_centre", "account_code", "amount", "currency",
                "posting_date", "document_type", "vendor_id"),
               ("posting_date",)),
        Domain("procurement", "Procurement", "legacy_procurement", "target_procurement", "po_id",
               ("po_id", "vendor_id", "vendor_name", "material_code", "quantity",
                "unit_price", "po_date", "delivery_status", "cost_centre"),
               ("po_date",)),
        Domain("expenses", "Expenses", "legacy_expenses", "target_expenses", "expense_id",
               ("expense_id", "employee_id", "cost_centre", "category", "amount",
                "submitted_date", "approval_status", "currency"),
               ("submitted_date",)),
    )
}


_TYPES = {"string": T.StringType(), "bigint": T.LongType(), "double": T.DoubleType(), "date": T.DateType()}


def _struct(text: str) -> T.StructType:
    pairs = [field.split() for field in text.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


SOURCE_SCHEMAS = {
    "hr": _struct(
        "employee_id string, name string, dept_code string, job_title string, hire_date date, "
        "termination_date date, employment_status string, cost_centre string, manager_id string"),
    "finance": _struct(
        "gl_entry_id string, cost_centre string, account_code bigint, amount double, "
        "currency string, posting_date date, document_type string, vendor_id string"),
    "procurement": _struct(
        "po_id string, vendor_id string, vendor_name string, material_code string, "
        "quantity bigint, unit_price double, po_date date, delivery_status string, "
        "cost_centre string"),
    "expenses": _struct(
        "expense_id string, employee_id string, cost_centre string, category string, "
        "amount double, submitted_date date, approval_status string, currency string"),
}

MANIFEST_SCHEMA = T.StructType([
    T.StructField(n, T.StringType())
    for n in ("issue_id", "domain", "table", "row_identifier", "column", "issue_type", "description")
])

# what every check returns; check_order only fixes the numbering
FINDING_COLUMNS = (
    "check_order", "domain", "table_name", "column_name", "row_identifier", "issue_type",
    "description", "confidence", "detection_rule",
)
ISSUE_COLUMNS = (
    "issue_id", "domain", "table_name", "column_name", "issue_type", "description",
    "root_cause", "business_impact", "status", "resolution",
)


def require_issue_type(issue_type: str) -> str:
    """The vocabulary of issue types is closed."""
    if issue_type not in ISSUE_TYPES:
        raise ValueError(f"issue type {issue_type!r} is not one of {', '.join(ISSUE_TYPES)}")
    return issue_type

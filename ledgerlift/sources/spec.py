"""The mapping spec: which source column becomes which target column, with which type."""

from __future__ import annotations

import json
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class ColumnMap:
    source: str
    target: str
    sql_type: str


@dataclass(frozen=True)
class DomainSpec:
    key: str
    source_table: str
    target_table: str
    columns: tuple[ColumnMap, ...]

    def targets(self) -> list[str]:
        return [c.target for c in self.columns]

    def target_of(self, source: str) -> str | None:
        return next((c.target for c in self.columns if c.source == source), None)

    def drops(self, source: str) -> bool:
        return self.target_of(source) is None


def _domain(key: str, entry: dict) -> DomainSpec:
    return DomainSpec(
        key, entry["legacy_table"], entry["target_table"],
        tuple(ColumnMap(m["legacy_column"], m["target_column"], m["target_type"])
              for m in entry["mappings"]),
    )


def parse_spec(content: dict) -> dict[str, DomainSpec]:
    return {key: _domain(key, entry) for key, entry in content["domains"].items()}


def load_spec(path: str) -> dict[str, DomainSpec]:
    """JSON, or YAML where a YAML reader is installed."""
    text = Path(path).read_text(encoding="utf-8")
    if path.endswith((".yaml", ".yml")):
        try:
            import yaml
        except ImportError as missing:
            raise RuntimeError("reading a YAML spec needs PyYAML; JSON needs nothing") from missing
        return parse_spec(yaml.safe_load(text))
    return parse_spec(json.loads(text))


# --- fixed values: the default spec; (source, target, type) per column -------
# employment_status and vendor_name are left out on purpose: the first follows from
# termination_date, the second from the vendor master.
DEFAULT_COLUMNS = {
    "hr": (
        ("employee_id", "employee_id", "VARCHAR"),
        ("name", "full_name", "VARCHAR"),
        ("dept_code", "dept_code", "VARCHAR"),
        ("job_title", "job_title", "VARCHAR"),
        ("hire_date", "hire_date", "DATE"),
        ("termination_date", "termination_date", "DATE"),
        ("cost_centre", "cost_centre", "VARCHAR"),
        ("manager_id", "manager_id", "VARCHAR"),
    ),
    "finance": (
        ("gl_entry_id", "gl_entry_id", "VARCHAR"),
        ("cost_centre", "cost_centre", "VARCHAR"),
        ("account_code", "account_code", "BIGINT"),
        ("amount", "amount", "DOUBLE"),
        ("currency", "currency", "VARCHAR"),
        ("posting_date", "posting_date", "DATE"),
        ("document_type", "document_type", "VARCHAR"),
        ("vendor_id", "vendor_id", "VARCHAR"),
    ),
    "procurement": (
        ("po_id", "po_id", "VARCHAR"),
        ("vendor_id", "vendor_id", "VARCHAR"),
        ("material_code", "material_code", "VARCHAR"),
        ("quantity", "quantity", "BIGINT"),
        ("unit_price", "unit_price", "DOUBLE"),
        ("po_date", "po_date", "DATE"),
        ("delivery_status", "delivery_status", "VARCHAR"),
        ("cost_centre", "cost_centre", "VARCHAR"),
    ),
    "expenses": (
        ("expense_id", "expense_id", "VARCHAR"),
        ("employee_id", "employee_id", "VARCHAR"),
        ("cost_centre", "cost_centre", "VARCHAR"),
        ("category", "category", "VARCHAR"),
        ("amount", "amount", "DOUBLE"),
        ("submitted_date", "submitted_date", "DATE"),
        ("approval_status", "approval_status", "VARCHAR"),
        ("currency", "currency", "VARCHAR"),
    ),
}
# ------------------------------------------------------------------------------


def default_spec() -> dict[str, DomainSpec]:
    return {
        key: DomainSpec(key, f"legacy_{key}", f"target_{key}",
                        tuple(ColumnMap(*c) for c in columns))
        for key, columns in DEFAULT_COLUMNS.items()
    }


def load_spec_table(spark: SparkSession, path: str) -> dict[str, DomainSpec]:
    """The JSON spec at any path that Spark can read; a spec is a page of text."""
    lines = spark.read.option("wholetext", True).text(path).limit(2).collect()
    if len(lines) != 1:
        raise RuntimeError(f"expected one spec file at {path}")
    return parse_spec(json.loads(lines[0][0]))

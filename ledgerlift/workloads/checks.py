"""Queries for scans, sinks and profiling checks."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from ledgerlift.operators import inject as J
from ledgerlift.operators import kpi as KP
from ledgerlift.operators import mapping as M
from ledgerlift.sources import csv_records as CR
from ledgerlift.sources import readers as RD
from ledgerlift.sources import sinks as SK
from ledgerlift.sources.spec import load_spec_table
from ledgerlift.sources.stages import new_path
from ledgerlift.schemas import SOURCE_SCHEMAS
from ledgerlift.workloads.base import *  # noqa: F403

NO_ORDER = ("domain, table_name, column_name, row_identifier, issue_type, description, confidence, detection_rule")


def _plain(df):
    return df.drop("check_order")


def _rules(spark, sf, key, rules):
    return _plain(C.apply_rules(view(spark, sf, key), DOMAINS[key], rules))


def _checked(keys: str, *parts: str, more: tuple[str, ...] = ()) -> str:
    return with_ctes(keys, *more, select=f"SELECT {NO_ORDER} FROM ({' UNION ALL '.join(parts)}) f")


# --- scans and sinks ------------------------------------------------------------------

FINANCE = "gl_entry_id, cost_centre, account_code, amount, currency, posting_date, document_type, vendor_id"


@query("S1_csv_scan", with_ctes("hr", select=(
    "SELECT employee_id, name, dept_code, job_title, hire_date, termination_date, employment_status, cost_centre, "
    "manager_id FROM hr")))
def csv_scan(spark, sf):
    path = new_path(spark, "hr-csv")
    SK.save_csv(view(spark, sf, "hr"), path)
    return RD.read_csv(spark, path, SOURCE_SCHEMAS["hr"])


@query("S1_quoted_line_breaks", "SELECT doc_id, text, lang FROM documents")
def quoted_line_breaks(spark, sf):
    """Texts with line breaks, quotes and commas written as CSV and read back in splits."""
    path = new_path(spark, "documents-csv")
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    SK.save_csv(docs, path)
    return CR.read_csv_records(spark, path, docs.schema).rows


BAD_AMOUNT = f"{NUMBER['finance']} % 113 = 3"


@query("S1_quarantine", with_ctes("fin", select=(
    f"SELECT gl_entry_id, CASE WHEN NOT ({BAD_AMOUNT}) THEN amount END AS amount, {BAD_AMOUNT} AS rejected FROM fin")))
def quarantine(spark, sf):
    """A load in which some amounts are no numbers: good rows load, the others are kept as records."""
    path = new_path(spark, "finance-csv")
    fin = view(spark, sf, "finance")
    SK.save_csv(fin.withColumn("amount", F.when(F.expr(BAD_AMOUNT), "n/a").otherwise(F.col("amount").cast("string"))), path)
    loaded = CR.read_csv_records(spark, path, SOURCE_SCHEMAS["finance"])
    kept = loaded.rows.select("gl_entry_id", "amount", F.lit(False).alias("rejected"))
    return kept.unionByName(loaded.rejected.select(
        F.split("record", ",")[0].alias("gl_entry_id"), F.lit(None).cast("double").alias("amount"), F.lit(True).alias("rejected")))


def _manifest(spark, sf):
    changed, manifest = J.plant(view(spark, sf, "finance"), DOMAINS["finance"], J.standard_defects("finance"),
                                _number("gl_entry_id", 4))
    return changed, manifest


def _number(column: str, start: int, length: int = 20, buckets: int = 100):
    return F.expr(f"pmod(cast(split_part(substr({column}, {start}, {length}), '-', 1) as bigint), {buckets})")


def planted_sql(key: str) -> str:
    """Manifest rows of the standard defects of a domain, one row in a hundred per defect."""
    number = {"hr": "CAST(substr(employee_id, 5) AS BIGINT)", "finance": "CAST(substr(gl_entry_id, 4) AS BIGINT)",
              "procurement": "CAST(split_part(substr(po_id, 4), '-', 1) AS BIGINT)",
              "expenses": "CAST(substr(expense_id, 5) AS BIGINT)"}[key]
    short, d = SHORT[key], DOMAINS[key]
    canonical = "regexp_full_match(cost_centre, 'CC-[0-9]{3}')"

    def part(bucket, column, issue_type, row, text, where="true"):
        return (f"SELECT '{key}-{bucket}-' || {row} AS issue_id, '{d.label}' AS domain, '{d.table}' AS \"table\", "
                f"{row} AS row_identifier, '{column}' AS \"column\", '{issue_type}' AS issue_type, {text} AS description "
                f"FROM {short} WHERE {number} % 100 = {bucket} AND ({where})")

    if key == "hr":
        initial = "string_split(trim(name), ' ')[1] || ' ' || substr(string_split(trim(name), ' ')[-1], 1, 1) || '.'"
        text = ("'Likely duplicate of ' || employee_id || ' (''' || name || '''): re-entered as ' || employee_id || "
                "'-D{b}' || ' with name variant ''' || {v} || '''.'")
        return " UNION ALL ".join([
            part(0, "name", "duplication", "employee_id || '-D0'", text.format(b=0, v="name || ' '")),
            part(1, "name", "duplication", "employee_id || '-D1'", text.format(b=1, v=initial)),
            part(2, "employment_status", "consistency", "employee_id",
                 "'employment_status is ''Active'' but termination_date is populated with a past date (2023-06-01) - "
                 "contradictory record.'", "employment_status = 'Active'")])
    if key == "procurement":
        variant = ("CASE WHEN vendor_name LIKE '%Ltd%' THEN replace(vendor_name, ' Ltd', ' Limited') "
                   "ELSE vendor_name || ' Ltd' END")
        return " UNION ALL ".join([
            part(0, "vendor_name", "duplication", "po_id || '-D'",
                 f"'Vendor ''' || {variant} || ''' (' || vendor_id || '-D) appears to be a duplicate of ''' || vendor_name "
                 "|| ''' (' || vendor_id || ') - minor name variant, likely same vendor entered as two master records.'"),
            part(1, "quantity", "accuracy", "po_id",
                 "'quantity is negative (' || CAST(-abs(quantity) AS VARCHAR) || ') - not a valid PO quantity.'",
                 "quantity <> 0"),
            part(2, "cost_centre", "consistency", "po_id",
                 "'cost_centre stored as ''C' || substr(cost_centre, 4, 3) || ''' instead of canonical format ''' || "
                 "cost_centre || '''.'", canonical)])
    if key == "finance":
        return " UNION ALL ".join([
            part(0, "vendor_id", "obsolete_orphaned", "gl_entry_id",
                 "'References vendor_id ''VEND-999'', which does not exist in the Procurement vendor pool - orphaned "
                 "reference.'"),
            part(1, "currency", "accuracy", "gl_entry_id", "'currency recorded as ''GPB'', a typo of the valid ISO code "
                                                           "''GBP''.'"),
            part(2, "cost_centre", "consistency", "gl_entry_id",
                 "'cost_centre stored as ''' || substr(cost_centre, 4, 3) || ''' instead of canonical format ''' || "
                 "cost_centre || '''.'", canonical)])
    return " UNION ALL ".join([
        part(0, "cost_centre", "completeness", "expense_id", "'cost_centre is missing (blank) on this expense claim.'"),
        part(1, "employee_id", "obsolete_orphaned", "expense_id",
             "'References employee_id ''EMP-9999'', not present in HR - simulates a leaver whose record was never "
             "deactivated/reassigned.'")])


MANIFEST = 'issue_id, domain, "table", row_identifier, "column", issue_type, description'


@query("S2_manifest_scan", with_ctes("fin", select=planted_sql("finance")))
def manifest_scan(spark, sf):
    path = new_path(spark, "manifest")
    _manifest(spark, sf)[1].write.json(path)
    return RD.read_manifest(spark, path, lines=True)


@query("S3_manifest_lookup", with_ctes("fin", f"m AS ({planted_sql('finance')})", select=(
    "SELECT row_identifier, string_agg(DISTINCT issue_type, ',' ORDER BY issue_type) AS issue_types FROM m "
    "GROUP BY row_identifier")))
def manifest_types(spark, sf):
    return RD.manifest_lookup(_manifest(spark, sf)[1]).select(
        "row_identifier", F.array_join("issue_types", ",").alias("issue_types"))


def _specified(key: str) -> dict:
    spec = default_spec()[key]
    return {"legacy_table": spec.source_table, "target_table": spec.target_table, "mappings": [
        {"legacy_column": c.source, "target_column": c.target, "target_type": c.sql_type} for c in spec.columns]}


@query("S4_spec_load", with_ctes("hr", sql_target("hr", held=False), select="SELECT * FROM mapped_hr"))
def spec_load(spark, sf):
    path = new_path(spark, "spec")
    content = json.dumps({"domains": {"hr": _specified("hr")}})
    spark.createDataFrame([(content,)], "value string").coalesce(1).write.text(path)
    return M.map_table(view(spark, sf, "hr"), load_spec_table(spark, path)["hr"])


@query("S5_required_tables", with_ctes(ALL, select=" UNION ALL ".join(
    f"SELECT '{DOMAINS[k].table}' AS table_name, count(*) AS n FROM {SHORT[k]}" for k in KEYS)))
def required_tables(spark, sf):
    src = sources(spark, sf)
    for key, df in src.items():
        df.createOrReplaceTempView(DOMAINS[key].table)
    names = [DOMAINS[k].table for k in KEYS]
    RD.require_tables(spark, names)
    return spark.sql(" UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS n FROM {n}" for n in names))


@query("S6_table_sink", with_ctes("fin", select=f"SELECT {FINANCE} FROM fin"))
def table_sink(spark, sf):
    path = new_path(spark, "finance")
    SK.save_parquet(view(spark, sf, "finance"), path)
    return spark.read.parquet(path)


@query("S7_csv_sink", with_ctes("exp", select="SELECT * FROM exp"))
def csv_sink(spark, sf):
    path = new_path(spark, "expenses-csv")
    SK.save_csv(view(spark, sf, "expenses"), path)
    return RD.read_csv(spark, path, SOURCE_SCHEMAS["expenses"], blank_text=True)


DOCUMENT = r"""'# ' || issue_id || chr(10) || chr(10) || '| Field | Value |' || chr(10) || '|---|---|' || chr(10)
  || '| Issue ID | ' || issue_id || ' |' || chr(10) || '| Domain | ' || domain || ' |' || chr(10)
  || '| Table | ' || table_name || ' |' || chr(10) || '| Column | ' || column_name || ' |' || chr(10)
  || '| Issue Type | ' || issue_type || ' |' || chr(10)
  || '| Description | ' || replace(description, '|', '\|') || ' |' || chr(10)
  || '| Root Cause (hypothesis) | ' || replace(root_cause, '|', '\|') || ' |' || chr(10)
  || '| Business Impact | ' || replace(business_impact, '|', '\|') || ' |' || chr(10)
  || '| Status | ' || status || ' |' || chr(10) || '| Resolution | ' || replace(resolution, '|', '\|') || ' |' || chr(10)"""""


@query("S8_problem_statements", with_ctes(ALL, FINDINGS, ISSUES, *RESOLVED, select=(
    f"SELECT issue_id, {DOCUMENT} AS document FROM (SELECT *, {CAUSE} AS root_cause, {IMPACT_TEXT} AS business_impact FROM issue_rows) i")))
def problem_statements(spark, sf):
    return SK.problem_statements(job(spark, sf).issues)


BEFORE = (f"before AS (SELECT cost_centre, count(*) AS row_count, {money('amount')} AS total_amount FROM fin "
          "WHERE gl_entry_id NOT IN (SELECT row_identifier FROM held WHERE table_name = 'legacy_finance') "
          "GROUP BY cost_centre)")
AFTER = (f"after_ AS (SELECT cost_centre, count(*) AS row_count, {money('amount')} AS total_amount FROM target_fin "
         "GROUP BY cost_centre)")
SPLIT = ("split AS (SELECT DISTINCT code AS canonical FROM (SELECT cost_centre, " + CODE + " AS code FROM before) x "
         "WHERE code IS NOT NULL AND code IS DISTINCT FROM cost_centre)")
IMPACT = ("impact AS (SELECT scenario, cost_centre, row_count, total_amount, code IN (SELECT canonical FROM split) "
          "AND code IS NOT NULL AS is_affected_by_cascade FROM (SELECT *, " + CODE + " AS code FROM (SELECT 'before' AS "
          "scenario, * FROM before UNION ALL SELECT 'after', * FROM after_) u) v)")
KPI = (*CHAIN, sql_target("finance"), BEFORE, AFTER, SPLIT, IMPACT)
IMPACT_SELECT = ("SELECT scenario, cost_centre, row_count, total_amount, "
                 "coalesce(is_affected_by_cascade, false) AS is_affected_by_cascade FROM impact")


def figures(spark, sf):
    return job(spark, sf).figures


@query("S9_impact_sink", with_ctes(ALL, *KPI, select=IMPACT_SELECT))
def impact_sink(spark, sf):
    path = new_path(spark, "impact")
    SK.save_parquet(KP.impact_table(*figures(spark, sf)), path)
    return spark.read.parquet(path)


# --- checks ------------------------------------------------------------------------------


@query("C1_blank_rates", with_ctes(ALL, select=" UNION ALL ".join(
    f"SELECT '{DOMAINS[k].table}' AS table_name, '{c}' AS column_name, "
    f"count(*) FILTER ({c} IS NULL OR trim(CAST({c} AS VARCHAR)) = '') AS missing_rows, count(*) AS total_rows, "
    f"CAST(count(*) FILTER ({c} IS NULL OR trim(CAST({c} AS VARCHAR)) = '') * CAST(100 AS DOUBLE) / count(*) AS DOUBLE) "
    f"AS missing_percent FROM {SHORT[k]}" for k in KEYS for c in DOMAINS[k].required)))
def blank_rates(spark, sf):
    out = None
    for k, df in sources(spark, sf).items():
        part = C.blank_rates(df, DOMAINS[k])
        out = part if out is None else out.unionByName(part)
    return out.withColumn("missing_percent", F.col("missing_percent").cast("double"))


@query("C2_blank_findings", _checked(ALL, *[sql_blank(k) for k in KEYS]))
def blank_findings(spark, sf):
    out = None
    for k, df in sources(spark, sf).items():
        part = C.apply_rules(df, DOMAINS[k], C.blank_rules(DOMAINS[k].required))
        out = part if out is None else out.unionByName(part)
    return _plain(out)


def _any_blank(columns) -> str:
    return " OR ".join(f"{c} IS NULL OR trim(CAST({c} AS VARCHAR)) = ''" for c in columns)


@query("C3_required_columns", with_ctes(ALL, select=" UNION ALL ".join(
    f"SELECT '{DOMAINS[k].label}' AS domain, {len(DOMAINS[k].required)} AS required_columns, "
    f"count(*) FILTER ({_any_blank(DOMAINS[k].required)}) "
    f"AS incomplete_rows FROM {SHORT[k]}" for k in KEYS)))
def required_columns(spark, sf):
    from functools import reduce

    from ledgerlift.functions.text import is_blank
    out = None
    for k, df in sources(spark, sf).items():
        d = DOMAINS[k]
        some = reduce(lambda a, b: a | b, [is_blank(F.col(c)) for c in d.required])
        part = df.agg(F.count_if(some).alias("incomplete_rows")).select(
            F.lit(d.label).alias("domain"), F.lit(len(d.required)).alias("required_columns"), "incomplete_rows")
        out = part if out is None else out.unionByName(part)
    return out


@query("C4_negative_quantity", _checked("proc", SQL_NEGATIVE))
def negative_quantity(spark, sf):
    return _rules(spark, sf, "procurement", [C.negative_rule()])


@query("C4_negative_balance", "SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal < 0")
def negative_balance(spark, sf):
    rule = C.negative_rule("c_acctbal", "balance")
    return table(spark, sf, "customer").filter(rule.breaks).select("c_custkey", "c_acctbal")


@query("C5_allowed_currency", _checked("fin exp", sql_currency("finance"), sql_currency("expenses")))
def allowed_currency(spark, sf):
    return _rules(spark, sf, "finance", [C.allowed_values_rule()]).unionByName(
        _rules(spark, sf, "expenses", [C.allowed_values_rule()]))


@query("C5_allowed_long_list",
       "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)")
def allowed_long_list(spark, sf):
    good = table(spark, sf, "customer").filter("c_acctbal >= 0")
    return C.not_in_reference(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), "o_custkey", good,
                              "c_custkey").select("o_orderkey", "o_custkey")


@query("C6_date_range", _checked(ALL, *[sql_dates(k, "2010-01-01") for k in KEYS]))
def date_range(spark, sf):
    out = None
    for k, df in sources(spark, sf).items():
        part = C.apply_rules(df, DOMAINS[k], C.date_range_rules(DOMAINS[k].dates, AS_OF))
        out = part if out is None else out.unionByName(part)
    return _plain(out)


@query("C6_shipped_late_range",
       "SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS shipped FROM lineitem "
       "WHERE CAST(l_shipdate AS DATE) < DATE '2010-01-01' OR CAST(l_shipdate AS DATE) > DATE '2001-08-01'")
def shipped_range(spark, sf):
    from datetime import date
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.to_date("l_shipdate").alias("shipped"))
    return rows.filter(C.date_range_rules(["shipped"], date(2001, 8, 1))[0].breaks)


@query("C7_code_format", _checked(ALL, *[sql_format(k) for k in KEYS]))
def code_format(spark, sf):
    out = None
    for k, df in sources(spark, sf).items():
        part = C.apply_rules(df, DOMAINS[k], [C.format_rule()])
        out = part if out is None else out.unionByName(part)
    return _plain(out)


@query("C8_status_contradiction", _checked("hr", SQL_CONTRADICTION))
def status_contradiction(spark, sf):
    return _rules(spark, sf, "hr", [C.contradiction_rule(AS_OF)])


@query("C9_orphan_vendors", _checked("proc fin", SQL_ORPHAN_VENDOR))
def orphan_vendors(spark, sf):
    return _plain(C.orphan_vendor_findings(view(spark, sf, "finance"), view(spark, sf, "procurement")))


@query("C10_orphan_employees", _checked("hr exp", SQL_ORPHAN_EMPLOYEE))
def orphan_employees(spark, sf):
    return _plain(C.orphan_employee_findings(view(spark, sf, "expenses"), view(spark, sf, "hr")))


@query("C11_typed_findings", with_ctes("exp", select=(
    "SELECT 'Expenses' AS domain, 'legacy_expenses' AS table_name, 'amount' AS column_name, expense_id AS row_identifier, "
    "'accuracy' AS issue_type, 'amount is over 40' AS description, 'medium' AS confidence, 'amount_limit' AS detection_rule "
    "FROM exp WHERE amount > 40")))
def typed_findings(spark, sf):
    rows = view(spark, sf, "expenses").filter("amount > 40")
    return _plain(C.findings_from(rows, "Expenses", "legacy_expenses", "amount", "expense_id", "accuracy",
                                  F.lit("amount is over 40"), "medium", "amount_limit"))


@query("C12_descriptions", with_ctes("hr fin proc exp", PERSONS, select=(
    f"SELECT row_identifier, description FROM ({sql_currency('finance')} UNION ALL {SQL_NEGATIVE} UNION ALL "
    f"{sql_person_exact()} UNION ALL {sql_dates('expenses')}) f")))
def descriptions(spark, sf):
    src = sources(spark, sf)
    parts = [
        C.apply_rules(src["finance"], DOMAINS["finance"], [C.allowed_values_rule()]),
        C.apply_rules(src["procurement"], DOMAINS["procurement"], [C.negative_rule()]),
        D.person_exact_findings(D.person_rows(src["hr"])),
        C.apply_rules(src["expenses"], DOMAINS["expenses"], C.date_range_rules(DOMAINS["expenses"].dates, AS_OF, EARLIEST)),
    ]
    return C.collect_findings(parts).select("row_identifier", "description")


@query("C13_numbered_findings", with_ctes(ALL, FINDINGS, select=(
    f"SELECT finding_id, {NO_ORDER} FROM findings")))
def numbered_findings(spark, sf):
    return job(spark, sf).findings.drop("finding_key")


TYPE_COUNTS = ", ".join(f"count(*) FILTER (issue_type = '{t}') AS {t}" for t in ISSUE_TYPES)


@query("C14_findings_pivot", with_ctes(ALL, FINDINGS, select=(
    f"SELECT domain, {TYPE_COUNTS}, count(*) AS total FROM findings GROUP BY domain UNION ALL "
    f"SELECT 'Total', {TYPE_COUNTS}, count(*) FROM findings")))
def findings_pivot(spark, sf):
    return C.findings_pivot(job(spark, sf).findings)

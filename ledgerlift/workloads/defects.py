"""Queries for planted defects and scoring."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlift.operators import inject as J
from ledgerlift.operators import score as S
from ledgerlift.workloads.base import *  # noqa: F403
from ledgerlift.workloads.checks import MANIFEST, _number, planted_sql

START = {"hr": ("employee_id", 5), "finance": ("gl_entry_id", 4), "procurement": ("po_id", 4), "expenses": ("expense_id", 5)}
CANONICAL = "regexp_full_match(cost_centre, 'CC-[0-9]{3}')"


def planted(spark, sf, key, rows=None):
    return J.plant(view(spark, sf, key) if rows is None else rows, DOMAINS[key], J.standard_defects(key), _number(*START[key]))


@query("J1_duplicate_persons", with_ctes("hr", select=(
    "SELECT employee_id || '-D0' AS employee_id, name || ' ' AS name, dept_code, hire_date FROM hr "
    f"WHERE {NUMBER['hr']} % 100 = 0 UNION ALL SELECT employee_id || '-D1', string_split(trim(name), ' ')[1] || ' ' || "
    f"substr(string_split(trim(name), ' ')[-1], 1, 1) || '.', dept_code, hire_date FROM hr WHERE {NUMBER['hr']} % 100 = 1")))
def duplicate_persons(spark, sf):
    changed = planted(spark, sf, "hr")[0]
    return changed.filter(F.col("employee_id").contains("-D")).select("employee_id", "name", "dept_code", "hire_date")


@query("J2_contradictions", with_ctes("hr", select=(
    f"SELECT employee_id, employment_status, CASE WHEN {NUMBER['hr']} % 100 = 2 AND employment_status = 'Active' "
    "THEN DATE '2023-06-01' ELSE termination_date END AS termination_date FROM hr")))
def contradictions(spark, sf):
    changed = planted(spark, sf, "hr")[0]
    return changed.filter(~F.col("employee_id").contains("-D")).select("employee_id", "employment_status", "termination_date")


@query("J3_duplicate_vendors", with_ctes("proc", select=(
    "SELECT po_id || '-D' AS po_id, vendor_id || '-D' AS vendor_id, CASE WHEN vendor_name LIKE '%Ltd%' THEN "
    "replace(vendor_name, ' Ltd', ' Limited') ELSE vendor_name || ' Ltd' END AS vendor_name FROM proc "
    f"WHERE {NUMBER['procurement']} % 100 = 0")))
def duplicate_vendors(spark, sf):
    changed = planted(spark, sf, "procurement")[0]
    return changed.filter(F.col("po_id").endswith("-D")).select("po_id", "vendor_id", "vendor_name")


@query("J4_negative_values", with_ctes("proc", select=(
    f"SELECT po_id, CASE WHEN {NUMBER['procurement']} % 100 = 1 THEN -abs(quantity) ELSE quantity END AS quantity FROM proc")))
def negative_values(spark, sf):
    return planted(spark, sf, "procurement")[0].filter(~F.col("po_id").endswith("-D")).select("po_id", "quantity")


@query("J5_code_drift", with_ctes("fin proc", select=(
    f"SELECT po_id AS id, CASE WHEN {NUMBER['procurement']} % 100 = 2 AND {CANONICAL} THEN 'C' || substr(cost_centre, 4, 3) "
    f"ELSE cost_centre END AS cost_centre FROM proc UNION ALL SELECT gl_entry_id, CASE WHEN {NUMBER['finance']} % 100 = 2 "
    f"AND {CANONICAL} THEN substr(cost_centre, 4, 3) ELSE cost_centre END FROM fin")))
def code_drift(spark, sf):
    orders = planted(spark, sf, "procurement")[0].filter(~F.col("po_id").endswith("-D"))
    return orders.select(F.col("po_id").alias("id"), "cost_centre").unionByName(
        planted(spark, sf, "finance")[0].select(F.col("gl_entry_id").alias("id"), "cost_centre"))


@query("J6_orphan_keys", with_ctes("fin exp", select=(
    f"SELECT gl_entry_id AS id, CASE WHEN {NUMBER['finance']} % 100 = 0 THEN 'VEND-999' ELSE vendor_id END AS key FROM fin "
    f"UNION ALL SELECT expense_id, CASE WHEN {NUMBER['expenses']} % 100 = 1 THEN 'EMP-9999' ELSE employee_id END FROM exp")))
def orphan_keys(spark, sf):
    return planted(spark, sf, "finance")[0].select(F.col("gl_entry_id").alias("id"), F.col("vendor_id").alias("key")).unionByName(
        planted(spark, sf, "expenses")[0].select(F.col("expense_id").alias("id"), F.col("employee_id").alias("key")))


@query("J7_currency_typos", with_ctes("fin", select=(
    f"SELECT gl_entry_id, CASE WHEN {NUMBER['finance']} % 100 = 1 THEN 'GPB' ELSE currency END AS currency FROM fin")))
def currency_typos(spark, sf):
    return planted(spark, sf, "finance")[0].select("gl_entry_id", "currency")


@query("J8_blanks", with_ctes("exp", select=(
    f"SELECT expense_id, CASE WHEN {NUMBER['expenses']} % 100 = 0 THEN '' ELSE cost_centre END AS cost_centre FROM exp")))
def blanks(spark, sf):
    return planted(spark, sf, "expenses")[0].select("expense_id", "cost_centre")


@query("J9_manifest", with_ctes(ALL, select=" UNION ALL ".join(f"SELECT {MANIFEST} FROM ({planted_sql(k)}) m_{k}" for k in KEYS)))
def manifest(spark, sf):
    out = None
    for k in KEYS:
        part = planted(spark, sf, k)[1]
        out = part if out is None else out.unionByName(part)
    return out


# --- scoring: the planted defects of all four tables against all checks ----

_SPLIT = "string_split(trim(name), ' ')"
_PLANTED = {
    "hr": (f"SELECT * REPLACE (CASE WHEN {NUMBER['hr']} % 100 = 2 AND employment_status = 'Active' THEN DATE '2023-06-01' "
           f"ELSE termination_date END AS termination_date) FROM hr0 UNION ALL SELECT * REPLACE (employee_id || '-D0' AS employee_id, "
           f"name || ' ' AS name) FROM hr0 WHERE {NUMBER['hr']} % 100 = 0 UNION ALL SELECT * REPLACE (employee_id || '-D1' AS employee_id, "
           f"{_SPLIT}[1] || ' ' || substr({_SPLIT}[-1], 1, 1) || '.' AS name) FROM hr0 WHERE {NUMBER['hr']} % 100 = 1"),
    "procurement": (f"SELECT * REPLACE (CASE WHEN {NUMBER['procurement']} % 100 = 1 THEN -abs(quantity) ELSE quantity END AS quantity, "
                    f"CASE WHEN {NUMBER['procurement']} % 100 = 2 AND {CANONICAL} THEN 'C' || substr(cost_centre, 4, 3) ELSE cost_centre "
                    "END AS cost_centre) FROM proc0 UNION ALL SELECT * REPLACE (po_id || '-D' AS po_id, vendor_id || '-D' AS vendor_id, "
                    "CASE WHEN vendor_name LIKE '%Ltd%' THEN replace(vendor_name, ' Ltd', ' Limited') ELSE vendor_name || ' Ltd' END "
                    f"AS vendor_name) FROM proc0 WHERE {NUMBER['procurement']} % 100 = 0"),
    "finance": (f"SELECT * REPLACE (CASE WHEN {NUMBER['finance']} % 100 = 0 THEN 'VEND-999' ELSE vendor_id END AS vendor_id, "
                f"CASE WHEN {NUMBER['finance']} % 100 = 1 THEN 'GPB' ELSE currency END AS currency, CASE WHEN {NUMBER['finance']} % 100 = 2 "
                f"AND {CANONICAL} THEN substr(cost_centre, 4, 3) ELSE cost_centre END AS cost_centre) FROM fin0"),
    "expenses": (f"SELECT * REPLACE (CASE WHEN {NUMBER['expenses']} % 100 = 1 THEN 'EMP-9999' ELSE employee_id END AS employee_id, "
                 f"CASE WHEN {NUMBER['expenses']} % 100 = 0 THEN '' ELSE cost_centre END AS cost_centre) FROM exp0"),
}


def _scored(select: str) -> str:
    """Over the manifest m and the findings f of the tables with planted defects."""
    parts = [ctes(suffix="0"), *(f"{SHORT[k]} AS ({_PLANTED[k]})" for k in KEYS)]
    parts.append("m AS (" + " UNION ALL ".join(planted_sql(k).replace(f"FROM {SHORT[k]} ", f"FROM {SHORT[k]}0 ") for k in KEYS) + ")")
    return "WITH RECURSIVE " + ",\n".join([*parts, FINDINGS, "f AS (SELECT * FROM findings)"]) + "\n" + select


HIT = "EXISTS (SELECT 1 FROM f WHERE f.row_identifier = m.row_identifier AND f.issue_type = m.issue_type)"
KNOWN = "EXISTS (SELECT 1 FROM m WHERE f.row_identifier = m.row_identifier AND f.issue_type = m.issue_type)"
_planted_jobs: dict[tuple[str, str], tuple] = {}


def planted_tables(spark, sf):
    """The four tables and their manifests, planted in written tables: the plan would work out a view's ids for every use of them."""
    rows = job(spark, sf).sources
    return {k: planted(spark, sf, k, rows[k]) for k in KEYS}


def scored(spark, sf):
    """Manifest and findings of the four planted tables; the queries of a session share them."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _planted_jobs:
        made = planted_tables(spark, sf)
        manifest = stage(reduce(DataFrame.unionByName, [m for _, m in made.values()]), "manifest")
        run = Migration({k: stage(df, f"planted-{k}") for k, (df, _) in made.items()}, AS_OF, manifest=manifest, earliest=EARLIEST)
        _planted_jobs[key] = manifest, run.findings
    return _planted_jobs[key]


@query("K6_recall", _scored(
    f"SELECT planted, caught, planted - caught AS missed, caught * CAST(100 AS DOUBLE) / planted AS recall_percent, "
    "CASE WHEN caught * 100.0 / planted >= 80 THEN 'PASS' ELSE 'FAIL' END AS gate FROM (SELECT count(*) AS planted, "
    f"count(*) FILTER ({HIT}) AS caught FROM m) q"))
def recall(spark, sf):
    return S.recall(*scored(spark, sf)).withColumn("recall_percent", F.col("recall_percent").cast("double"))


@query("K6_matched", _scored(f"SELECT issue_id, row_identifier FROM m WHERE {HIT}"))
def matched(spark, sf):
    return S.matched(*scored(spark, sf)).select("issue_id", "row_identifier")


@query("K6_missed", _scored(f"SELECT issue_id, row_identifier FROM m WHERE NOT {HIT}"))
def missed(spark, sf):
    return S.missed(*scored(spark, sf)).select("issue_id", "row_identifier")


@query("K7_false_positives", _scored(
    f"SELECT row_identifier, issue_type, detection_rule, description FROM f WHERE NOT {KNOWN}"))
def false_positives(spark, sf):
    return S.false_positives(*scored(spark, sf)).select("row_identifier", "issue_type", "detection_rule", "description")


@query("K7_false_positive_rate", _scored(
    "SELECT findings, false_positives, false_positives * CAST(100 AS DOUBLE) / findings AS false_positive_percent FROM "
    f"(SELECT count(*) AS findings, count(*) FILTER (NOT {KNOWN}) AS false_positives FROM f) q"))
def false_positive_rate(spark, sf):
    return S.false_positive_rate(*scored(spark, sf)).withColumn(
        "false_positive_percent", F.col("false_positive_percent").cast("double"))


@query("K8_recall_by_type", _scored(
    f"SELECT issue_type, count(*) AS planted, count(*) FILTER ({HIT}) AS caught FROM m GROUP BY issue_type"))
def recall_by_type(spark, sf):
    return S.recall_by_type(*scored(spark, sf))

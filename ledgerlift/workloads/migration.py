"""Queries for mapping, migration, reconciliation and the effect on figures."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlift.functions.codes import COST_CENTRE
from ledgerlift.operators import clusters as K
from ledgerlift.operators import kpi as KP
from ledgerlift.operators import mapping as M
from ledgerlift.operators import reconcile as R
from ledgerlift.plans.pipeline import run
from ledgerlift.sources.publish import version
from ledgerlift.sources.stages import new_path
from ledgerlift.workloads.base import *  # noqa: F403
from ledgerlift.workloads.checks import AFTER, BEFORE, IMPACT_SELECT, KPI, SPLIT, figures

MAPPED = tuple(sql_target(k, held=False) for k in KEYS)


@query("M1_mapped_hr", with_ctes("hr", sql_target("hr", held=False), select="SELECT * FROM mapped_hr"))
def mapped_hr(spark, sf):
    return M.map_table(view(spark, sf, "hr"), default_spec()["hr"])


@query("M1_mapped_procurement", with_ctes("proc", sql_target("procurement", held=False), select="SELECT * FROM mapped_proc"))
def mapped_procurement(spark, sf):
    return M.map_table(view(spark, sf, "procurement"), default_spec()["procurement"])


@query("M1_failed_casts", with_ctes("fin", select=" UNION ALL ".join(
    f"SELECT '{c.source}' AS column_name, count(*) FILTER ({c.source} IS NOT NULL AND "
    f"TRY_CAST({c.source} AS {c.sql_type}) IS NULL) AS failed FROM fin"
    for c in default_spec()["finance"].columns if c.source != "cost_centre")))
def failed_casts(spark, sf):
    return M.failed_casts(view(spark, sf, "finance"), default_spec()["finance"])


@query("M2_normalised_codes", with_ctes("fin proc", select=(
    f"SELECT cost_centre AS old, {CODE} AS new, count(*) AS n FROM (SELECT cost_centre FROM fin UNION ALL "
    "SELECT cost_centre FROM proc) u GROUP BY 1, 2")))
def normalised_codes(spark, sf):
    codes = view(spark, sf, "finance").select("cost_centre").unionByName(
        view(spark, sf, "procurement").select("cost_centre"))
    return codes.groupBy(F.col("cost_centre").alias("old")).agg(F.count(F.lit(1)).alias("n")).withColumn(
        "new", COST_CENTRE.normalise(F.col("old")))


@query("M3_row_count_kept", with_ctes(ALL, select=" UNION ALL ".join(
    f"SELECT 'target_{k}' AS table_name, count(*) AS n FROM {SHORT[k]}" for k in KEYS)))
def row_count_kept(spark, sf):
    out = None
    for k, df in sources(spark, sf).items():
        mapped = stage(M.map_table(df, default_spec()[k]), f"mapped-{k}")
        M.require_equal_counts(df, mapped, f"target_{k}")
        part = mapped.agg(F.count(F.lit(1)).alias("n")).select(F.lit(f"target_{k}").alias("table_name"), "n")
        out = part if out is None else out.unionByName(part)
    return out


def _stats(key: str) -> str:
    return (f"SELECT 'target_{key}' AS table_name, count(*) FILTER (regexp_full_match(cost_centre, 'CC-[0-9]{{3}}')) AS "
            "already_canonical, count(*) FILTER (regexp_full_match(cost_centre, 'C?[0-9]{3}')) AS fixed, "
            "count(*) FILTER (cost_centre IS NULL OR trim(cost_centre) = '') AS left_null, count(*) FILTER (trim(cost_centre) "
            f"<> '' AND NOT regexp_full_match(cost_centre, '(CC-|C)?[0-9]{{3}}')) AS unrecognised FROM {SHORT[key]}")


@query("M4_code_stats", with_ctes(ALL, select=" UNION ALL ".join(_stats(k) for k in KEYS)))
def code_stats(spark, sf):
    out = None
    for k, df in sources(spark, sf).items():
        part = M.code_stats(df, f"target_{k}")
        out = part if out is None else out.unionByName(part)
    return out


FK_VENDOR = "SELECT gl_entry_id, vendor_id FROM fin WHERE vendor_id NOT IN (SELECT vendor_id FROM proc)"
FK_EMPLOYEE = "SELECT expense_id, employee_id FROM exp WHERE employee_id NOT IN (SELECT employee_id FROM hr)"


def _orphan_vendors(spark, sf):
    return M.orphan_vendors(job(spark, sf).mapped["finance"], job(spark, sf).vendor_master)


def _orphan_employees(spark, sf):
    mapped = job(spark, sf).mapped
    return M.orphan_employees(mapped["expenses"], mapped["hr"])


@query("M5_vendor_references", with_ctes("proc fin", select=FK_VENDOR))
def vendor_references(spark, sf):
    return _orphan_vendors(spark, sf).select("gl_entry_id", "vendor_id")


@query("M6_employee_references", with_ctes("hr exp", select=FK_EMPLOYEE))
def employee_references(spark, sf):
    return _orphan_employees(spark, sf).select("expense_id", "employee_id")


@query("M7_odd_codes", "WITH o AS (SELECT 'CC-' || CAST(o_orderkey % 1009 AS VARCHAR) AS cost_centre FROM orders) "
       "SELECT DISTINCT 'target_orders' AS table_name, cost_centre AS code FROM o "
       "WHERE NOT regexp_full_match(cost_centre, 'CC-[0-9]{3}')")
def odd_codes(spark, sf):
    orders = table(spark, sf, "orders").select(
        F.concat(F.lit("CC-"), (F.col("o_orderkey") % 1009).cast("string")).alias("cost_centre"))
    return M.odd_codes({"orders": orders})


@query("M7_mapped_codes", with_ctes(ALL, *MAPPED, select=" UNION ALL ".join(
    f"SELECT DISTINCT 'target_{k}' AS table_name, cost_centre AS code FROM mapped_{SHORT[k]} "
    "WHERE NOT regexp_full_match(cost_centre, 'CC-[0-9]{3}')" for k in KEYS)))
def mapped_codes(spark, sf):
    return M.odd_codes(map_all(sources(spark, sf)))


@query("M8_failures_with_issue", with_ctes(ALL, *CHAIN, select=(
    f"SELECT f.gl_entry_id, f.vendor_id, i.issue_id, coalesce(i.status, 'not tracked') AS issue_status FROM ({FK_VENDOR}) f "
    "LEFT JOIN (SELECT row_identifier, arg_min(issue_id, finding_id) AS issue_id, arg_min(status, finding_id) AS status "
    "FROM issue_rows WHERE table_name = 'legacy_finance' GROUP BY row_identifier) i ON i.row_identifier = f.gl_entry_id")))
def failures_with_issue(spark, sf):
    rows = job(spark, sf).issue_rows
    return M.with_issue(_orphan_vendors(spark, sf).select("gl_entry_id", "vendor_id"), "gl_entry_id", "legacy_finance", rows)


STATS = "stats AS (" + " UNION ALL ".join(_stats(k) for k in KEYS) + ")"
REPORT = " UNION ALL ".join(
    [f"SELECT 'row_count' AS section, 'target_{k}' AS \"check\", 'INFO' AS status, count(*) AS value FROM {SHORT[k]}" for k in KEYS]
    + [f"SELECT 'cost_centre', table_name || '.{s}', 'INFO', {s} FROM stats"
       for s in ("already_canonical", "fixed", "left_null", "unrecognised")]
    + ["SELECT 'vendors', 'consolidated', 'INFO', count(DISTINCT cluster) FROM vcl",
       "SELECT 'vendors', 'raw_variants', 'INFO', count(*) FROM vcl",
       f"SELECT 'referential', 'target_finance.vendor_id', CASE WHEN count(*) = 0 THEN 'PASS' ELSE 'FAIL' END, count(*) FROM ({FK_VENDOR}) v",
       f"SELECT 'referential', 'target_expenses.employee_id', CASE WHEN count(*) = 0 THEN 'PASS' ELSE 'FAIL' END, count(*) FROM ({FK_EMPLOYEE}) e",
       "SELECT 'consistency', 'cost_centre', CASE WHEN sum(unrecognised) = 0 THEN 'PASS' ELSE 'FAIL' END, CAST(sum(unrecognised) AS BIGINT) FROM stats",
       "SELECT 'issues', status, 'INFO', count(*) FROM issue_rows GROUP BY status"])


@query("M9_validation_report", with_ctes(ALL, *CHAIN, STATS, select=REPORT))
def validation_report(spark, sf):
    return job(spark, sf).validation


@query("M10_derived_status", with_ctes("hr", select=(
    f"SELECT employee_id, CASE WHEN termination_date IS NULL OR termination_date > DATE '{AS_OF}' THEN 'Active' "
    "ELSE 'Terminated' END AS status FROM hr")))
def derived_status(spark, sf):
    return M.map_table(view(spark, sf, "hr"), default_spec()["hr"]).select(
        "employee_id", M.derived_status(F.col("termination_date"), AS_OF).alias("status"))


# --- migration ------------------------------------------------------------------------


@query("R1_policy_actions", with_ctes(ALL, *CHAIN, select=(
    "SELECT issue_id, row_identifier, CASE WHEN issue_type IN ('obsolete_orphaned', 'accuracy') THEN 'hold' ELSE 'flag' END "
    "AS action FROM issue_rows WHERE status = 'Open' AND issue_type <> 'consistency'")))
def policy_actions(spark, sf):
    return P.with_action(job(spark, sf).issue_rows).select("issue_id", "row_identifier", "action")


@query("R2_held_rows", with_ctes(ALL, *CHAIN, select="SELECT domain, table_name, row_identifier, issue_id, finding_id, reason FROM held"))
def held_rows(spark, sf):
    return job(spark, sf).held


@query("R3_flagged_rows", with_ctes(ALL, *CHAIN, select="SELECT table_name, row_identifier, finding_id, issue_id FROM flags"))
def flagged_rows(spark, sf):
    return P.flagged_rows(job(spark, sf).issue_rows)


for _key in KEYS:
    @query(f"R4_migrated_{_key}", with_ctes(ALL, *CHAIN, sql_target(_key), select=f"SELECT * FROM target_{SHORT[_key]}"))
    def migrated_table(spark, sf, key=_key):
        return job(spark, sf).target(key)


def _counts_sql() -> str:
    return "counts AS (" + " UNION ALL ".join(
        f"SELECT '{DOMAINS[k].table}' AS table_name, (SELECT count(*) FROM {SHORT[k]}) AS source_rows, "
        f"(SELECT count(*) FROM target_{SHORT[k]}) AS target_rows, (SELECT count(DISTINCT row_identifier) FROM held "
        f"WHERE table_name = '{DOMAINS[k].table}') AS held_rows" for k in KEYS) + ")"


COUNTS = _counts_sql()


COUNTED = with_ctes(ALL, *CHAIN, *TARGETS, COUNTS, select=(
    "SELECT table_name, source_rows, target_rows, target_rows - source_rows AS delta, -held_rows AS expected_delta, "
    "CASE WHEN target_rows = source_rows AND held_rows = 0 THEN 'CLEAN' WHEN target_rows - source_rows = -held_rows "
    "THEN 'EXPECTED DELTA' ELSE 'UNEXPECTED DELTA' END AS status FROM counts"))


@query("R5_row_counts", COUNTED)
def row_counts(spark, sf):
    return job(spark, sf).counts


@query("R6_held_listing", with_ctes(ALL, *CHAIN, select=(
    "SELECT table_name, row_identifier, issue_id, reason FROM held WHERE table_name = 'legacy_finance'")))
def held_listing(spark, sf):
    return R.held_listing(job(spark, sf).held, "legacy_finance")


# targets with planted drift, lost and invented rows, so that every state occurs in every table
CHANGED_COLUMN = {"hr": ("job_title", "'changed'"), "finance": ("amount", "amount + 1"), "procurement": ("quantity", "quantity + 1"),
                  "expenses": ("amount", "amount + 1")}


def _damaged(target, key):
    column, changed = CHANGED_COLUMN[key]
    row_id, number = DOMAINS[key].row_id, number_of(key)
    kept = target.filter(number % 401 != 7)
    drifted = kept.withColumn(column, F.when(number % 307 == 5, F.expr(changed)).otherwise(F.col(column)))
    extra = target.filter(number % 503 == 9).withColumn(row_id, F.concat(F.lit("X"), row_id))
    return drifted.unionByName(extra)


def _damaged_sql(key: str) -> str:
    (column, changed), row_id, number, short = CHANGED_COLUMN[key], DOMAINS[key].row_id, NUMBER[key], SHORT[key]
    return (f"damaged_{short} AS (SELECT * REPLACE (CASE WHEN {number} % 307 = 5 THEN {changed} ELSE {column} END AS {column}) "
            f"FROM target_{short} WHERE {number} % 401 <> 7 UNION ALL SELECT * REPLACE ('X' || {row_id} AS {row_id}) "
            f"FROM target_{short} WHERE {number} % 503 = 9)")


def _states_sql(key: str) -> str:
    row_id, short, table_name = DOMAINS[key].row_id, SHORT[key], DOMAINS[key].table
    differ = " OR ".join(f"s.{c} IS DISTINCT FROM t.{c}" for c in default_spec()[key].targets())
    return (f"states_{short} AS (SELECT '{table_name}' AS table_name, coalesce(s.{row_id}, t.{row_id}) AS key, "
            f"CASE WHEN s.{row_id} IS NULL THEN 'unexpected' WHEN t.{row_id} IS NULL THEN CASE WHEN s.{row_id} IN "
            f"(SELECT row_identifier FROM held WHERE table_name = '{table_name}') THEN 'held' ELSE 'missing' END WHEN {differ} "
            f"THEN 'drifted' ELSE 'matched' END AS state FROM mapped_{short} s FULL OUTER JOIN damaged_{short} t ON t.{row_id} = s.{row_id})")


CHECKSUM = (*CHAIN, *TARGETS, *MAPPED, *(_damaged_sql(k) for k in KEYS), *(_states_sql(k) for k in KEYS),
            "states AS (" + " UNION ALL ".join(f"SELECT * FROM states_{SHORT[k]}" for k in KEYS) + ")")


def _union(parts):
    return reduce(DataFrame.unionByName, parts)


def _comparisons(spark, sf):
    j = job(spark, sf)
    # the damage is planted as rows are read: a written copy of every target would take as much disk as the targets
    return R.compare_all(j.sources, {k: _damaged(j.target(k), k) for k in KEYS}, j.specs, j.held)


@query("R7_row_checksums", with_ctes(ALL, *CHECKSUM, select="SELECT table_name, key, state FROM states"))
def row_checksums(spark, sf):
    """Every row id of every table, compared row by row."""
    j = job(spark, sf)
    return _union([
        R.row_checksums(j.sources[k], _damaged(j.target(k), k), j.specs[k], DOMAINS[k].row_id, j.held).select(
            F.lit(DOMAINS[k].table).alias("table_name"), "key", "state") for k in KEYS])


@query("R7_range_differences", with_ctes(ALL, *CHECKSUM, select=(
    "SELECT table_name, key, state FROM states WHERE state NOT IN ('matched', 'held')")))
def range_differences(spark, sf):
    """The rows that differ, found by reading only the ids whose sums differ in key ranges whose fingerprints differ."""
    return _union([c.changed().select(F.lit(c.spec.source_table).alias("table_name"), "key", "state")
                   for c in _comparisons(spark, sf).values()])


@query("R7_checksum_summary", with_ctes(ALL, *CHECKSUM, select=(
    "SELECT table_name, " + ", ".join(f"count(*) FILTER (state = '{s}') AS {s}" for s in R.STATES)
    + ", CASE WHEN count(*) FILTER (state IN ('drifted', 'missing', 'unexpected')) = 0 THEN 'CLEAN' ELSE 'DRIFT' END AS status "
      "FROM states GROUP BY table_name")))
def checksum_summary(spark, sf):
    return _union([c.summary() for c in _comparisons(spark, sf).values()])


@query("R8_column_drift", with_ctes(ALL, *CHECKSUM, select=" UNION ALL ".join(
    f"SELECT '{DOMAINS[k].table}' AS table_name, '{c}' AS column_name, count(*) AS compared, "
    f"count(*) FILTER (s.{c} IS DISTINCT FROM t.{c}) AS drifted FROM mapped_{SHORT[k]} s JOIN damaged_{SHORT[k]} t "
    f"ON t.{DOMAINS[k].row_id} = s.{DOMAINS[k].row_id}" for k in KEYS for c in default_spec()[k].targets() if c != DOMAINS[k].row_id)))
def column_drift(spark, sf):
    return _union([c.column_drift() for c in _comparisons(spark, sf).values()])


def _rule_sql(key: str, expression: str, rule: str, group: str | None = None) -> str:
    short, d = SHORT[key], DOMAINS[key]
    g = f"CAST({group} AS VARCHAR)" if group else "'all'"
    cast = f"CAST({expression} AS DECIMAL(28,8))"
    left, right = (f"CAST(coalesce(sum({x}), 0) AS DECIMAL(28,2))" for x in "st")
    kept = (f"SELECT {g} AS group_value, {cast} AS s, NULL AS t FROM {short} WHERE {d.row_id} NOT IN (SELECT row_identifier "
            f"FROM held WHERE table_name = '{d.table}')")
    return (f"SELECT '{rule}' AS rule, group_value, CAST({left} AS DOUBLE) AS source_total, "
            f"CAST({right} AS DOUBLE) AS target_total, CASE WHEN abs({left} - {right}) "
            f"< 0.01 THEN 'PASS' ELSE 'FAIL' END AS status FROM ({kept} UNION ALL SELECT {g}, NULL, {cast} FROM "
            f"target_{short}) u GROUP BY group_value")


PO_VALUE = "CAST(quantity AS DECIMAL(18,2)) * CAST(unit_price AS DECIMAL(18,6))"
RULES = {
    "R9_expense_total": ("expenses", "amount", "total expense amount"),
    "R10_order_value": ("procurement", PO_VALUE, "total order value"),
    "R11_finance_total": ("finance", "amount", "total finance amount"),
}
for _name, (_key, _expression, _rule) in RULES.items():
    @query(_name, with_ctes(ALL, *CHAIN, sql_target(_key), select=_rule_sql(_key, _expression, _rule)))
    def business_total(spark, sf, key=_key):
        j = job(spark, sf)
        return R.standard_rules(j.sources, {key: j.target(key)}, j.held, [key])


@query("R9_expenses_by_centre", with_ctes(ALL, *CHAIN, sql_target("expenses"), select=_rule_sql(
    "expenses", "amount", "expenses by cost centre", CODE)))
def expenses_by_centre(spark, sf):
    j = job(spark, sf)
    return R.compare_totals(j.sources["expenses"], j.target("expenses"), F.col("amount"), j.held, "legacy_expenses", "expense_id",
                            "expenses by cost centre", COST_CENTRE.normalise(F.col("cost_centre")))


@query("R10_orders_by_vendor", with_ctes(ALL, *CHAIN, sql_target("procurement"), select=_rule_sql(
    "procurement", PO_VALUE, "order value by vendor", "vendor_id")))
def orders_by_vendor(spark, sf):
    j = job(spark, sf)
    return R.compare_totals(j.sources["procurement"], j.target("procurement"), R.order_value(), j.held, "legacy_procurement", "po_id",
                            "order value by vendor", F.col("vendor_id"))


@query("R11_finance_by_account", with_ctes(ALL, *CHAIN, sql_target("finance"), select=_rule_sql(
    "finance", "amount", "finance by account", "account_code")))
def finance_by_account(spark, sf):
    j = job(spark, sf)
    return R.compare_totals(j.sources["finance"], j.target("finance"), F.col("amount"), j.held, "legacy_finance", "gl_entry_id",
                            "finance by account", F.col("account_code"))


@query("R12_inclusion_counts", with_ctes(ALL, *CHAIN, *TARGETS, select=" UNION ALL ".join(
    f"SELECT '{DOMAINS[k].table}' AS table_name, (SELECT count(*) FROM target_{SHORT[k]} WHERE migration_status = "
    f"'migrated_with_flag') AS flagged_in, (SELECT count(DISTINCT row_identifier) FROM held WHERE table_name = "
    f"'{DOMAINS[k].table}') AS held_out" for k in KEYS)))
def inclusion_counts(spark, sf):
    return job(spark, sf).inclusions


@query("R13_target_deltas", with_ctes(ALL, *CHAIN, *TARGETS, COUNTS, select=(
    "SELECT table_name, target_rows, target_rows - source_rows AS delta FROM counts")))
def target_deltas(spark, sf):
    return R.target_deltas(job(spark, sf).counts)


@query("R14_headline", with_ctes(ALL, *CHAIN, *TARGETS, COUNTS, *MAPPED, select=(
    "SELECT count(*) AS checks, count(*) FILTER (NOT ok) AS failed, CASE WHEN bool_and(ok) THEN "
    "'Reconciles cleanly against migration policy' ELSE 'Does not reconcile with migration policy' END AS headline FROM ("
    "SELECT target_rows - source_rows = -held_rows AS ok FROM counts UNION ALL "
    + " UNION ALL ".join(
        f"SELECT (SELECT count(*) FROM mapped_{SHORT[k]} m WHERE NOT EXISTS (SELECT 1 FROM target_{SHORT[k]} t WHERE "
        + " AND ".join(f"t.{c} IS NOT DISTINCT FROM m.{c}" for c in default_spec()[k].targets())
        + f") AND m.{DOMAINS[k].row_id} NOT IN (SELECT row_identifier FROM held WHERE table_name = '{DOMAINS[k].table}')) = 0"
        for k in KEYS)
    + " UNION ALL " + " UNION ALL ".join(
        f"SELECT status = 'PASS' FROM ({_rule_sql(k, e, r)}) r" for k, e, r in RULES.values()) + ") c")))
def headline(spark, sf):
    return job(spark, sf).headline


@query("whole_migration", with_ctes(ALL, *CHAIN, *TARGETS, COUNTS, select=(
    "SELECT 'discovery_findings' AS table_name, count(*) AS n FROM findings UNION ALL SELECT 'issue_log', count(*) FROM issue_rows "
    "UNION ALL SELECT 'resolutions', count(*) FROM settled UNION ALL SELECT 'person_clusters', count(*) FROM pc "
    "UNION ALL SELECT 'vendor_clusters', count(*) FROM vcl UNION ALL SELECT 'target_vendor_master', count(*) FROM vmaster "
    "UNION ALL SELECT 'target_hr_master', count(*) FROM hr UNION ALL SELECT 'hr_duplicate_review', count(*) FROM review "
    "UNION ALL SELECT 'held_rows', count(*) FROM held UNION ALL SELECT 'row_counts', count(*) FROM counts UNION ALL "
    + " UNION ALL ".join(f"SELECT '{default_spec()[k].target_table}', count(*) FROM target_{SHORT[k]}" for k in KEYS))))
def whole_migration(spark, sf):
    """The job run in one go and published; the rows of its tables, as the published version states them."""
    folder = new_path(spark, "published")
    run(staged_sources(spark, sf), AS_OF, earliest=EARLIEST, publish_to=folder)
    rows = version(spark, folder).rows
    few = ("checksums", "business_rules", "headline", "validation_report", "kpi_impact")
    return spark.createDataFrame([(n, c) for n, c in rows.items() if n not in few], "table_name string, n bigint")


# --- figures ------------------------------------------------------------------------------


@query("K1_figures_before", with_ctes(ALL, *CHAIN, BEFORE, select="SELECT * FROM before"))
def figures_before(spark, sf):
    return figures(spark, sf)[0]


@query("K2_figures_after", with_ctes(ALL, *CHAIN, sql_target("finance"), AFTER, select="SELECT * FROM after_"))
def figures_after(spark, sf):
    return figures(spark, sf)[1]


@query("K3_impact_table", with_ctes(ALL, *KPI, select=IMPACT_SELECT))
def impact_table(spark, sf):
    return KP.impact_table(*figures(spark, sf))


def _m(e: str) -> str:
    return f"CAST(coalesce({e}, 0) AS DOUBLE)"


@query("K4_impact_deltas", with_ctes(ALL, *CHAIN, sql_target("finance"), BEFORE, AFTER, select=f"""
  SELECT o.code AS cost_centre, fragment_rows, {_m('fragment_total')} AS fragment_total, main_rows,
    {_m('main_total')} AS main_total, a.row_count AS merged_rows, a.total_amount AS merged_total,
    CAST(main_total - CAST(a.total_amount AS DECIMAL(28,2)) AS DOUBLE) AS delta,
    CASE WHEN main_total > CAST(a.total_amount AS DECIMAL(28,2)) THEN 'higher' ELSE 'lower' END AS direction
  FROM (SELECT code, CAST(coalesce(sum(row_count) FILTER (cost_centre IS DISTINCT FROM code), 0) AS BIGINT) AS fragment_rows,
      coalesce(sum(CAST(total_amount AS DECIMAL(28,2))) FILTER (cost_centre IS DISTINCT FROM code), 0) AS fragment_total,
      CAST(coalesce(sum(row_count) FILTER (cost_centre IS NOT DISTINCT FROM code), 0) AS BIGINT) AS main_rows,
      coalesce(sum(CAST(total_amount AS DECIMAL(28,2))) FILTER (cost_centre IS NOT DISTINCT FROM code), 0) AS main_total
    FROM (SELECT *, {CODE} AS code FROM before) b GROUP BY code) o
  JOIN after_ a ON a.cost_centre IS NOT DISTINCT FROM o.code"""))
def impact_deltas(spark, sf):
    return KP.impact_deltas(*figures(spark, sf))


@query("K5_scenario_guard", with_ctes(ALL, FINDINGS, ISSUES, *RESOLVED, select=(
    "SELECT f.cost_centre, i.issue_id, i.status FROM fin f JOIN issue_rows i ON i.row_identifier = f.gl_entry_id "
    "AND i.detection_rule = 'cost_centre_format_drift' WHERE f.gl_entry_id = 'GL-000000005'")))
def scenario_guard(spark, sf):
    j = job(spark, sf)
    # order 5 is always among the drifted rows: 5 % 97 = 5, centre 5 % 15 + 1
    row = "GL-000000005"
    issue = j.issue_rows.filter((F.col("row_identifier") == row) & (F.col("detection_rule") == "cost_centre_format_drift"))
    number = issue.select("issue_id").first()[0]
    KP.require_scenario(j.sources["finance"], "gl_entry_id", row, "cost_centre", "006", j.issues, number)
    return issue.join(j.sources["finance"].withColumnRenamed("gl_entry_id", "row_identifier"), "row_identifier").select(
        "cost_centre", "issue_id", "status")


@query("K9_scenario_rows", with_ctes(ALL, *KPI, select=f"SELECT * FROM ({IMPACT_SELECT}) i WHERE scenario = 'before'"))
def scenario_rows(spark, sf):
    return KP.scenario_rows(KP.impact_table(*figures(spark, sf)), "BEFORE")


@query("K10_money_rows", with_ctes("fin", select=(
    "SELECT cost_centre, '| ' || coalesce(cost_centre, 'None') || ' | ' || CAST(count(*) AS VARCHAR) || ' | GBP ' || "
    "format('{:,.2f}', " + money("amount") + ") || ' |' AS line FROM fin GROUP BY cost_centre")))
def money_rows(spark, sf):
    return KP.money_rows(KP.grouped_total(view(spark, sf, "finance")))

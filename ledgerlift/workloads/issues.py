"""Queries for the issue log and its resolutions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlift.operators import clusters as K
from ledgerlift.operators import wording as W
from ledgerlift.operators import inject as J
from ledgerlift.plans.incremental import first_state, next_state
from ledgerlift.workloads.base import *  # noqa: F403


IMPACT = IMPACT_TEXT
LOGGED = (FINDINGS, ISSUES)
SETTLED = (FINDINGS, ISSUES, *RESOLVED)


@query("I1_issue_log", with_ctes(ALL, *SETTLED, select=(
    f"SELECT issue_id, domain, table_name, column_name, issue_type, description, {CAUSE} AS root_cause, "
    f"{IMPACT} AS business_impact, status, resolution FROM issue_rows")))
def issue_log(spark, sf):
    return I.issue_log(job(spark, sf).issues)


@query("I2_root_causes", with_ctes(ALL, FINDINGS, select=(
    f"SELECT finding_id, {CAUSE} AS root_cause FROM findings")))
def root_causes(spark, sf):
    return I.lookup_text(job(spark, sf).findings, W.ROOT_CAUSES, W.ROOT_CAUSE_BY_TYPE, W.ROOT_CAUSE_DEFAULT,
                         "root_cause").select("finding_id", "root_cause")


@query("I3_business_impacts", with_ctes(ALL, FINDINGS, select=(
    f"SELECT finding_id, {IMPACT} AS business_impact FROM findings")))
def business_impacts(spark, sf):
    return I.lookup_text(job(spark, sf).findings, W.BUSINESS_IMPACTS, W.IMPACT_BY_TYPE, W.IMPACT_DEFAULT,
                         "business_impact").select("finding_id", "business_impact")


@query("I4_issue_rows", with_ctes(ALL, *SETTLED, select=(
    "SELECT issue_id, row_identifier, table_name, detection_rule, status FROM issue_rows")))
def issue_rows(spark, sf):
    return job(spark, sf).issue_rows.select("issue_id", "row_identifier", "table_name", "detection_rule", "status")


def _numbered(resolutions, rows):
    return resolutions.join(rows.select("finding_key", "issue_id"), "finding_key").select("issue_id", "status", "note")


@query("I5_mark_resolved", with_ctes(ALL, *LOGGED, DRIFT, select=(
    f"SELECT i.issue_id, CASE WHEN d.issue_id IS NULL THEN 'Open' ELSE 'Resolved' END AS status, "
    f"coalesce({DRIFT_NOTE}, 'Pending') AS resolution FROM issue_open i LEFT JOIN drift d ON d.issue_id = i.issue_id")))
def mark_resolved(spark, sf):
    j = job(spark, sf)
    settled = stage(I.resolve_code_drift(j.logged_rows, j.sources), "resolutions")
    return I.apply_resolutions(j.log, settled).select("issue_id", "status", "resolution")


@query("I5_incremental_findings", with_ctes(ALL, FINDINGS, select=(
    "SELECT domain, table_name, column_name, row_identifier, issue_type, description, confidence, detection_rule FROM raw_findings")))
def incremental_findings(spark, sf):
    """Findings after a tenth of all rows came in, from the state before."""
    src = job(spark, sf).sources
    # the load before is read from the written sources; another copy of them would only take disk
    before = {k: df.filter(number_of(k) % 10 != 3) for k, df in src.items()}
    after = next_state(first_state(before, AS_OF, EARLIEST), src, AS_OF, EARLIEST)
    return after.findings.drop("check_order", "finding_key")


@query("I6_annotated", with_ctes(ALL, *LOGGED, select=(
    "SELECT issue_id, status, CASE WHEN issue_type = 'accuracy' THEN 'checked with the source team: ' || row_identifier "
    "ELSE 'Pending' END AS resolution FROM issue_open")))
def annotated(spark, sf):
    log, rows = job(spark, sf).log, job(spark, sf).logged_rows
    note = F.concat(F.lit("checked with the source team: "), "row_identifier")
    return I.apply_resolutions(log, I.annotate(rows.filter("issue_type = 'accuracy'"), note)).select(
        "issue_id", "status", "resolution")


@query("I7_ground_truth_guard", with_ctes(ALL, *LOGGED, select=(
    "SELECT issue_id, row_identifier FROM issue_open WHERE row_identifier NOT IN (SELECT expense_id FROM exp "
    "WHERE CAST(substr(expense_id, 5) AS BIGINT) % 100 = 0)")))
def ground_truth_guard(spark, sf):
    src, rows = job(spark, sf).sources, job(spark, sf).logged_rows
    number = F.expr("cast(substr(expense_id, 5) as bigint) % 100")
    manifest = J.plant(src["expenses"], DOMAINS["expenses"], J.standard_defects("expenses"), number)[1]
    return I.not_blocked(rows, manifest).select("issue_id", "row_identifier")


@query("I8_resolve_code_drift", with_ctes(ALL, *LOGGED, DRIFT, select=(
    f"SELECT issue_id, 'Resolved' AS status, {DRIFT_NOTE} AS note FROM drift")))
def resolve_code_drift(spark, sf):
    rows = job(spark, sf).logged_rows
    return _numbered(I.resolve_code_drift(rows, job(spark, sf).sources), rows)


# targets of which every hundredth row was written with another code
def _written(key: str) -> str:
    return (f"SELECT {DOMAINS[key].row_id} AS row_identifier, {CODE} AS wanted, CASE WHEN {NUMBER[key]} % 100 = 3 THEN 'CC-000' "
            f"ELSE {CODE} END AS written FROM {SHORT[key]}")


@query("I8_repair_disagreements", with_ctes(ALL, select=" UNION ALL ".join(
    f"SELECT '{DOMAINS[k].table}' AS table_name, * FROM ({_written(k)}) t_{k} WHERE wanted IS DISTINCT FROM written" for k in KEYS)))
def repair_disagreements(spark, sf):
    src, specs = job(spark, sf).sources, default_spec()
    written = {
        k: stage(df.withColumn("cost_centre", F.when(number_of(k) % 100 == 3, "CC-000").otherwise(F.col("cost_centre"))), f"written-{k}")
        for k, df in map_all(src).items()}
    return I.code_repair_disagreements(src, written, specs)


@query("I9_resolve_contradiction", with_ctes(ALL, *LOGGED, select=CONTRADICTIONS))
def resolve_contradiction(spark, sf):
    rows = job(spark, sf).logged_rows
    return _numbered(I.resolve_status_contradiction(rows, default_spec()["hr"]), rows)


@query("I10_resolve_vendor_duplicates", with_ctes(ALL, *LOGGED, *VENDOR_TABLES, *VENDOR_NOTES, select="SELECT * FROM vendor_notes"))
def resolve_vendor_duplicates(spark, sf):
    j = job(spark, sf)
    return _numbered(I.resolve_vendor_duplicates(
        j.logged_rows, D.first_orders(j.vendor_orders), j.vendor_clusters, K.member_notes(j.vendor_clusters),
        j.vendor_master), j.logged_rows)


@query("I11_open_person_issues", with_ctes(ALL, *LOGGED, select=OPEN_PERSONS))
def open_person_issues(spark, sf):
    return I.open_person_duplicates(job(spark, sf).logged_rows).drop("finding_key")


@query("I12_resolve_persons", with_ctes(ALL, *LOGGED, *PERSON_NOTES, select="SELECT * FROM person_notes"))
def resolve_persons(spark, sf):
    j = job(spark, sf)
    return _numbered(I.resolve_persons(j.logged_rows, j.person_review), j.logged_rows)


@query("I12_resolve_persons_by_partner", with_ctes(ALL, *LOGGED, *PERSON_NOTES, select=(
    "SELECT o.issue_id, r.employee_id, r.partner_id, r.settle_gap FROM open_p o JOIN review r ON r.employee_id = o.row_identifier")))
def resolve_persons_by_partner(spark, sf):
    j = job(spark, sf)
    issues = I.open_person_duplicates(j.logged_rows).select("issue_id", F.col("row_identifier").alias("employee_id"))
    return issues.join(j.person_review, "employee_id").select("issue_id", "employee_id", "partner_id", "settle_gap")


REASON = "CASE issue_type " + " ".join(
    f"WHEN '{t}' THEN {quoted(r)}" for t, r in W.STILL_OPEN_REASONS) + f" ELSE {quoted(W.STILL_OPEN_DEFAULT)} END"


@query("I13_still_open", with_ctes(ALL, *SETTLED, select=(
    f"SELECT issue_type, {REASON} AS reason, issue_id, domain, column_name, finding_id FROM issue_rows "
    "WHERE status = 'Open'")))
def still_open(spark, sf):
    return I.still_open(job(spark, sf).issues)


@query("I14_status_counts", with_ctes(ALL, *SETTLED, select=(
    "SELECT status, count(*) AS issues FROM issue_rows GROUP BY status")))
def status_counts(spark, sf):
    return I.status_counts(job(spark, sf).issues)


@query("I15_domain_counts", with_ctes(ALL, FINDINGS, select=(
    "SELECT domain, count(*) AS findings FROM findings GROUP BY domain")))
def domain_counts(spark, sf):
    return C.domain_counts(job(spark, sf).findings)


@query("I15_domain_filter", with_ctes(ALL, FINDINGS, select=(
    "SELECT finding_id, row_identifier FROM findings WHERE domain = 'Finance'")))
def domain_filter(spark, sf):
    return C.findings_of(job(spark, sf).findings, "Finance").select("finding_id", "row_identifier")


@query("I16_totals", with_ctes(ALL, *SETTLED, HELD, select="""
  SELECT 'findings' AS metric, count(*) AS value FROM findings UNION ALL SELECT 'held_rows', count(*) FROM held UNION ALL
  SELECT 'vendor_master_rows', count(*) FROM vmaster UNION ALL
  SELECT 'canonical_vendors', count(DISTINCT canonical_vendor_name) FROM vmaster UNION ALL
  SELECT 'employee_master_rows', count(*) FROM hr"""))
def totals(spark, sf):
    j = job(spark, sf)
    return I.headline_totals(j.findings, j.held, j.vendor_master, j.person_master)

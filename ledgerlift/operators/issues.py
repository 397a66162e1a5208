"""Issue log: building, joining back to rows, and resolving in batches.

Resolutions are a table of their own, keyed by the finding key, so rebuilding the log
keeps them. Applying them is one join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlift.functions.codes import COST_CENTRE, CodeFormat
from ledgerlift.functions.text import percent_text
from ledgerlift.operators import wording as W
from ledgerlift.operators.skew import meet
from ledgerlift.schemas import DOMAINS, ISSUE_COLUMNS
from ledgerlift.sources.spec import DomainSpec

OPEN, RESOLVED = "Open", "Resolved"
LOG_COLUMNS = ("issue_id", "domain", "table_name", "column_name", "issue_type", "description", "root_cause", "business_impact",
               "status", "resolution", "finding_id", "finding_key")


def lookup_text(df: DataFrame, rules: Sequence[tuple], by_type: Sequence[tuple], default: str,
                out: str) -> DataFrame:
    """Add text ``out``: by (rule, column), then by (rule, any column), then by type, then the default.

    The tables come from driver-side lists, so broadcasting them is bounded.
    """
    spark = df.sparkSession
    table = spark.createDataFrame(list(rules), "r string, c string, text string")
    exact = F.broadcast(table.filter("c IS NOT NULL").select(
        F.col("r").alias("detection_rule"), F.col("c").alias("column_name"), F.col("text").alias("_t1")))
    any_column = F.broadcast(table.filter("c IS NULL").select(
        F.col("r").alias("detection_rule"), F.col("text").alias("_t2")))
    types = F.broadcast(spark.createDataFrame(list(by_type), "issue_type string, _t3 string"))
    return (
        df.join(exact, ["detection_rule", "column_name"], "left")
        .join(any_column, "detection_rule", "left")
        .join(types, "issue_type", "left")
        .withColumn(out, F.coalesce("_t1", "_t2", "_t3", F.lit(default)))
        .drop("_t1", "_t2", "_t3")
    )


def issue_name(finding_id: Column) -> Column:
    """Display form only; joins use the number."""
    return F.format_string("ISSUE-%03d", finding_id)


def logged_rows(findings: DataFrame, resolutions: DataFrame | None = None) -> DataFrame:
    """The issue log of numbered findings with the row, rule and description of each finding.

    The columns of ``issues_with_rows``, but every issue is written beside its own finding,
    so the log is not joined to the findings it was made from and nothing is shuffled.
    """
    texts = lookup_text(findings, W.ROOT_CAUSES, W.ROOT_CAUSE_BY_TYPE, W.ROOT_CAUSE_DEFAULT, "root_cause")
    texts = lookup_text(texts, W.BUSINESS_IMPACTS, W.IMPACT_BY_TYPE, W.IMPACT_DEFAULT, "business_impact")
    log = texts.select(
        "finding_id", issue_name(F.col("finding_id")).alias("issue_id"), "domain", "table_name", "column_name", "issue_type",
        F.concat(F.lit("["), F.col("row_identifier"), F.lit("] "), F.col("description")).alias("description"),
        "root_cause", "business_impact", F.lit(OPEN).alias("status"), F.lit("Pending").alias("resolution"),
        "finding_key", "row_identifier", "detection_rule", F.col("description").alias("finding"),
    )
    return log if resolutions is None else apply_resolutions(log, resolutions, check=False)


def log_of(rows: DataFrame) -> DataFrame:
    """The log without the columns of the findings."""
    return rows.select(*LOG_COLUMNS)


def build_issues(findings: DataFrame, resolutions: DataFrame | None = None) -> DataFrame:
    """The issue log of numbered findings, with earlier resolutions applied again."""
    return log_of(logged_rows(findings, resolutions))


def apply_resolutions(issues: DataFrame, resolutions: DataFrame, check: bool = True) -> DataFrame:
    """Status and note of ``resolutions(finding_key, status, note)`` written to the log in one join.

    Several entries for an issue collapse before the join: Resolved wins over an
    annotation, then the greatest note. With ``check`` an unknown key raises; a rebuilt
    log may lack findings that are gone, so a rebuild does not check.
    """
    if check:
        unknown = meet(resolutions, issues.select("finding_key"), "finding_key", "left_anti").select("finding_key")
        missing = [r["finding_key"] for r in unknown.limit(5).collect()]
        if missing:
            raise ValueError(f"no issue for finding key(s) {', '.join(map(str, missing))}")
    best = resolutions.groupBy("finding_key").agg(
        F.max(F.struct((F.col("status") == RESOLVED).alias("done"), F.col("note"), F.col("status"))).alias("r"))
    merged = meet(issues, best, "finding_key", "left")
    kept = [c for c in issues.columns if c not in ("status", "resolution")]
    return merged.select(
        *kept, F.coalesce("r.status", "status").alias("status"),
        F.coalesce("r.note", "resolution").alias("resolution"),
    ).select(*issues.columns)


def resolve_by_issue_id(issues: DataFrame, notes: DataFrame) -> DataFrame:
    """Resolutions for ``notes(issue_id, note)``; an unknown id raises."""
    unknown = [r[0] for r in notes.join(issues, "issue_id", "left_anti").select("issue_id").limit(5).collect()]
    if unknown:
        raise ValueError(f"no issue with id {', '.join(unknown)}")
    return notes.join(issues.select("issue_id", "finding_key"), "issue_id").select(
        "finding_key", F.lit(RESOLVED).alias("status"), "note")


def annotate(issue_rows: DataFrame, note: Column) -> DataFrame:
    """A note on issues that stay open."""
    return issue_rows.select("finding_key", F.lit(OPEN).alias("status"), note.alias("note"))


def issues_with_rows(issues: DataFrame, findings: DataFrame) -> DataFrame:
    """Issues with the row, rule and description of their finding, joined on the number."""
    facts = findings.select("finding_id", "row_identifier", "detection_rule",
                            F.col("description").alias("finding"))
    return issues.join(facts, "finding_id")


def not_blocked(candidates: DataFrame, manifest: DataFrame | None) -> DataFrame:
    """Drop rows the ground truth calls completeness: those are never resolved."""
    if manifest is None:
        return candidates
    blocked = manifest.filter(F.col("issue_type") == "completeness").select("row_identifier").distinct()
    return candidates.join(blocked, "row_identifier", "left_anti")


def open_rows(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("status") == OPEN)


# --- resolvers: each returns resolutions(finding_key, status, note) -------------


def _resolved(df: DataFrame, note: Column) -> DataFrame:
    return df.select("finding_key", F.lit(RESOLVED).alias("status"), note.alias("note"))


def resolve_code_drift(rows: DataFrame, sources: dict[str, DataFrame], manifest: DataFrame | None = None,
                       column: str = "cost_centre", code: CodeFormat = COST_CENTRE) -> DataFrame:
    """Drift issues whose old value is not canonical and whose repaired value is.

    The repair is the expression that writes the target, so the two cannot disagree.
    """
    todo = not_blocked(
        open_rows(rows).filter((F.col("issue_type") == "consistency") & (F.col("column_name") == column)), manifest)
    old = None
    for key, df in sources.items():
        d = DOMAINS[key]
        part = df.select(F.lit(d.table).alias("table_name"), F.col(d.row_id).alias("row_identifier"),
                         F.col(column).alias("old")).filter(~code.matches(F.col("old")))
        old = part if old is None else old.unionByName(part)
    new = code.normalise(F.col("old"))
    return _resolved(
        todo.join(old, ["table_name", "row_identifier"]).filter(code.matches(new)),
        F.concat(F.lit(f"{column} normalised via canonical mapping in Stage 5: '"), F.col("old"),
                 F.lit("' -> '"), new, F.lit("'.")))


def code_repair_disagreements(sources: dict[str, DataFrame], mapped: dict[str, DataFrame],
                              specs: dict[str, DomainSpec], column: str = "cost_centre",
                              code: CodeFormat = COST_CENTRE) -> DataFrame:
    """Rows whose written target value is not the repaired source value; empty when all is well."""
    out = None
    for key, df in sources.items():
        d, target = DOMAINS[key], specs[key].target_of(column)
        wanted = df.select(F.col(d.row_id).alias("row_identifier"), code.normalise(F.col(column)).alias("wanted"))
        got = mapped[key].select(F.col(specs[key].target_of(d.row_id)).alias("row_identifier"),
                                 F.col(target).alias("written"))
        part = wanted.join(got, "row_identifier").filter(~F.col("wanted").eqNullSafe(F.col("written"))).select(
            F.lit(d.table).alias("table_name"), "row_identifier", "wanted", "written")
        out = part if out is None else out.unionByName(part)
    return out


def resolve_status_contradiction(rows: DataFrame, spec: DomainSpec, manifest: DataFrame | None = None) -> DataFrame:
    """Contradictions vanish when the redundant column is not migrated."""
    todo = not_blocked(open_rows(rows).filter(
        (F.col("issue_type") == "consistency") & (F.col("column_name") == "employment_status")
        & (F.col("detection_rule") == "status_date_contradiction")), manifest)
    return _resolved(todo.filter(F.lit(spec.drops("employment_status"))), F.lit(W.STATUS_DROPPED_NOTE))


def resolve_vendor_duplicates(rows: DataFrame, first_orders: DataFrame, clusters: DataFrame,
                              members: DataFrame, master: DataFrame,
                              manifest: DataFrame | None = None) -> DataFrame:
    """Vendor duplicates whose vendor shares its cluster with another; the note sums up the members.

    ``first_orders(vendor_id, first_po)`` tells a finding's vendor, as vendors are reported
    on their first order; the orders themselves are not read.
    """
    todo = not_blocked(open_rows(rows).filter(
        (F.col("issue_type") == "duplication") & (F.col("column_name") == "vendor_name")
        & F.col("detection_rule").isin("company_suffix_match", "fuzzy_name_match")), manifest)
    orders = first_orders.select(F.col("first_po").alias("row_identifier"), "vendor_id")
    named = (
        todo.join(orders, "row_identifier")
        .join(clusters.select("vendor_id", "cluster").distinct(), "vendor_id")
        .join(members.select("cluster", "member_ids"), "cluster")
        .join(master, "vendor_id")
    )
    return _resolved(named, F.concat(
        F.lit("Vendor name duplication resolved via target_vendor_master: "), F.col("member_ids"),
        F.lit(" consolidated to canonical name '"), F.col("canonical_vendor_name"), F.lit("' (Stage 5).")))


def open_person_duplicates(rows: DataFrame) -> DataFrame:
    """(row_identifier, finding_key, finding_id, issue_id) of open HR duplication issues."""
    return open_rows(rows).filter((F.col("domain") == "HR") & (F.col("issue_type") == "duplication")).select(
        "row_identifier", "finding_key", "finding_id", "issue_id")


def resolve_persons(rows: DataFrame, review: DataFrame, manifest: DataFrame | None = None) -> DataFrame:
    """The review settles the open issues of persons, whatever the size of a cluster.

    Where a likely duplicate settles the issue (``settle_gap`` of ``person_review``) it is
    resolved with the smallest hire gap in the note; otherwise it stays open with a note
    that names the best-scoring partner.
    """
    todo = not_blocked(open_person_duplicates(rows), manifest)
    facts = review.select(F.col("employee_id").alias("row_identifier"), "settle_gap", "named_partner_id", "named_score")
    likely = F.col("settle_gap").isNotNull()
    likely_note = F.concat(
        F.lit("Flagged as probable data-entry duplicate: same dept/cost_centre, hire dates "),
        F.col("settle_gap").cast("string"),
        F.lit(" days apart. Consolidation requires HR sign-off, not auto-merged."))
    review_note = F.concat(
        F.lit("Flagged as a possible near-duplicate of "), F.col("named_partner_id"), F.lit(" (similarity "),
        percent_text(F.col("named_score")),
        F.lit(") - see hr_duplicate_review table. dept_code/cost_centre/hire_date do not all align, "
              "so this needs HR business review; not auto-resolved."))
    return meet(todo, facts, "row_identifier").select(
        "finding_key", F.when(likely, RESOLVED).otherwise(OPEN).alias("status"),
        F.when(likely, likely_note).otherwise(review_note).alias("note"))


# --- listings ---------------------------------------------------------------------


def still_open(issues: DataFrame) -> DataFrame:
    """Open issues with the reason why this stage leaves them open."""
    reasons = F.broadcast(issues.sparkSession.createDataFrame(
        list(W.STILL_OPEN_REASONS), "issue_type string, reason string"))
    return (
        issues.filter(F.col("status") == OPEN).join(reasons, "issue_type", "left")
        .select("issue_type", F.coalesce("reason", F.lit(W.STILL_OPEN_DEFAULT)).alias("reason"),
                "issue_id", "domain", "column_name", "finding_id")
    )


def status_counts(issues: DataFrame) -> DataFrame:
    return issues.groupBy("status").agg(F.count(F.lit(1)).alias("issues"))


def issue_log(issues: DataFrame) -> DataFrame:
    """The ten published fields."""
    return issues.select(*ISSUE_COLUMNS)


def headline_totals(findings: DataFrame, held: DataFrame, vendors: DataFrame, persons: DataFrame) -> DataFrame:
    """(metric, value): findings, held rows, and rows and names of the two masters."""
    def metric(df: DataFrame, name: str, value: Column) -> DataFrame:
        return df.agg(value.cast("bigint").alias("value")).select(F.lit(name).alias("metric"), "value")

    n = F.count(F.lit(1))
    parts = [
        metric(findings, "findings", n), metric(held, "held_rows", n),
        metric(vendors, "vendor_master_rows", n),
        metric(vendors, "canonical_vendors", F.count_distinct("canonical_vendor_name")),
        metric(persons, "employee_master_rows", n),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out

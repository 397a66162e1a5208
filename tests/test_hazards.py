"""Hand-written rows for every semantic trap of the blueprint."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from ledgerlift.functions.codes import COST_CENTRE
from ledgerlift.functions.values import cast_to, money_sum, row_hash
from ledgerlift.operators import checks as C
from ledgerlift.operators import duplicates as D
from ledgerlift.operators import issues as I
from ledgerlift.operators import policy as P
from ledgerlift.operators import reconcile as R
from ledgerlift.plans.pipeline import Migration
from ledgerlift.operators.mapping import map_table
from ledgerlift.schemas import DOMAINS, SOURCE_SCHEMAS
from ledgerlift.sources.spec import default_spec

FINDING = ("finding_id bigint, domain string, table_name string, column_name string, row_identifier string, "
           "issue_type string, description string, confidence string, detection_rule string, finding_key string")


def finding(i, row, issue_type="accuracy", table="legacy_finance", column="currency", domain="Finance", rule="invalid_currency"):
    return (i, domain, table, column, row, issue_type, f"about {row}", "high", rule, f"key-{table}-{row}-{rule}-{i}")


def log_of(spark, rows):
    findings = spark.createDataFrame(rows, FINDING)
    log = I.build_issues(findings)
    return findings, log, I.issues_with_rows(log, findings)


def test_numbers_over_999_do_not_mix(spark):
    _, log, rows = log_of(spark, [finding(1, "a"), finding(100, "b"), finding(1000, "c")])
    assert {r["issue_id"]: r["row_identifier"] for r in rows.collect()} == {
        "ISSUE-001": "a", "ISSUE-100": "b", "ISSUE-1000": "c"}
    assert log.columns[:10] == ["issue_id", "domain", "table_name", "column_name", "issue_type", "description",
                                "root_cause", "business_impact", "status", "resolution"]


def test_null_keys_in_master_and_fact(spark):
    fact = spark.createDataFrame([("g1", None), ("g2", "V1"), ("g3", "V9"), ("g4", "V9")], "id string, k string")
    master = spark.createDataFrame([(None,), ("V1",)], "k string")
    assert {r["id"] for r in C.orphans(fact, "k", master, "k").collect()} == {"g3", "g4"}
    with_null = C.orphans(fact, "k", master, "k", include_null=True)
    assert sorted(r["id"] for r in with_null.collect()) == ["g1", "g3", "g4"]


def test_as_of_is_strict_in_the_check_and_inclusive_in_the_question(spark):
    from ledgerlift.operators.investigate import active_but_ended
    day = date(2024, 6, 1)
    hr = spark.createDataFrame([("E1", "Ann", "Active", day)],
                               "employee_id string, name string, employment_status string, termination_date date")
    assert C.apply_rules(hr, DOMAINS["hr"], [C.contradiction_rule(day)]).count() == 0
    assert active_but_ended(hr, day).count() == 1


def test_code_repair(spark):
    cases = {" 009": (" 009", "unrecognised"), "009\n": ("009\n", "unrecognised"), "C0071": ("C0071", "unrecognised"),
             "cc-001": ("cc-001", "unrecognised"), "009": ("CC-009", "fixed"), "C007": ("CC-007", "fixed"),
             "CC-001": ("CC-001", "already_canonical"), "": (None, "left_null"), "  ": (None, "left_null"),
             None: (None, "left_null"), "CC-001\n": ("CC-001\n", "unrecognised")}
    df = spark.createDataFrame([(k,) for k in cases], "c string")
    for r in df.select("c", COST_CENTRE.normalise(F.col("c")).alias("n"), COST_CENTRE.state(F.col("c")).alias("s")).collect():
        assert (r["n"], r["s"]) == cases[r["c"]], r["c"]
    assert {r["row_identifier"] for r in C.apply_rules(
        df.select(F.coalesce("c", F.lit("?")).alias("gl_entry_id"), F.col("c").alias("cost_centre")), DOMAINS["finance"],
        [C.format_rule()]).collect()} == {" 009", "009\n", "C0071", "cc-001", "009", "C007", "  ", "CC-001\n"}


def test_money_does_not_depend_on_order(spark):
    df = spark.createDataFrame([(0.1,), (0.2,), (0.3,)] * 50, "x double").repartition(7)
    assert str(df.agg(money_sum(F.col("x"))).first()[0]) == "30.00"
    assert str(df.filter("x > 1").agg(money_sum(F.col("x"))).first()[0]) == "0.00"


def test_casts(spark):
    text = spark.createDataFrame([("abc",), ("2.7",), (" 3 ",)], "t string")
    assert [r[0] for r in text.select(cast_to(F.col("t"), "BIGINT", lenient=True)).collect()] == [None, 3, 3]
    with pytest.raises(Exception):
        text.select(cast_to(F.col("t"), "BIGINT")).collect()
    numbers = spark.createDataFrame([(2.5,), (-2.5,), (2.4,)], "d double")
    assert [r[0] for r in numbers.select(cast_to(F.col("d"), "BIGINT")).collect()] == [3, -3, 2]


def test_row_hash_tells_null_positions_apart(spark):
    df = spark.createDataFrame([(1, None, "a"), (1, "a", None)], "i int, x string, y string")
    lo, hi = row_hash([F.col("i"), F.col("x"), F.col("y")])
    assert df.select(lo).distinct().count() == 2 and df.select(hi).distinct().count() == 2


def small(spark):
    fin = spark.createDataFrame(
        [(f"G{i}", cc, 400100, 10.0 * i, "GBP", date(2024, 1, i), "Invoice", "V1")
         for i, cc in enumerate(["CC-001", "001", "XX", "CC-001"], start=1)],
        "gl_entry_id string, cost_centre string, account_code bigint, amount double, currency string, posting_date date, "
        "document_type string, vendor_id string")
    return fin


def test_two_reasons_hold_a_row_once_and_tables_do_not_mix(spark):
    fin = small(spark)
    _, _, rows = log_of(spark, [
        finding(1, "G1"), finding(2, "G1", "obsolete_orphaned", column="vendor_id", rule="orphan_fk"),
        finding(3, "G2", table="legacy_hr", domain="HR"), finding(4, "G4", "completeness", rule="null_check"),
        finding(5, "G4", "duplication", rule="x"),
        finding(6, "G3", "consistency", column="cost_centre", rule="cost_centre_format_drift")])
    held = P.held_rows(rows)
    spec = default_spec()["finance"]
    from ledgerlift.operators.mapping import map_table
    target = P.migrate(map_table(fin, spec), spec, "gl_entry_id", P.row_actions(rows))
    got = {r["gl_entry_id"]: (r["migration_status"], r["issue_id"], r["cost_centre"]) for r in target.collect()}
    # the row of the other table with the same id stays; open consistency issues migrate as clean
    assert got == {"G2": ("clean", None, "CC-001"), "G3": ("clean", None, "XX"),
                   "G4": ("migrated_with_flag", "ISSUE-004", "CC-001")}
    counts = R.row_counts({"finance": fin}, {"finance": target}, held).filter("table_name = 'legacy_finance'").first()
    assert (counts["expected_delta"], counts["delta"], counts["status"]) == (-1, -1, "EXPECTED DELTA")
    states = {r["key"]: r["state"] for r in R.row_checksums(fin, target, spec, "gl_entry_id", held).collect()}
    assert states == {"G1": "held", "G2": "matched", "G3": "matched", "G4": "matched"}
    rule = R.compare_totals(fin, target, F.col("amount"), held, "legacy_finance", "gl_entry_id", "total").first()
    assert (rule["source_total"], rule["target_total"], rule["status"]) == (90.0, 90.0, "PASS")
    bad = R.compare_totals(fin, target.withColumn("amount", F.col("amount") + 1), F.col("amount"), held, "legacy_finance",
                           "gl_entry_id", "total")
    sums = R.checksum_summary(R.row_checksums(fin, target, spec, "gl_entry_id", held), "legacy_finance")
    ok = R.row_counts({"finance": fin}, {"finance": target}, held).filter("table_name = 'legacy_finance'")
    assert R.headline(ok, sums, bad).first()["headline"] == "Does not reconcile with migration policy"
    assert R.headline(ok, sums, bad.withColumn("status", F.lit("PASS"))).first()["failed"] == 0


def test_policy_is_a_table(spark):
    _, _, rows = log_of(spark, [finding(1, "G1", "consistency", rule="r")])
    assert P.held_rows(rows).count() == 0
    assert P.held_rows(rows, [("consistency", P.HOLD)]).count() == 1
    with pytest.raises(ValueError):
        P.held_rows(rows, [("nonsense", P.HOLD)])


def test_issue_types_are_closed(spark):
    with pytest.raises(ValueError):
        C.findings_from(small(spark), "Finance", "legacy_finance", "amount", "gl_entry_id", "odd", F.lit("x"), "high", "r")


def test_likely_pair_wins_over_later_review_pairs(spark):
    _, log, rows = log_of(spark, [finding(1, "E1", "duplication", "legacy_hr", "name", "HR", "exact_name_match"),
                                  finding(2, "E4", "duplication", "legacy_hr", "name", "HR", "exact_name_match")])
    review = spark.createDataFrame(
        [("E1", 3, "E2", 1.0), ("E2", None, "E1", 1.0), ("E4", None, "E5", 0.925)],
        "employee_id string, settle_gap int, named_partner_id string, named_score double")
    done = {r["issue_id"]: (r["status"], r["resolution"]) for r in I.apply_resolutions(
        log, I.resolve_persons(rows, review)).collect()}
    assert done["ISSUE-001"][0] == "Resolved" and "3 days apart" in done["ISSUE-001"][1]
    assert done["ISSUE-002"][0] == "Open" and "near-duplicate of E5 (similarity 92%)" in done["ISSUE-002"][1]


def test_a_blocked_pair_does_not_settle_its_issue(spark):
    _, _, rows = log_of(spark, [finding(1, "E1", "duplication", "legacy_hr", "name", "HR", "exact_name_match")])
    manifest = spark.createDataFrame([("E1", "completeness")], "row_identifier string, issue_type string")
    assert I.not_blocked(rows, manifest).count() == 0
    assert I.not_blocked(rows, None).count() == 1


def test_resolutions_survive_a_rebuild(spark):
    findings, log, rows = log_of(spark, [finding(1, "G1"), finding(2, "G2")])
    notes = spark.createDataFrame([("ISSUE-002", "fixed at source")], "issue_id string, note string")
    settled = I.resolve_by_issue_id(log, notes)
    again = I.build_issues(findings.withColumn("finding_id", F.col("finding_id") + 5), settled)
    assert {r["issue_id"]: r["status"] for r in again.collect()} == {"ISSUE-006": "Open", "ISSUE-007": "Resolved"}
    # applying twice changes nothing
    once = I.apply_resolutions(log, settled)
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, I.apply_resolutions(once, settled).collect()))
    with pytest.raises(ValueError):
        I.resolve_by_issue_id(log, spark.createDataFrame([("ISSUE-999", "x")], "issue_id string, note string"))
    with pytest.raises(ValueError):
        I.apply_resolutions(log, spark.createDataFrame([("nope", "Resolved", "x")], "finding_key string, status string, note string"))


def test_three_equal_names(spark):
    hr = spark.createDataFrame([("E1", "Ann Smith"), ("E2", "Ann Smith"), ("E3", "Ann Smith")],
                               "employee_id string, name string")
    rows = D.person_rows(hr)
    assert {(r["id"], r["other_id"]) for r in D.exact_matches(rows).collect()} == {("E2", "E1"), ("E3", "E1")}
    assert {(r["id"], r["other_id"]) for r in D.fuzzy_matches(rows).collect()} == {("E3", "E2")}


def test_initials(spark):
    hr = spark.createDataFrame([("E1", "Ann S."), ("E2", "Ann Smith"), ("E3", "Ann T."), ("E4", "Ann"), ("E5", "S")],
                               "employee_id string, name string")
    got = D.abbreviation_matches(D.person_rows(hr)).collect()
    assert [(r["id"], r["other_id"]) for r in got] == [("E2", "E1")]


def test_vendor_finding_sits_on_the_first_order(spark):
    orders = spark.createDataFrame([("PO-3", "V1", "Green-Kelly"), ("PO-2", "V2", "Green-Kelly Ltd"), ("PO-1", "V2", "Green-Kelly Ltd")],
                                   "po_id string, vendor_id string, vendor_name string")
    got = D.company_suffix_findings(D.company_rows(orders), orders).collect()
    assert [r["row_identifier"] for r in got] == ["PO-1"]
    assert got[0]["description"].startswith("Vendor 'Green-Kelly Ltd' (V2) matches 'Green-Kelly' (V1) once")


def test_order_value_is_rounded_once(spark):
    shape = "po_id string, quantity bigint, unit_price double"
    source = spark.createDataFrame([("P1", 1000, 0.004), ("P2", 1000, 0.004)], shape)
    target = spark.createDataFrame([("P1", 1000, 0.0049), ("P2", 1000, 0.004)], shape)
    held = P.held_rows(log_of(spark, [finding(1, "x")])[2])
    row = R.standard_rules({"procurement": source}, {"procurement": target}, held, ["procurement"]).first()
    assert (row["source_total"], row["target_total"], row["status"]) == (8.0, 8.9, "FAIL")


def _finance(spark, rows):
    """Finance rows of (id, amount), all other columns missing."""
    spec, schema = default_spec()["finance"], SOURCE_SCHEMAS["finance"]
    full = [tuple({"gl_entry_id": i, "amount": a}.get(f.name) for f in schema) for i, a in rows]
    return spec, spark.createDataFrame(full, schema)


def test_a_held_row_without_id_stays_behind(spark):
    spec, source = _finance(spark, [(None, 5.0), ("a", 6.0), ("b", 7.0)])
    rows = log_of(spark, [finding(1, None), finding(2, "b")])[2]
    held = P.held_rows(rows)
    target = P.migrate(map_table(source, spec), spec, "gl_entry_id", P.row_actions(rows))
    assert [r["gl_entry_id"] for r in target.collect()] == ["a"]
    count = R.row_counts({"finance": source}, {"finance": target}, held).first()
    assert (count["delta"], count["expected_delta"], count["status"]) == (-2, -2, "EXPECTED DELTA")
    total = R.standard_rules({"finance": source}, {"finance": target}, held, ["finance"]).first()
    assert (total["source_total"], total["status"]) == (6.0, "PASS")


def test_drift_of_repeated_ids(spark):
    spec, source = _finance(spark, [("a", 1.0), ("a", 2.0), ("b", 3.0)])

    def amount(rows):
        drift = R.column_drift(source, map_table(_finance(spark, rows)[1], spec), spec, "gl_entry_id")
        return {r["column_name"]: (r["compared"], r["drifted"]) for r in drift.collect()}["amount"]

    assert amount([("a", 2.0), ("a", 1.0), ("b", 3.0)]) == (2, 0)
    assert amount([("a", 1.0), ("a", 1.0), ("b", 3.0)]) == (2, 1)
    assert amount([("a", 1.0), ("b", 4.0)]) == (2, 2)


def test_missing_values_do_not_shift_finding_keys(spark):
    shape = FINDING.replace(", finding_key string", "").replace("finding_id bigint", "check_order int")
    rows = [(1, "Finance", "t", None, "x", "accuracy", "d", "high", "r"), (1, "Finance", "t", "x", None, "accuracy", "d", "high", "r")]
    keys = C.collect_findings([spark.createDataFrame(rows, shape)]).select("finding_key").distinct().count()
    assert keys == 2


def test_the_log_is_not_joined_to_its_own_findings(spark):
    findings = spark.createDataFrame([finding(1, "a"), finding(2, "a"), finding(3, "b", "duplication", rule="other")], FINDING)
    done = Migration({}, date(2024, 12, 31))
    done.__dict__["findings"] = findings
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for findings that are too many to broadcast
    try:
        assert "Exchange hashpartitioning" not in done.logged_rows._sc._jvm.PythonSQLUtils.explainString(
            done.logged_rows._jdf.queryExecution(), "simple")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    joined = I.issues_with_rows(I.build_issues(findings), findings)
    assert done.logged_rows.columns == joined.columns
    assert sorted(map(tuple, done.logged_rows.collect())) == sorted(map(tuple, joined.collect()))
    done.__dict__["resolutions"] = spark.createDataFrame(
        [(findings.first()["finding_key"], "Resolved", "so")], "finding_key string, status string, note string")
    assert {(r["issue_id"], r["row_identifier"], r["status"], r["resolution"]) for r in done.issue_rows.collect()} == {
        ("ISSUE-001", "a", "Resolved", "so"), ("ISSUE-002", "a", "Open", "Pending"), ("ISSUE-003", "b", "Open", "Pending")}
    assert done.issues.columns == I.build_issues(findings).columns and done.issues.count() == 3

"""Planted defects are found, and the whole job keeps its invariants."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from ledgerlift.operators import checks as C
from ledgerlift.operators import clusters as K
from ledgerlift.operators import duplicates as D
from ledgerlift.operators import inject as J
from ledgerlift.operators import kpi as KP
from ledgerlift.operators import score as S
from ledgerlift.plans.pipeline import Migration, run
from ledgerlift.schemas import DOMAINS
from ledgerlift.sources.spec import default_spec
from ledgerlift.sources.stages import stage
from ledgerlift.workloads.views import AS_OF, EARLIEST, views

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def planted(spark):
    changed, manifest = J.plant_all(views(spark, SF), buckets=40)
    return {k: stage(df, f"planted-{k}") for k, df in changed.items()}, stage(manifest, "manifest")


@pytest.fixture(scope="module")
def done(spark, planted):
    return run(planted[0], AS_OF, manifest=planted[1], earliest=EARLIEST)


def test_every_planted_defect_is_found(planted, done):
    manifest = planted[1]
    # a vendor copy is reported on the first order of the copied vendor, not on each of them
    rows = manifest.filter("issue_type <> 'duplication' or domain = 'HR'")
    assert S.missed(rows, done.findings).collect() == []
    total = S.recall(rows, done.findings).first()
    assert total["gate"] == "PASS" and total["planted"] == total["caught"] > 0


def test_numbers_are_dense_and_stable(spark, planted, done):
    ids = [r[0] for r in done.findings.select("finding_id").orderBy("finding_id").collect()]
    assert ids == list(range(1, len(ids) + 1))
    shuffled = done.findings.drop("finding_id").withColumn("check_order", F.create_map(*[
        x for k, v in C.ORDER.items() for x in (F.lit(k), F.lit(v))])[F.col("detection_rule")]).repartition(5)
    again = C.number_findings(shuffled)
    assert again.join(done.findings, ["finding_id", "finding_key"]).count() == len(ids)


def test_held_and_migrated_rows_make_up_the_source(planted, done):
    for key, source in planted[0].items():
        d = DOMAINS[key]
        ids = source.select(F.col(d.row_id).alias("id"))
        target = done.targets[key].select(F.col(default_spec()[key].target_of(d.row_id)).alias("id"))
        held = done.held.filter(F.col("table_name") == d.table).select(F.col("row_identifier").alias("id")).distinct()
        assert target.unionByName(held).exceptAll(ids).count() == 0
        assert ids.exceptAll(target.unionByName(held)).count() == 0


def test_the_job_reconciles(done):
    assert {r["status"] for r in done.counts.collect()} <= {"CLEAN", "EXPECTED DELTA"}
    assert {r["status"] for r in done.checksums.collect()} == {"CLEAN"}
    assert {r["status"] for r in done.rules.collect()} == {"PASS"}
    assert done.headline.first()["headline"] == "Reconciles cleanly against migration policy"


def test_resolved_issues_do_not_flag_rows(done):
    resolved = done.issues.filter("status = 'Resolved'")
    assert resolved.count() > 0
    flagged = done.targets["hr"].filter("issue_id is not null").select("issue_id")
    assert flagged.join(resolved, "issue_id").count() == 0
    kinds = {r["issue_type"] for r in resolved.select("issue_type").distinct().collect()}
    assert kinds == {"consistency", "duplication"}


def test_defects_never_share_a_row(spark):
    hr = views(spark, SF)["hr"]
    with pytest.raises(ValueError):
        J.plant(hr, DOMAINS["hr"], [J.contradiction(1, date(2023, 1, 1)), J.duplicate_person(1, "space")],
                J.hash_bucket("employee_id", 10))
    with pytest.raises(ValueError):
        J.Defect(0, "name", "odd", F.lit(1), F.lit("x"))


def test_code_repair_merges_a_split_figure(spark):
    before = spark.createDataFrame([("009", 1, -10.0), ("CC-009", 19, 100.5), ("CC-001", 2, 7.0), (None, 1, 1.0)],
                                   "cost_centre string, row_count bigint, total_amount double")
    after = spark.createDataFrame([("CC-009", 20, 90.5), ("CC-001", 2, 7.0), (None, 1, 1.0)],
                                  "cost_centre string, row_count bigint, total_amount double")
    hit = {(r["scenario"], r["cost_centre"]) for r in KP.impact_table(before, after).collect() if r["is_affected_by_cascade"]}
    assert hit == {("before", "009"), ("before", "CC-009"), ("after", "CC-009")}
    row = KP.impact_deltas(before, after).filter("cost_centre = 'CC-009'").first()
    assert (row["fragment_rows"], row["main_rows"], row["merged_rows"], row["delta"], row["direction"]) == (1, 19, 20, 10.0, "higher")
    with pytest.raises(RuntimeError):
        KP.require_scenario(before, "row_count", 1, "cost_centre", "008")


def test_vendor_names_clusters_and_first_orders_come_from_one_pass_over_the_orders(spark):
    """the orders were read once for names, once for first orders, once for counts and once for notes."""
    rows = [("PO-3", "V1", "acme global"), ("PO-1", "V1", "acme global ltd"), ("PO-2", "V2", "acme global"), ("PO-4", "V2", None),
            ("PO-5", None, "nobody"), (None, "V3", "others"), ("PO-1", "V1", "acme global ltd")]
    orders = spark.createDataFrame(rows, "po_id string, vendor_id string, vendor_name string")
    job = Migration({"procurement": orders}, AS_OF)
    assert job.vendor_orders.count() == 6
    job.sources["procurement"] = orders.withColumns({c: F.raise_error(F.lit("read again")).cast("string") for c in orders.columns})
    wanted = K.vendor_clusters(orders)
    assert job.vendor_clusters.exceptAll(wanted).count() == wanted.exceptAll(job.vendor_clusters).count() == 0
    assert sorted(D.first_orders(job.vendor_orders).collect(), key=str) == sorted(D.first_orders(orders).collect(), key=str)

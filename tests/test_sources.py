import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from ledgerlift.schemas import DOMAINS, SOURCE_SCHEMAS
from ledgerlift.sources import readers as RD
from ledgerlift.sources import sinks as SK
from ledgerlift.sources.spec import DEFAULT_COLUMNS, default_spec, load_spec
from ledgerlift.sources.stages import shared_dir, stage


def test_csv_keeps_edge_spaces_and_reads_blanks_as_null(spark, tmp_path):
    path = tmp_path / "legacy_hr.csv"
    path.write_text(
        "employee_id,name,dept_code,job_title,hire_date,termination_date,employment_status,cost_centre,manager_id\n"
        'E1,"Smith, Ann ",D1,Clerk,2020-01-02,,Active,,\n', encoding="utf-8")
    row = RD.read_csv(spark, str(path), SOURCE_SCHEMAS["hr"]).first()
    assert row["name"] == "Smith, Ann " and row["hire_date"] == date(2020, 1, 2)
    assert row["termination_date"] is None and row["cost_centre"] is None


def test_csv_with_a_bad_value_fails(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text("expense_id,employee_id,cost_centre,category,amount,submitted_date,approval_status,currency\n"
                    "X1,E1,CC-001,Meals,much,2024-01-01,Approved,GBP\n")
    with pytest.raises(Exception):
        RD.read_csv(spark, str(path), SOURCE_SCHEMAS["expenses"]).collect()


def test_csv_sink_reads_back(spark, tmp_path):
    df = spark.createDataFrame([("X1", 'say "hi", ok ', 1.5)], "a string, b string, c double")
    SK.save_csv(df, str(tmp_path / "out"))
    assert RD.read_csv(spark, str(tmp_path / "out"), df.schema).collect() == df.collect()


def test_manifest(spark, tmp_path):
    entries = [{"issue_id": "1", "domain": "HR", "table": "legacy_hr", "row_identifier": "E1", "column": "name",
                "issue_type": t, "description": "d"} for t in ("duplication", "completeness")]
    (tmp_path / "m.json").write_text(json.dumps(entries, indent=2))
    manifest = RD.read_manifest(spark, str(tmp_path / "m.json"))
    assert manifest.count() == 2
    assert RD.manifest_lookup(manifest).first()["issue_types"] == ["completeness", "duplication"]


def test_spec_file(tmp_path):
    content = {"domains": {k: {"legacy_table": f"legacy_{k}", "target_table": f"target_{k}", "mappings": [
        {"legacy_column": a, "target_column": b, "target_type": c} for a, b, c in columns]}
        for k, columns in DEFAULT_COLUMNS.items()}}
    (tmp_path / "spec.json").write_text(json.dumps(content))
    assert load_spec(str(tmp_path / "spec.json")) == default_spec()
    spec = default_spec()["hr"]
    assert spec.drops("employment_status") and spec.target_of("name") == "full_name"


def test_missing_tables_are_all_named(spark):
    with pytest.raises(RuntimeError, match="no_such_a, no_such_b"):
        RD.require_tables(spark, ["no_such_a", "no_such_b"])
    with pytest.raises(RuntimeError, match="finance"):
        RD.require_inputs({"hr": spark.range(1)}, ["hr", "finance"])


def test_table_sink_replaces(spark):
    SK.save_table(spark.range(3), "sink_test")
    SK.save_table(spark.range(2).withColumnRenamed("id", "n"), "sink_test")
    assert spark.table("sink_test").columns == ["n"] and spark.table("sink_test").count() == 2
    spark.sql("DROP TABLE sink_test")


def test_problem_statement(spark):
    issue = spark.createDataFrame(
        [("ISSUE-001", "HR", "t", "c", "accuracy", "a|b", "why", "so", "Open", "Pending")],
        "issue_id string, domain string, table_name string, column_name string, issue_type string, description string, "
        "root_cause string, business_impact string, status string, resolution string")
    lines = SK.problem_statements(issue).first()["document"].split("\n")
    assert lines[0] == "# ISSUE-001" and lines[2:4] == ["| Field | Value |", "|---|---|"]
    assert "| Description | a\\|b |" in lines and len(lines) == 15 and lines[-1] == ""


def test_stages_go_to_the_named_folder(spark):
    df = stage(spark.range(5).withColumn("x", F.lit("a")), "t")
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert all(shared_dir(spark) in f for f in df.inputFiles()) and df.count() == 5


def test_domains_match_their_schemas():
    for key, domain in DOMAINS.items():
        names = set(SOURCE_SCHEMAS[key].names)
        assert {domain.row_id, *domain.required, *domain.dates} <= names

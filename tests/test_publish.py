"""Published versions: whole or not at all, pinned readers, conflicts; a whole job published."""

import json
import os
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from ledgerlift.plans.pipeline import run
from ledgerlift.sources import publish as P
from ledgerlift.sources.stages import stage_counted
from ledgerlift.workloads.views import AS_OF, EARLIEST, views


def test_a_version_is_seen_whole_and_readers_stay_on_theirs(spark, tmp_path):
    root = str(tmp_path / "out")
    with pytest.raises(LookupError):
        P.version(spark, root)
    first = P.publish(spark, root, {"a": spark.range(10), "b": spark.range(3)})
    assert first.number == 1 and first.rows == {"a": 10, "b": 3}
    pinned = P.version(spark, root)
    second = P.publish(spark, root, {"a": spark.range(20), "b": spark.range(0)})
    assert P.versions(spark, root) == [1, 2] and second.rows == {"a": 20, "b": 0}
    assert pinned.table(spark, "a").count() == 10 and P.version(spark, root).table(spark, "a").count() == 20
    assert P.version(spark, root, 1).table(spark, "b").count() == 3 and P.version(spark, root).table(spark, "b").count() == 0
    with pytest.raises(KeyError):
        pinned.table(spark, "c")
    with pytest.raises(LookupError):
        P.version(spark, root, 7)


def test_a_run_that_dies_half_way_leaves_the_old_version(spark, tmp_path):
    root = str(tmp_path / "out")
    P.publish(spark, root, {"a": spark.range(10), "b": spark.range(3)})
    broken = spark.range(5).withColumn("x", F.raise_error(F.lit("lost half-way")))
    with pytest.raises(Exception, match="lost half-way"):
        P.publish(spark, root, {"a": spark.range(99), "b": broken})
    now = P.version(spark, root)
    assert now.number == 1 and now.table(spark, "a").count() == 10
    # a commit whose writer died before it was closed does not count either
    (tmp_path / "out" / "commits" / "2").write_text('{"folder": "ver')
    assert P.version(spark, root).number == 1
    assert P.publish(spark, root, {"a": spark.range(4)}).number == 3 and P.version(spark, root).number == 3


def test_of_two_runs_at_once_one_wins(spark, tmp_path):
    root = str(tmp_path / "out")
    base = P.publish(spark, root, {"a": spark.range(1)}).number

    def attempt(n):
        try:
            return P.publish(spark, root, {"a": spark.range(n)}, after=base).rows["a"]
        except P.Conflict:
            return None

    with ThreadPoolExecutor(3) as pool:
        done = [n for n in pool.map(attempt, (5, 6, 7)) if n]
    assert len(done) == 1 and P.version(spark, root).rows == {"a": done[0]}
    assert json.loads((tmp_path / "out" / "commits" / "2").read_text())["rows"] == {"a": done[0]}


def test_rows_are_counted_while_they_are_written(spark):
    seen = spark.sparkContext.accumulator(0)

    def touch(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    table, rows = stage_counted(spark.range(1000).mapInArrow(touch, "id long"), "counted")
    assert rows == 1000 and seen.value == 1000 and table.count() == 1000 and seen.value == 1000
    assert stage_counted(spark.range(0), "counted")[1] == 0


def test_the_job_leaves_named_tables(spark, tmp_path):
    root = str(tmp_path / "out")
    job = run(views(spark, "/root/testdata/sf0.001"), AS_OF, earliest=EARLIEST, publish_to=root)
    left = P.version(spark, root)
    assert {"issue_log", "target_vendor_master", "target_hr_master", "hr_duplicate_review", "validation_report", "kpi_impact",
            "row_counts", "checksums"} <= set(left.rows)
    assert left.rows["row_counts"] == 4 and set(os.listdir(left.folder.removeprefix("file:"))) == set(left.rows)
    counts = {r["table_name"]: r for r in left.table(spark, "row_counts").collect()}
    for key, source in job.sources.items():
        spec = job.specs[key]
        own = counts[spec.source_table]
        assert own["source_rows"] == source.count() and own["target_rows"] == left.table(spark, spec.target_table).count()
        assert own["status"] in ("CLEAN", "EXPECTED DELTA")
    held = {r["table_name"]: r["held_out"] for r in job.inclusions.collect()}
    assert held == {t: -r["expected_delta"] for t, r in counts.items()}


def test_a_lost_row_ends_the_job(spark, monkeypatch):
    from ledgerlift.operators import policy

    whole = policy.migrate
    monkeypatch.setattr(policy, "migrate", lambda *a, **k: whole(*a, **k).filter(F.rand(1) > 0.05))
    with pytest.raises(RuntimeError, match="rows gained or lost"):
        run(views(spark, "/root/testdata/sf0.001"), AS_OF, earliest=EARLIEST, fuzzy=False)

"""What a job leaves on disk: no shuffle files of written stages, no second copies, a part of a large exchange at a time."""

import os
import random
import time
from types import SimpleNamespace

import pytest
from test_clusters import components_of, solved
from test_fingerprints import SPEC, tables

from ledgerlift.operators import clusters as K
from ledgerlift.operators import reconcile as R
from ledgerlift.operators import skew
from ledgerlift.plans import incremental as N
from ledgerlift.sources import stages
from ledgerlift.sources.stages import shared_dir, stage, unstage
from ledgerlift.workloads import issues, migration
from ledgerlift.workloads.base import KEYS
from ledgerlift.workloads.views import views

SF = "/root/testdata/sf0.001"


def shuffle_files(spark):
    tops = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {f for top in tops for _, _, names in os.walk(top) for f in names if f.startswith("shuffle_")}


def folders(spark):
    return set(os.listdir(shared_dir(spark)))


def test_a_written_stage_keeps_no_shuffle_files(spark):
    before = shuffle_files(spark)
    kept = stage(spark.range(1000).repartition(7, "id").groupBy("id").count(), "shuffled")
    for _ in range(50):  # files go a moment after the query
        if not (left := shuffle_files(spark) - before):
            break
        time.sleep(0.2)
    assert not left and kept.count() == 1000
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None) != "true"


def test_only_named_stages_are_removed(spark):
    one, two = stage(spark.range(3), "one-stage"), stage(spark.range(4), "two-stage")
    unstage(one.unionByName(two), "one-stage", "stage")
    assert two.count() == 4
    assert not any(f.startswith("one-stage") for f in folders(spark)) and any(f.startswith("two-stage") for f in folders(spark))


def test_ids_of_a_large_table_are_exchanged_in_parts(spark, monkeypatch):
    rows = [(f"G{n % 700}" if n % 50 else None, float(n % 9), "a") for n in range(800)]
    target = [(i, v + (n % 97 == 3), note) for n, (i, v, note) in enumerate(rows) if n % 113 != 5]
    args = tables(spark, rows, target, [f"G{n}" for n in range(0, 700, 41)])

    def results():
        c = R.TableComparison(*args[:2], SPEC, "gl_entry_id", args[2])
        return (c.summary().collect(), sorted(map(str, c.changed().collect())), sorted(c.column_drift().collect()))

    whole, before = results(), folders(spark)
    monkeypatch.setattr(stages, "PASS_ROWS", 5)
    monkeypatch.setattr(stages, "MOST_PASSES", 2)
    assert results() == whole
    assert sum(f.startswith("differing-ids") for f in folders(spark) - before) == 2


def test_no_second_copy_of_the_tables(spark, monkeypatch):
    sources = {k: df for k, df in views(spark, SF).items() if k in KEYS}
    fake = SimpleNamespace(sources=sources, target=sources.get, specs=None, held=None)
    monkeypatch.setattr(migration, "job", lambda *a: fake)
    monkeypatch.setattr(issues, "job", lambda *a: fake)
    monkeypatch.setattr(R, "compare_all", lambda sources, targets, *a: targets)
    monkeypatch.setattr(issues, "first_state", lambda before, *a: before)
    monkeypatch.setattr(issues, "next_state", lambda before, *a: SimpleNamespace(findings=before["hr"]))
    before = folders(spark)
    damaged = migration._comparisons(spark, SF)
    assert issues.incremental_findings(spark, SF).count() < sources["hr"].count()
    assert all(0 < damaged[k].exceptAll(sources[k]).count() for k in ("finance", "procurement"))
    assert folders(spark) == before


def test_changed_ids_of_a_large_load_are_exchanged_in_parts(spark, monkeypatch):
    rng = random.Random(4)
    schema = "id string, lo bigint, hi bigint"
    old = [(rng.choice([None, *(f"r{i}" for i in range(90))]), rng.randrange(-9, 9) << 33, 1) for _ in range(200)]
    new = old[10:] + [("r3", 7 << 33, 1), ("new", 1, 1)] + old[40:44]
    before, after = (stage(spark.createDataFrame(x, schema), "load").select("id", "lo", "hi") for x in (old, new))

    def of(rows):
        groups = {}
        for i, lo, hi in rows:
            groups.setdefault(i, []).append((lo, hi))
        return {i: sorted(x) for i, x in groups.items()}

    want = {i for i in {*of(old), *of(new)} if of(old).get(i) != of(new).get(i)}
    assert {r[0] for r in N.changed_ids(before, after).collect()} == want
    monkeypatch.setattr(stages, "PASS_ROWS", 100)
    found = [r[0] for r in N._changed(before, after, "changed-load").collect()]
    assert set(found) == want and len(found) == len(want)
    assert sum(f.startswith("changed-load") for f in folders(spark)) == 4


@pytest.mark.parametrize("at_once", [3, 1 << 20])
def test_components_keep_one_step_on_disk(spark, monkeypatch, at_once):
    monkeypatch.setattr(K, "EDGES_AT_ONCE", at_once)
    monkeypatch.setattr(skew, "HEAVY_ROWS", 10)
    rng = random.Random(5)
    edges = [(f"o{rng.randrange(300):03d}", f"p{rng.randrange(200):03d}") for _ in range(260)]
    edges += [("z", f"z{i:02d}") for i in range(40)] + [(f"y{i:03d}", f"y{i + 1:03d}") for i in range(60)]
    rng.shuffle(edges)
    before = folders(spark)
    assert solved(spark, edges) == components_of(edges)
    assert sorted(f.rsplit("-", 1)[0] for f in folders(spark) - before) in (
        ["component-edges"], ["component-alone", "component-edges"])


def test_nodes_without_another_end(spark):
    rows = [(None, "a"), ("b", None), ("a", "c"), ("c", "a"), ("d", "d"), (None, None)]
    assert solved(spark, rows) == {None: None, "a": "a", "b": "b", "c": "a", "d": "d"}

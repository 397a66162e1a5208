"""A rebuild from changes equals a full one, and reads no more than what changed touches."""

import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from ledgerlift.operators import checks as C
from ledgerlift.plans import incremental as N
from ledgerlift.plans.pipeline import discover
from ledgerlift.sources.stages import stage
from ledgerlift.workloads.views import AS_OF, EARLIEST, views

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def sources(spark):
    return {k: stage(df, k) for k, df in views(spark, SF).items() if k in ("hr", "finance", "procurement", "expenses")}


@pytest.fixture(scope="module")
def state(sources):
    return N.first_state(sources, AS_OF, EARLIEST)


def keys(findings):
    return sorted(r[0] for r in findings.select("finding_key").collect())


def changed(sources, seed):
    """Rows altered, removed, repeated and added in every table, by a hash of the row."""
    rng = random.Random(seed)
    out = {}
    alter = {
        "hr": [("name", F.concat(F.col("name"), F.lit("q"))), ("name", F.lit("Sam Hotname")), ("hire_date", F.lit(None).cast("date")),
               ("employee_id", F.concat("employee_id", F.lit("x")))],
        "finance": [("currency", F.lit("GPB")), ("vendor_id", F.lit("VEND-404")), ("cost_centre", F.lit("007"))],
        "procurement": [("quantity", -F.abs("quantity")), ("vendor_name", F.concat("vendor_name", F.lit(" Ltd"))),
                        ("vendor_id", F.lit("VEND-404"))],
        "expenses": [("employee_id", F.lit("EMP-404")), ("cost_centre", F.lit("")), ("submitted_date", F.lit(date(1990, 1, 1)))]}
    for key, df in sources.items():
        row = F.pmod(F.xxhash64(F.lit(seed), *df.columns), F.lit(1000))
        share = {"hr": 60, "finance": 15, "procurement": 6, "expenses": 15}[key]
        marked = df.withColumn("__row", row)
        kept = marked.filter(F.col("__row") >= share)
        column, value = rng.choice(alter[key])
        altered = kept.withColumn(column, F.when(F.col("__row") >= 1000 - share, value).otherwise(F.col(column)).cast(df.schema[column].dataType))
        out[key] = stage(altered.unionByName(kept.filter(F.col("__row").between(500, 500 + share // 3))).drop("__row"), f"changed-{key}")
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_as_a_full_rebuild(spark, sources, state, seed):
    new = changed(sources, seed)
    after = N.next_state(state, new, AS_OF, EARLIEST)
    full = discover(new, AS_OF, earliest=EARLIEST)
    assert keys(after.findings) == keys(full) != keys(state.findings)
    # and once more from there, back to the start
    assert keys(N.next_state(after, sources, AS_OF, EARLIEST).findings) == keys(state.findings)


def test_a_first_state_is_the_full_build(sources, state):
    assert keys(state.findings) == keys(discover(sources, AS_OF, earliest=EARLIEST))
    ids = [r[0] for r in state.numbered().select("finding_id").orderBy("finding_id").collect()]
    assert ids == list(range(1, len(ids) + 1))


def test_nothing_changed_means_nothing_found_again(spark, sources, state, monkeypatch):
    seen = []
    whole = C.apply_rules
    monkeypatch.setattr(C, "apply_rules", lambda df, *a: seen.append(df.count()) or whole(df, *a))
    after = N.next_state(state, sources, AS_OF, EARLIEST)
    assert keys(after.findings) == keys(state.findings) and seen == [0, 0, 0, 0]


def test_missing_and_repeated_ids(spark):
    rows = lambda *r: spark.createDataFrame(list(r), "id string, lo long, hi long")
    found = N.changed_ids(rows((None, 1, 1), (None, 2, 2), ("a", 5, 5), ("a", 5, 5), ("b", 1, 1)),
                          rows((None, 2, 2), (None, 1, 1), ("a", 5, 5), ("b", 1, 2), ("c", 0, 0)))
    assert sorted(r[0] for r in found.collect()) == ["a", "b", "c"]


def test_resolutions_are_only_added(spark):
    kind = "finding_key string, status string, note string"
    one = N.add_resolutions(None, spark.createDataFrame([("k", "Resolved", "a")], kind))
    two = N.add_resolutions(one, spark.createDataFrame([("k", "Resolved", "a"), ("l", "Open", "b")], kind))
    assert sorted(map(tuple, two.collect())) == [("k", "Resolved", "a"), ("l", "Open", "b")]

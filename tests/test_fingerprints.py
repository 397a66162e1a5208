"""Fingerprint trees against row by row comparison: repeated and missing ids, held rows, clean ranges that send no rows."""

import random

import pytest
from pyspark.sql import functions as F

from ledgerlift.operators import reconcile as R
from ledgerlift.operators.mapping import map_table
from ledgerlift.sources.spec import ColumnMap, DomainSpec
from ledgerlift.sources.stages import stage

SPEC = DomainSpec("finance", "legacy_finance", "target_finance", (
    ColumnMap("gl_entry_id", "gl_entry_id", "VARCHAR"), ColumnMap("amount", "amount", "DOUBLE"), ColumnMap("note", "note", "VARCHAR")))
SCHEMA = "gl_entry_id string, amount double, note string"
HELD = "table_name string, row_identifier string"


def tables(spark, rows, target, held):
    return (stage(spark.createDataFrame(rows, SCHEMA), "src"), stage(spark.createDataFrame(target, SCHEMA), "tgt"),
            spark.createDataFrame([("legacy_finance", h) for h in held] + [("other", "G1")], HELD))


def compared(spark, rows, target, held):
    source, moved, out = tables(spark, rows, target, held)
    return R.TableComparison(source, moved, SPEC, "gl_entry_id", out), R.row_checksums(source, moved, SPEC, "gl_entry_id", out), source, moved


@pytest.mark.parametrize("seed", range(2))
def test_differences_are_those_of_all_rows(spark, seed):
    rng = random.Random(seed)
    rows = [(f"G{n}", rng.choice([1.5, None, 2.0]), rng.choice(["a", None, ""])) for n in range(3000)]
    held = [f"G{n}" for n in range(0, 3000, 131)]
    target = [r for r in rows if r[0] not in held]
    for n in rng.sample(range(len(target)), 12):
        target[n] = (target[n][0], 99.0, target[n][2])
    target = [r for n, r in enumerate(target) if n % 611 != 5] + [("X1", 1.0, "new"), ("G7", 5.0, "twice"), (held[3], 1.0, "held yet moved")]
    comparison, by_row, source, moved = compared(spark, rows, target, held)
    want = {(r["key"], r["state"]) for r in by_row.collect()}
    got = {(r["key"], r["state"]) for r in comparison.differences().collect()}
    bad = ("drifted", "missing", "unexpected")
    assert {x for x in got if x[1] in bad} == {x for x in want if x[1] in bad} and len(got) < len(want) / 2
    counts = comparison.summary().first()
    for state in R.STATES:
        # rows count where an id repeats
        assert counts[state] == sum(1 for _, s in want if s == state) + (state == "drifted" and ("G7", "drifted") in want)
    drift = {r["column_name"]: r["drifted"] for r in R.column_drift(source, moved, SPEC, "gl_entry_id").collect()}
    assert {r["column_name"]: r["drifted"] for r in comparison.column_drift().collect()} == drift


def test_missing_and_repeated_ids_and_nothing_to_compare(spark):
    rows = [(None, 1.0, "a"), (None, 2.0, "b"), ("G1", 1.0, "a"), ("G1", 1.0, "a")]
    comparison = compared(spark, rows, rows[::-1], [])[0]
    assert comparison.summary().first()["status"] == "CLEAN" and comparison.differences().count() == 0
    assert compared(spark, rows, rows[1:], [])[0].summary().first()["status"] == "DRIFT"
    empty = compared(spark, [], [], [])[0]
    assert empty.summary().first().asDict() == {"table_name": "legacy_finance", **dict.fromkeys(R.STATES, 0), "status": "CLEAN"}


def test_clean_ranges_send_no_rows(spark):
    """The rows that a task may read again are those of differing ranges; the tree names them level by level."""
    rows = [(f"G{n}", float(n), "a") for n in range(20_000)]
    target = [(i, 0.5 if i == "G77" else a, t) for i, a, t in rows]
    comparison = compared(spark, rows, target, [])[0]
    assert comparison._within(comparison.target, True).count() < 40
    nodes = {(r["bits"], r["node"]) for r in comparison.tree.filter("differs").collect()}
    leaf = spark.createDataFrame([("G77",)], "k string").select(R.key_range(F.col("k"))).first()[0]
    assert nodes == {(bits, leaf >> (R.LEAF_BITS - bits)) for bits in (12, 8, 4, 0)}
    top = comparison.tree.filter("bits = 0").first()
    assert top["s_n"] == top["t_n"] == 20_000
    same = compared(spark, rows, rows, [])[0]
    assert not same.tree.filter("differs").count()
    assert map_table(spark.createDataFrame(rows[:1], SCHEMA), SPEC).columns == SPEC.targets()


def test_only_ids_that_differ_are_read_where_every_range_differs(spark, monkeypatch):
    """In a large table every range has a row that differs; here there is one range."""
    monkeypatch.setattr(R, "key_range", lambda key, bits=R.LEAF_BITS: F.when(key.isNull(), 0).otherwise(0))
    rows = [(f"G{n}", float(n), "a") for n in range(4000)] + [(None, 1.0, "a"), (None, 2.0, "b"), ("G5", 5.0, "a"), ("G6", 8.0, "b")]
    held = [f"G{n}" for n in range(0, 4000, 400)]
    target = [(i, a + 1 if n % 500 == 7 else a, t) for n, (i, a, t) in enumerate(rows) if i not in held and n % 800 != 9]
    target = target[::-1] + [("X1", 1.0, "new"), ("G11", 11.0, "a")]
    comparison, by_row, source, moved = compared(spark, rows, target, held)
    want = {(r["key"], r["state"]) for r in by_row.collect() if r["state"] not in ("matched", "held")}
    assert {s for _, s in want} == {"drifted", "missing", "unexpected"}
    assert sorted(map(str, [(r["key"], r["state"]) for r in comparison.changed().collect()])) == sorted(map(str, want))
    read = comparison._of_ids(comparison.target, comparison._ids[0]).count()
    assert read <= len(want) + 2 < comparison._within(comparison.target, True).count() / 100
    drift = R.column_drift(source, moved, SPEC, "gl_entry_id")
    columns = ("column_name", "compared", "drifted")
    assert {tuple(r[c] for c in columns) for r in comparison.column_drift().collect()} == {tuple(r[c] for c in columns) for r in drift.collect()}
    # no other way to count the rows of each state than over the ids
    states = R._row_states(comparison.mapped, moved, SPEC, "gl_entry_id", comparison.held)
    assert comparison.summary().first() == R.checksum_summary(states, "legacy_finance").first()

"""Ordered parts of long lists."""

import random

import pytest

from ledgerlift.operators.skew import list_in_parts


@pytest.mark.parametrize(("length", "part_rows"), [(1000, 300), (7, 50), (1000, 100_000)])
def test_parts_are_in_global_order(spark, length, part_rows):
    rng = random.Random(1)
    rows = [("hot", f"{n:05d}") for n in range(2500)] + [("small", f"{n:05d}") for n in range(9)] + [("one", "00001")]
    rng.shuffle(rows)
    table = spark.createDataFrame(rows, "k string, o string").repartition(5)
    sizes = table.groupBy("k").count().filter("count > 1")
    got = list_in_parts(table, sizes, "k", "count", "o", "o", "out", length, part_rows).collect()
    lists = {}
    for r in sorted(got, key=lambda r: r["part"]):
        entries = r["out"].split(", ")
        assert r["count"] == (2500 if r["k"] == "hot" else 9) and len(entries) <= length
        lists.setdefault(r["k"], []).append(entries)
    for name, n in (("hot", 2500), ("small", 9)):
        assert [e for part in lists[name] for e in part] == [f"{i:05d}" for i in range(n)]
        assert all(len(part) == length for part in lists[name][:-1])
    assert "one" not in lists

"""Hard negatives against all pairs: bounds, ties, hot vectors, odd rows, sizes."""

import numpy as np
import pytest
from oracle import connect, difference, spark_rows, sql_rows
from pyspark.sql import functions as F

from ledgerlift.llm import hardneg
from ledgerlift.llm.queries import ORACLES, QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int, rank string"
SMALL = hardneg.Settings(sample=64, directions=4, ranges=3, window=8, block=40, askers=5)


def by_hand(rows, positives=5, negatives=5):
    fit = sorted({(r[0], r[2], tuple(int(np.floor(256 * float(np.float32(x)))) for x in r[1])) for r in rows
                  if r[0] is not None and r[2] is not None and r[1] is not None and all(x is not None and np.isfinite(x) for x in r[1])})
    fit = [(i, (c + 1) % 10 if i % 7 == 0 else c, v) for i, c, v in fit]
    out = []
    for i, c, v in fit:
        if i % 20:
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), j, d) for j, d, w in fit)
        own = [(-s, j) for s, j, d in scored if d == c and j != i][:positives]
        for score, j in own:
            found = [(-s, k) for s, k, d in scored if d != c and 80 * score <= -100 * s <= 100 * score][:negatives]
            out += [(i, j, n + 1, k, score, s) for n, (s, k) in enumerate(found)]
    return sorted(out)


def mined(spark, rows, settings=SMALL):
    table = spark.createDataFrame(rows, SCHEMA).repartition(3)
    label = F.when(F.col("vec_id") % 7 == 0, F.pmod(F.col("label") + 1, F.lit(10))).otherwise(F.col("label"))
    return hardneg.mine(table, label=label, anchor=F.col("id") % 20 == 0, settings=settings)


def table_of(count, seed=2, size=6, labels=4):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(labels, size))
    made = []
    for n in range(count):
        label = int(rng.integers(labels))
        v = centres[label] + rng.normal(size=size) * rng.choice([0.2, 1.5])
        made.append((n, [float(x) for x in v * rng.choice([0.01, 0.3, 1.0])], label, None))
    return made


@pytest.mark.parametrize("settings", [SMALL, hardneg.Settings()])
def test_as_all_pairs(spark, settings):
    rows = table_of(400)
    hot = [(1000 + n, [0.25, 0.5, -0.5, 0.0, 1.0, 0.125], 3 if n % 5 else 1, None) for n in range(150)]
    odd = [(None, [1.0] * 6, 1, None), (2000, None, 1, None), (2020, [1.0] * 6, None, None), (2040, [float("nan")] + [1.0] * 5, 1, None),
           (2060, [None] + [1.0] * 5, 1, None), (2080, [float("inf")] * 6, 1, None), (2100, [0.0] * 6, 2, None), (2120, [0.0] * 6, 2, None)]
    rows += hot + odd + rows[:30] + hot[:20]
    got = sorted(tuple(r) for r in mined(spark, rows, settings).collect())
    assert got and got == by_hand(rows)


def test_few_rows_and_none(spark):
    rows = [(20, [1.0, 1.0], 1, None), (1, [1.0, 1.0], 1, None), (2, [0.9, 0.9], 2, None), (3, [-1.0, 0.0], 2, None)]
    assert [tuple(r) for r in mined(spark, rows).collect()] == by_hand(rows) == [(20, 1, 1, 2, 131072, 117760)]
    assert mined(spark, rows[:1]).count() == 0
    nothing = hardneg.mine(spark.createDataFrame([], SCHEMA), label=F.col("label"), anchor=F.col("id") % 20 == 0)
    assert nothing.count() == 0 and nothing.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def test_odd_sizes_and_overlong_vectors_take_no_part(spark):
    rows = table_of(60)
    odd = [(500, [9.0] * 3, 1, None), (501, [1e30] * 6, 1, None), (520, [1e30] * 6, 1, None), (540, [], 1, None)]
    assert sorted(tuple(r) for r in mined(spark, rows + odd).collect()) == by_hand(rows)


def test_large_components_are_exact(spark):
    rng = np.random.default_rng(5)
    rows = [(n, [float(np.float32(x)) for x in rng.integers(-2_000_000, 2_000_000, 6)], int(rng.integers(2)), None) for n in range(120)]
    assert sorted(tuple(r) for r in mined(spark, rows).collect()) == by_hand(rows)


def test_bounds_hold_every_score():
    rng = np.random.default_rng(1)
    for _ in range(20):
        vectors = np.floor(rng.normal(size=(64, 5)) * rng.choice([2, 300]))
        vectors[0] = 0
        asks = np.concatenate([vectors[:20], -vectors[:20], np.floor(rng.normal(size=(10, 5)) * 256)])
        directions = hardneg.directions_of(vectors, 6, 1)
        norm, angles = hardneg.angles_to(directions, vectors)
        stored = angles.astype(np.float32).astype(np.float64)
        starts = np.arange(0, 64, 8)
        ranges = [f.reduceat(x, starts) for x in (stored, norm) for f in (np.minimum, np.maximum)]
        asked_norm, asked = hardneg.angles_to(directions, asks)
        down, up = hardneg.score_bounds(asked_norm, asked.astype(np.float32).astype(np.float64), *ranges)
        scores = (asks @ vectors.T).reshape(len(asks), 8, 8)
        assert (down <= scores.min(axis=2)).all() and (scores.max(axis=2) <= up).all()


def test_registered_query(spark):
    sf = "/root/testdata/sf0.01"
    got = spark_rows(QUERIES["op13_hard_negatives"](spark, sf))
    assert got[1] and difference(got, sql_rows(connect(sf), ORACLES["op13_hard_negatives"])) is None

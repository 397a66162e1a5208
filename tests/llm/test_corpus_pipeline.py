"""The pipeline's stages on planted cases, and its rows at the smallest scale."""

import random

import corpus_pipeline
import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def rows(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def test_stages_keep_the_columns_and_fill_sequences(spark, rows):
    for name, apply in corpus_pipeline.STAGES[:-1]:
        kept = corpus_pipeline.stage(apply(spark, rows, SF), name)
        assert kept.schema == rows.schema or kept.dtypes == rows.dtypes
        assert 0 < kept.count() <= rows.count()
        rows = kept
    packed = corpus_pipeline.STAGES[-1][1](spark, rows, SF).collect()
    assert {r["doc_id"] for r in packed} == {r["doc_id"] for r in rows.select("doc_id").collect()}
    rooms = {}
    for r in packed:
        rooms[r["sequence_id"]] = rooms.get(r["sequence_id"], 0) + r["length"]
    assert max(rooms.values()) <= corpus_pipeline.SEQUENCE


def test_copies_and_repeats_go(spark, rows):
    rng = random.Random(2)
    words = ["".join(rng.choices("abcdefghij", k=6)) for _ in range(400)]
    one, passage = (" ".join(rng.choices(words, k=k)) for k in (300, 80))
    head, tail = (" ".join(rng.choices(words, k=150)) for _ in range(2))
    planted = [(10_001, one), (10_002, one), (10_003, head + ".\n" + passage), (10_004, passage + "\n?" + tail), (10_005, "Alone here.")]
    table = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in planted], rows.schema)
    kept = corpus_pipeline.drop_near_copies(spark, table, SF)
    assert sorted(r["doc_id"] for r in kept.collect()) == [10_001, 10_003, 10_004, 10_005]
    cut = {r["doc_id"]: r for r in corpus_pipeline.cut_repeats(spark, kept, SF).collect()}
    assert cut[10_003]["text"] == head + ".\n" and cut[10_003]["n_chars"] == len(head) + 2 and cut[10_004]["text"] == "\n?" + tail
    assert cut[10_001]["text"] == one and cut[10_005]["text"] == "Alone here."


@pytest.mark.parametrize("number", range(4))
def test_empty_tables(spark, rows, number):
    assert corpus_pipeline.STAGES[number][1](spark, rows.limit(0), SF).count() == 0

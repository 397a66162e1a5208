"""Which rows of a group of near copies stay, by row and not by id."""

import random

import corpus_pipeline
import pytest

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def prose():
    rng = random.Random(3)
    words = ["".join(rng.choices("abcdefghij", k=6)) for _ in range(400)]
    return lambda n: " ".join(rng.choices(words, k=n))


def table(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], SCHEMA).repartition(3)


def told(rows):
    return sorted(((r["doc_id"], r["text"]) for r in rows.collect()), key=str)


def test_one_row_of_a_group_stays(spark, prose):
    twice, alone, late, first, second = (prose(k) for k in (120, 100, 90, 110, 95))
    rows = [
        (1, twice), (1, twice), (1, twice),  # repeated rows
        (None, alone),  # unique, without id
        (None, late), (None, late), (2, late),  # an id goes before none
        (3, first), (3, second), (4, second),  # one id, two texts, one of them copied
        (6, first), (5, first),
    ]
    kept = corpus_pipeline.stage(corpus_pipeline.drop_near_copies(spark, table(spark, rows), SF), "kept")
    expected = sorted([(1, twice), (None, alone), (2, late), (3, first), (3, second)], key=str)
    assert told(kept) == expected
    assert told(corpus_pipeline.cut_repeats(spark, kept, SF)) == expected


def test_copies_without_any_id(spark, prose):
    text = prose(80)
    kept = corpus_pipeline.drop_near_copies(spark, table(spark, [(None, text)] * 4), SF)
    assert told(kept) == [(None, text)]

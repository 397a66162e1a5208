"""Clashing names, rows without ids, pairs across passage cuts, naive forms of the packing and the samples."""

import random
import zlib

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from ledgerlift.llm import bpe, kdtree, lm, packing, samples, segments, simhash, sketches, suffixdedup, toxicity
from ledgerlift.llm.batches import slices
from ledgerlift.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(n, f"words of text {n} " * 3, "en", "s", 1) for n in range(30)], SCHEMA)


def test_new_names_that_are_there_already_are_errors(spark, docs):
    prints = docs.select("doc_id", F.xxhash64("text").alias("fp"), F.lit(1).alias("component_id"))
    with pytest.raises(ValueError, match="component_id"):
        simhash.near_duplicates(prints)
    rows = docs.select("doc_id", F.lit(5).alias("size"), F.lit(1.0).alias("d"), F.lit(1).alias("shard"), F.lit(1).alias("slot"))
    with pytest.raises(ValueError, match="shard"):
        kdtree.kd_shards(rows, size="size", dimensions=["d"], group="doc_id", key="doc_id", shards=2)
    with pytest.raises(ValueError, match="slot"):
        kdtree.with_slots(rows, shard="shard", key="doc_id", tie="doc_id")
    with pytest.raises(ValueError, match="n_known"):
        lm.score(docs.withColumn("n_known", F.lit(1)), F.lit(True))
    with pytest.raises(ValueError, match="score"):
        toxicity.score(docs.withColumn("score", F.lit(1)), toxicity.Machine(0.0, np.zeros(4), np.zeros((4, 2)), 0.0))
    with pytest.raises(ValueError, match="kept"):
        suffixdedup.remove_repeats(docs.withColumn("kept", F.lit(1)))
    with pytest.raises(ValueError, match="sequence_id"):
        packing.assign(docs.select("doc_id", F.lit(0).cast("long").alias("start"), F.lit(1).alias("sequence_id")), 1)
    assert bpe and sketches


def test_a_toxic_pair_across_a_cut_meets():
    """With overlap, words near each other share a passage wherever the text is cut."""
    words = [f"w{n}" for n in range(200)]
    for at in range(60, 70):
        text = " ".join([*words[:at], "insult", "group", *words[at:]])

        def found(overlap, text=text):
            store = segments.SegmentStore(lambda new: [[zlib.crc32(s.encode()) % 1000] for s in new])
            terms, offsets, _ = toxicity.passages(store, [text], overlap=overlap)
            pair = {zlib.crc32(b"insult") % 1000, zlib.crc32(b"group") % 1000}
            return [set(terms[a:b].tolist()) >= pair for a, b in zip(offsets[:-1], offsets[1:], strict=True)]

        assert any(found(True))
    assert len(found(True)) == 2 * len(found(False)) - 1
    assert len(toxicity.passages(segments.SegmentStore(lambda new: [[1] for _ in new]), [""], overlap=True)[2]) == 1


def naive_first_fit(sizes, capacity):
    rooms, out = [], {}
    for item in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        place = next((n for n, room in enumerate(rooms) if room >= sizes[item]), len(rooms))
        if place == len(rooms):
            rooms.append(capacity)
        out[item] = place, capacity - rooms[place]
        rooms[place] -= sizes[item]
    return [out[i] for i in range(len(sizes))]


@pytest.mark.parametrize("seed", range(20))
def test_tournament_tree_is_plain_first_fit(seed):
    rng = np.random.default_rng(seed)
    sizes = rng.integers(1, 65, rng.integers(1, 200))
    bins, offsets = packing.first_fit_decreasing(sizes, 64)
    assert list(zip(bins.tolist(), offsets.tolist(), strict=True)) == naive_first_fit(sizes.tolist(), 64)


def test_rows_without_id_fill_all_groups(spark):
    rows = spark.range(6000).select(
        F.when(F.col("id") % 2 == 0, F.col("id")).alias("doc_id"), F.lit(0).cast("long").alias("start"),
        (F.col("id") % 50 + 1).alias("length"))
    packed = packing.assign(rows, 6000, capacity=64, group_docs=600)
    groups = packed.groupBy(F.shiftright("sequence_id", 32).alias("g")).count().collect()
    assert len(groups) == 10 and max(r["count"] for r in groups) < 900 and packed.count() == 6000


def test_segments_in_arrow_give_the_ids_of_whole_texts(spark):
    from tokenizers import Tokenizer

    with open(public_tokenizers.path("word_bpe_49k.json")) as file:
        content = file.read()
    own = Tokenizer.from_str(content)
    own.encode_special_tokens = False
    texts = ["A.b,c. D", "É, é. Ü.", "éX. Ab́ CD", "<|endoftext|> A.B", "x  y\n\nZ.", "", None, "İ.I,", "don't. Stop,now.", " lead"]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(1)
    got = {r["doc_id"]: r["ids"] for r in packing.tokenise(table, content, end=None, keep=["doc_id"]).collect()}
    for n, t in enumerate(texts):
        assert got.get(n, []) == own.encode(t or "", add_special_tokens=False).ids, t


def test_samples_are_the_least_hashes_of_each_label(spark):
    rows = spark.range(20_000).select("id", (F.col("id") % 7 == 0).cast("int").alias("label"))
    rows = rows.unionByName(spark.createDataFrame([(None, 1), (5, None), (90_000, 2)], "id long, label int"))
    got = samples.sampled_keys(rows, key="id", label="label", per_label=300)
    order = rows.filter("id is not null and label is not null").withColumn("h", F.xxhash64("id")).orderBy("h", "id").collect()
    for label in (0, 1, 2):
        want = [r["id"] for r in order if r["label"] == label][:300]
        assert sorted(r["id"] for r in got.filter(F.col("label") == label).collect()) == sorted(want)


def test_slices_hold_lists_too():
    import pyarrow as pa

    batch = pa.record_batch({"x": pa.array([[1] * n for n in (5, 5, 900, 1)] + [None], pa.list_(pa.int32()))})
    assert [p.num_rows for p in slices(iter([batch]), "x", 48)] == [2, 1, 2]


def test_stages_keep_foreign_columns(spark):
    rng = random.Random(5)
    vocabulary = ["".join(rng.choices("abcdefghijkl", k=6)) for _ in range(500)]
    rows = [(n, " ".join(rng.choices(vocabulary, k=60)), "en", "s", 1) for n in range(40)]
    names = ["kept", "n_bytes", "spans", "__lang", "__sure", "__toxic", "__row", "__others", "component_id", "a.b"]
    table = spark.createDataFrame(rows, SCHEMA)
    for n, name in enumerate(names):
        table = table.withColumn(name, F.lit(n))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        done = stage(spark, table, SF)
        assert done.columns == table.columns, name
        assert all(tuple(r)[5:] == tuple(range(len(names))) for r in done.collect()), name
    assert corpus_pipeline.STAGES[-1][1](spark, table, SF).count() > 0
    assert corpus_pipeline.STAGES[-1][1](spark, table.limit(0), SF).count() == 0


@pytest.mark.parametrize("name", ["op2_simhash", "op4_fingerprints", "op8_packing", "op9_kd_shards"])
def test_registered_queries_cover_their_table(spark, name):
    rows = QUERIES[name](spark, SF).collect()
    ids = {r["doc_id"] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").collect()}
    assert {r["doc_id"] for r in rows} == ids
    if name == "op9_kd_shards":
        slots = {}
        for r in rows:
            slots.setdefault(r["shard"], []).append(r["slot"])
        assert sorted(slots) == list(range(16)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    if name == "op8_packing":
        places = {}
        for r in rows:
            places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        for own in places.values():
            own.sort()
            assert own[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(own, own[1:], strict=False)) and sum(n for _, n in own) <= 4096


def test_plain_words_encoded_together_have_their_own_ids():
    """op8_packing: words of plain letters were encoded one at a time, through normalizer and pattern, for most of the CPU time."""
    import json

    import public_tokenizers
    from tokenizers import Tokenizer

    with open(public_tokenizers.path("word_bpe_49k.json")) as file:
        table = file.read()
    own = Tokenizer.from_str(table)
    rng = np.random.default_rng(3)
    letters = list("abcdefghijklmnopqrstuvwxyzßàáéíñóöøüÿ")
    made = ["".join(rng.choice(letters, n)) for n in rng.integers(1, 14, 5000)]
    made += ["", ".", "Éa", "a1b", "l'heure", "don't", "été", "ÿ", "÷", "ab÷cd", "日本", "<|x|>", "a b", "ciónosó.", "Å", "x" * 300]
    made = [made[i] for i in rng.permutation(len(made))]
    flat, size = packing.encoder(table)(made)
    wanted = [e.ids for e in own.encode_batch(made, add_special_tokens=False)]
    assert size.tolist() == [len(w) for w in wanted] and flat.tolist() == [i for w in wanted for i in w]
    assert [len(part) for part in packing.encoder(table)([])] == [0, 0]
    # far fewer calls than words; a tokenizer that may change or cut a word is asked for each
    assert packing.word_encoder(table) is not None
    for change in ({"normalizer": {"type": "NFD"}}, {"pre_tokenizer": {"type": "Whitespace"}},
                   {"added_tokens": [{"id": 7, "content": "the", "single_word": False, "lstrip": False, "rstrip": False,
                                      "normalized": False, "special": False}]}):
        assert packing.word_encoder(json.dumps(json.loads(table) | change)) is None

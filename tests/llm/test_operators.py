"""Operators against brute force on small tables: nulls, empty and long texts, ties, repeated rows, no rows."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from ledgerlift.llm import ann, bpe, kdtree, langid, lm, packing, simhash, sketches, suffixdedup, toxicity
from ledgerlift.llm.bwtmerge import repeated_windows
from ledgerlift.llm.samples import fold

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
RANDOM = random.Random(4)
WORDS = ["".join(RANDOM.choices("abcdefghijklmnop", k=RANDOM.randint(2, 8))) for _ in range(300)]
PASSAGE = " ".join(RANDOM.choices(WORDS, k=70))


def prose(words):
    return " ".join(RANDOM.choices(WORDS, k=words))


@pytest.fixture(scope="module")
def texts():
    base = prose(150)
    own = [None, "", " \n ", "...", "a", "Ärger ÜBER Straße — né 中文 🎉", base, base, base + " more", prose(30) + " " + PASSAGE,
           PASSAGE + ". " + prose(40), "ab" * 400, prose(9000), "I'll\t\tgo\r\n  x\x1c\x85y'S", prose(5), base]
    return list(enumerate(own + [prose(RANDOM.randint(3, 120)) for _ in range(40)]))


@pytest.fixture(scope="module")
def docs(spark, texts):
    return spark.createDataFrame([(i, t, "en" if i % 2 else "de", "s", None) for i, t in texts], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def ranks():
    return bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


@pytest.fixture(scope="module")
def tokenizer():
    with open(public_tokenizers.path("word_bpe_49k.json")) as file:
        return file.read()


def test_bpe_as_the_library_encodes(docs, nothing, texts, ranks):
    import tiktoken

    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    coded = bpe.encode(docs, ranks, public_tokenizers.PATTERN, keep=["doc_id"])
    found = {r["doc_id"]: r for r in bpe.decode(coded, ranks).collect()}
    for i, t in texts:
        assert found[i]["ids"] == own.encode_ordinary(t or "")
        assert bytes(found[i]["decoded"]) == (t or "").encode()
    assert bpe.decode(bpe.encode(nothing, ranks, public_tokenizers.PATTERN), ranks).count() == 0
    with pytest.raises(ValueError):
        bpe.encode(docs, ranks, public_tokenizers.PATTERN, ids="lang")


def test_merge_replay_of_odd_strings(ranks):
    import tiktoken

    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    alphabet = list("ab  \n\t'sAéß1२中\x1c\x85\xa0​.,!\r🎉'll're")
    odd = ["".join(RANDOM.choices(alphabet, k=RANDOM.randint(0, 50))) for _ in range(4000)]
    store = bpe.SegmentStore(bpe._SegmentEncoder(ranks, public_tokenizers.PATTERN), most=500)
    for at in range(0, len(odd), 500):
        ids, offsets = store.ids_of(map(bpe._segments, odd[at:at + 500]))
        for n, t in enumerate(odd[at:at + 500]):
            assert ids[offsets[n]:offsets[n + 1]].tolist() == own.encode_ordinary(t), repr(t)


def print_of(text, words):
    import xxhash

    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    found = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", lowered) if w]
    runs = [" ".join(found[k:k + words]) for k in range(max(1, len(found) - words + 1))] if found else []
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups_of(prints, threshold):
    root = {k: k for k in prints}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in sorted(prints):
        for b in sorted(prints):
            if a < b and (prints[a] ^ prints[b]).bit_count() <= threshold:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {k: find(k) for k in prints}


def test_simhash_prints_and_groups(docs, nothing, texts):
    made = simhash.fingerprints(docs, words=3, keep=["doc_id"])
    expected = {i: print_of(t, 3) for i, t in texts}
    assert {r["doc_id"]: r["fp"] % (1 << 64) for r in made.collect()} == expected
    found = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(made, threshold=2).collect()}
    assert found == groups_of(expected, 2)
    assert simhash.near_duplicates(simhash.fingerprints(nothing, keep=["doc_id"])).count() == 0


@pytest.mark.parametrize("threshold", [0, 1, 2, 3, 4])
def test_anchors_find_all_near_values(spark, threshold):
    values = [RANDOM.getrandbits(64) for _ in range(12)]
    for v in list(values):
        for _ in range(6):
            flips = RANDOM.sample(range(64), RANDOM.randint(0, 5))
            values.append(v ^ sum(1 << b for b in flips))
    prints = dict(enumerate(values))
    rows = [(k, v - (1 << 64) if v >> 63 else v) for k, v in prints.items()]
    made = spark.createDataFrame(rows, "doc_id long, fp long")
    found = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(made, threshold=threshold).collect()}
    assert found == groups_of(prints, threshold)


def without_repeats(texts, length):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[k:k + length] for d in data for k in range(len(d) - length + 1))
    out = []
    for d in data:
        covered = [False] * len(d)
        for k in range(len(d) - length + 1):
            if seen[d[k:k + length]] > 1:
                covered[k:k + length] = [True] * length
        out.append(bytes(b for b, c in zip(d, covered, strict=True) if not c))
    return out


@pytest.mark.parametrize("most_regions", [20_000, 1])
def test_repeats_removed(docs, nothing, texts, most_regions):
    rows = suffixdedup.remove_repeats(docs, length=200, most_regions=most_regions).collect()
    found = {r["doc_id"]: r for r in rows}
    for (i, t), kept in zip(texts, without_repeats([t for _, t in texts], 200), strict=True):
        assert bytes(found[i]["kept"]) == kept
        assert sum(s["end"] - s["start"] for s in found[i]["spans"]) == len((t or "").encode()) - len(kept)
    assert suffixdedup.remove_repeats(nothing).count() == 0


def test_repeated_rows_repeat_each_other(spark):
    rows = spark.createDataFrame([(1, PASSAGE), (1, PASSAGE), (None, PASSAGE), (2, "é" * 150 + "x"), (3, "é" * 150)], "doc_id long, text string")
    found = suffixdedup.remove_repeats(rows, whole_characters=True).collect()
    assert len(found) == 5
    assert [bytes(r["kept"]) for r in found if r["doc_id"] in (1, None)] == [b""] * 3
    assert all(bytes(r["kept"]).decode() in ("x", "") for r in found)


def test_merged_transforms_against_counting():
    for _ in range(120):
        base = [bytes(RANDOM.choices(b"ab", k=RANDOM.randint(10, 60))) for _ in range(4)]
        strings = list(dict.fromkeys(
            bytes(c if RANDOM.random() < 0.97 else 99 for c in RANDOM.choice(base)) for _ in range(RANDOM.randint(1, 14))))
        weights = np.array([RANDOM.choice([1, 1, 1, 2]) for _ in strings])
        seen = Counter()
        for s, w in zip(strings, weights, strict=True):
            for k in range(len(s) - 15):
                seen[s[k:k + 16]] += int(w)
        for s, mask in zip(strings, repeated_windows(strings, weights, 16, RANDOM.choice([1, 2, 3, 5])), strict=True):
            assert mask.tolist() == [seen[s[k:k + 16]] >= 2 for k in range(len(s) - 15)]


def shingles(text, words=5):
    found = text.lower().split()
    return {tuple(found[k:k + words]) for k in range(max(1, len(found) - words + 1))}


def test_sketches_estimate_resemblance(docs, nothing, texts):
    rows = {r["doc_id"]: r for r in sketches.with_edits(docs).select(
        "*", sketches.resemblance(F.col("sketch"), F.col("edited_sketch")).alias("near"),
        sketches.distinct_count(F.col("sketch")).alias("n")).collect()}
    plain = [t or "" for _, t in texts]
    for i, t in enumerate(plain):
        half = len(t) // 2
        edited = t[:len(t) - half] + plain[(i + 1) % len(plain)][:half]
        assert rows[i]["edited"] == edited
        a, b = shingles(t), shingles(edited)
        assert abs(rows[i]["near"] - len(a & b) / len(a | b)) < 0.2
        assert abs(rows[i]["n"] / len(a) - 1) < 0.4
    assert rows[6]["sketch"] == rows[7]["sketch"]
    assert sketches.with_edits(nothing).count() == 0


def test_sketches_merge(spark):
    text = prose(2000)
    cut = text.index(" ", 5000)
    rows = spark.createDataFrame([(1, text[:cut]), (1, text[cut:])], "k int, text string").withColumn("s", sketches.sketch(F.col("text")))
    both = sketches.merge_all(rows, ["k"], "s").first()["s"]
    assert both == rows.agg(F.min("s").alias("a"), F.max("s").alias("b")).select(sketches.merged(F.col("a"), F.col("b"))).first()[0]
    assert len(both) == sketches.SIZE and both == sorted(set(both))


def test_one_document_follows_itself(spark):
    row = sketches.with_edits(spark.createDataFrame([(7, "abcdef")], "doc_id long, text string")).first()
    assert row["edited"] == "abcabc" and row["next_sketch"] == row["sketch"]


@pytest.mark.parametrize("shards", [1, 5, 16])
def test_kd_shards_are_level(spark, nothing, shards):
    rows = spark.createDataFrame(
        [(i, RANDOM.randint(1, 50), float(RANDOM.randint(0, 9)), i % 400) for i in range(6000)] + [(9999, None, None, None)],
        "doc_id long, size long, x double, copy long").repartition(4)
    placed = kdtree.kd_shards(rows, size="size", dimensions=["x", "size"], group="copy", key="doc_id", shards=shards)
    sums = [r["s"] for r in placed.groupBy("shard").agg(F.sum("size").alias("s")).collect()]
    assert len(sums) == shards and max(sums) / min(sums) < 1.06
    slots = kdtree.with_slots(placed, shard="shard", key="doc_id", tie="copy").groupBy("shard").agg(
        F.sort_array(F.collect_list("slot")).alias("s")).collect()
    assert all(r["s"] == list(range(len(r["s"]))) for r in slots)
    none = nothing.withColumn("size", F.length("text"))
    assert kdtree.kd_shards(none, size="size", dimensions=["size"], group="text", key="doc_id", shards=4).count() == 0


def test_kd_hot_group_is_split_and_small_ones_are_not(spark):
    rows = spark.range(4000).selectExpr("id doc_id", "10 size", "1.0 x", "case when id < 2000 then -1 else id div 4 end copy")
    placed = kdtree.kd_shards(rows, size="size", dimensions=["x"], group="copy", key="doc_id", shards=4)
    sums = [r["s"] for r in placed.groupBy("shard").agg(F.sum("size").alias("s")).collect()]
    assert max(sums) / min(sums) < 1.05
    assert placed.filter("copy >= 0").groupBy("copy").agg(F.countDistinct("shard").alias("n")).filter("n > 1").count() == 0


def test_pieces_are_whole_and_packed(docs, nothing, texts, tokenizer):
    from tokenizers import Tokenizer

    own = Tokenizer.from_str(tokenizer)
    pieces = packing.with_crc32(packing.tokenise(docs, tokenizer, capacity=256, keep=["doc_id"]))
    rows = packing.assign(pieces, docs.count(), capacity=256, group_docs=20).collect()
    for i, t in texts:
        ids = own.encode(t or "", add_special_tokens=False).ids + [2]
        mine = sorted((r["start"], r) for r in rows if r["doc_id"] == i)
        assert [x for _, r in mine for x in r["ids"]] == ids
        assert all(r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes()) and r["doc_tokens"] == len(ids) for _, r in mine)
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 256
    assert packing.assign(packing.tokenise(nothing, tokenizer, keep=["doc_id"]), 0).count() == 0


def test_first_fit_decreasing_by_hand():
    sizes = np.array([5, 7, 3, 8, 2, 4, 1])
    bins, offsets = packing.first_fit_decreasing(sizes, 10)
    assert bins.tolist() == [2, 1, 1, 0, 0, 2, 2] and offsets.tolist() == [0, 0, 7, 0, 8, 5, 9]


def test_nearest_against_all(spark):
    rng = np.random.default_rng(1)
    vectors = rng.normal(size=(3000, 16)) * rng.uniform(0.5, 2, size=(3000, 1))
    vectors[100:900] = vectors[100]
    rows = [(int(i), [float(x) for x in v]) for i, v in enumerate(vectors.astype(np.float32))]
    odd = [(5000, None), (5020, [0.0] * 16), (5040, [float("nan")] * 16), (None, [1.0] * 16), (5060, [None] + [1.0] * 15)]
    table = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>")
    settings = ann.Settings(list_vectors=100, block=200)
    found = {}
    for r in ann.search(table, table.filter("vec_id % 20 = 0"), settings=settings).orderBy("query_id", "rank").collect():
        found.setdefault(r["query_id"], []).append(r)
    assert sorted(found) == list(range(0, 3000, 20))
    exact, hits = vectors.astype(np.float32).astype(float), 0
    for q, own in found.items():
        scores = exact @ exact[q]
        scores[q] = -np.inf
        best = np.lexsort((np.arange(3000), -scores))[:20]
        assert [r["rank"] for r in own] == list(range(1, 21))
        assert np.allclose([r["score"] for r in own], scores[[r["vec_id"] for r in own]], rtol=1e-12)
        hits += len({r["vec_id"] for r in own} & set(best.tolist()))
    assert hits / (20 * len(found)) >= 0.9
    few = table.filter("vec_id < 5")
    assert ann.search(few, few.filter("vec_id = 0")).count() == 4
    assert ann.search(table.limit(0), table.limit(0)).count() == 0


def test_language_model_counts_and_norm(docs, nothing, texts):
    settings = lm.Settings(known_words=40, own_classes=20, shared_classes=6, factors=8, batch=64)
    learn = fold("doc_id", 7) != 2
    rows = {r["doc_id"]: r for r in lm.score(docs.select("doc_id", "text"), learn, settings=settings).collect()}
    tokens = {i: lm.words_of(t or "") + [lm.END] for i, t in texts}
    seen = Counter(w for i, own in tokens.items() if zlib.crc32(str(i).encode()) % 7 != 2 for w in own)
    total = sum(seen.values())
    for i, own in tokens.items():
        base = sum(np.log10((seen[w] + 1) / (total + len(seen) + 1)) for w in own)
        assert abs(rows[i]["base_score"] - base) < 1e-8
        assert (rows[i]["n_tokens"], rows[i]["n_known"], rows[i]["train_tokens"]) == (len(own), sum(seen[w] > 0 for w in own), total)
        assert rows[i]["score"] < 0
    assert rows[6]["score"] == pytest.approx(rows[7]["score"])
    assert lm.score(nothing, learn).count() == 0
    model = lm.initial(np.full(26, 1 / 26), settings)
    every = lm.class_log10(model, np.full(26, 3), np.full(26, 5), np.arange(26))
    assert (10 ** every).sum() == pytest.approx(1, abs=1e-5)


def test_languages_of_new_texts(spark, nothing):
    tongues = {"aa": "the and of thing with", "bb": "der und schaft keit ung", "cc": "el de ción que mente"}
    rows = [(n, " ".join(RANDOM.choices(words.split(), k=RANDOM.randint(2, 200))), name)
            for n, (name, words) in enumerate(list(tongues.items()) * 40)]
    table = spark.createDataFrame([*rows, (900, None, "aa"), (901, "", None), (902, "12 34!", "bb")], "doc_id long, text string, lang string")
    held = fold("doc_id", 4) == 2
    found = langid.predict(table, langid.train(table.filter(~held)), keep=["doc_id"]).collect()
    told = {r["doc_id"]: r for r in found}
    assert all(told[n]["lang_pred"] == "und" and told[n]["score"] == 0 for n in (900, 901, 902))
    right = [told[n]["lang_pred"] == name for n, _, name in rows if zlib.crc32(str(n).encode()) % 4 == 2]
    assert sum(right) / len(right) > 0.95
    net = langid.train(nothing)
    assert {r["lang_pred"] for r in langid.predict(table, net).collect()} == {"und"}
    with pytest.raises(ValueError):
        langid.predict(table, net, name="lang")


def test_toxic_pairs_of_terms(spark, nothing):
    rows = []
    for n in range(900):
        plain = RANDOM.choices(WORDS, k=RANDOM.randint(20, 60))
        rows.append((n, " ".join(RANDOM.sample(plain + ["dolt"] * (n % 3 == 0) * 3, len(plain))), int(n % 3 == 0)))
    rows = [(n, t, int("dolt" in t.split())) for n, t, _ in rows]
    table = spark.createDataFrame([*[(n, t) for n, t, _ in rows], (1000, None), (1001, "")], "doc_id long, text string")
    held = fold("doc_id", 3) == 1
    labels = spark.createDataFrame([(n, y) for n, _, y in rows] + [(5000, 1), (3, None)], "doc_id long, toxic int").filter(~held)
    scores = {r["doc_id"]: r["score"] for r in toxicity.score(table, toxicity.train(table, labels), keep=["doc_id"]).collect()}
    assert all(0 <= s <= 1 for s in scores.values()) and scores[1000] == scores[1001] < 0.7
    new = [(scores[n] >= 0.7, y) for n, _, y in rows if zlib.crc32(str(n).encode()) % 3 == 1]
    assert sum(p for p, y in new if y) / sum(y for _, y in new) > 0.9
    assert sum(p for p, y in new if not y) / sum(not y for _, y in new) < 0.05
    none = toxicity.train(nothing, labels)
    assert {r["score"] for r in toxicity.score(table, none).collect()} == {0.0}


def test_factors_learn_what_weights_cannot():
    rng = np.random.default_rng(5)
    label = rng.integers(0, 2, 1200)
    first = rng.integers(0, 2, 1200)
    terms = np.stack([first, 2 + (first ^ label)], axis=1).ravel().astype(np.int32)  # either term alone tells nothing
    offsets = np.arange(0, 2401, 2)
    machine = toxicity.fit(terms, offsets, np.arange(1200), label, buckets=8, epochs=40)
    told = toxicity.logits(machine, terms, offsets) > 0
    assert (told == (label == 1)).mean() > 0.95


def test_digest_of_whole_texts(docs, texts):
    made = {r[0]: r[1] for r in docs.select("doc_id", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)).collect()}
    assert made == {i: hashlib.sha256((t or "").encode()).hexdigest() for i, t in texts}

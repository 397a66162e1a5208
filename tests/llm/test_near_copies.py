"""Groups of near copies against brute force, with buckets of every size."""

import random

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from ledgerlift.llm import nearcopies

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def shingles(text):
    words = text.lower().split()
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))}


def expected(texts):
    sets = [shingles(t) for t in texts]
    parent = list(range(len(texts)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    pairs = 0
    for i, x in enumerate(sets):
        for j in range(i):
            if len(x & sets[j]) >= 0.8 * len(x | sets[j]):
                pairs += 1
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return sorted({root(i) for i in range(len(texts))}), pairs


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(11)
    words = ["".join(rng.choices("abcdefghijklm", k=6)) for _ in range(600)]

    def edited(text, edits):
        own = text.split()
        for _ in range(edits):
            own[rng.randrange(len(own))] = rng.choice(words)
        return " ".join(own)

    passage = " ".join(rng.choices(words, k=60))
    made = [" ".join(rng.choices(words, k=rng.randint(8, 260))) for _ in range(60)]
    for base in made[:40]:
        made += [edited(base, len(base.split()) // rng.choice([40, 50, 60, 70, 90])) for _ in range(rng.randint(1, 3))]
    made += [edited(made[0], 1) for _ in range(60)]  # a large group of near copies
    made += [passage + " " + " ".join(rng.choices(words, k=rng.randint(5, 60))) for _ in range(120)]  # a common passage
    return made


def table(spark, texts):
    return spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], SCHEMA).repartition(5)


def test_words_edited_here_and_there(spark, texts):
    stays, pairs = expected(texts)
    assert pairs > 100 and len(stays) < len(texts)
    kept = corpus_pipeline.drop_near_copies(spark, table(spark, texts), SF)
    assert sorted(r["doc_id"] for r in kept.collect()) == stays


def test_a_near_copy_survives_the_cut_of_repeats(spark, texts):
    base = texts[59] + " " + texts[58]
    own = base.split()
    own[len(own) // 2] = "other"
    kept = corpus_pipeline.stage(corpus_pipeline.drop_near_copies(spark, table(spark, [base, " ".join(own)]), SF), "kept")
    assert [(r["doc_id"], r["text"]) for r in corpus_pipeline.cut_repeats(spark, kept, SF).collect()] == [(0, base)]


def test_large_buckets(spark, texts):
    docs = corpus_pipeline.stage(table(spark, texts), "large-buckets")
    kept = nearcopies.survivors(docs, mark="doc_id", order=[], listed=3)
    assert sorted(r["doc_id"] for r in kept.collect()) == expected(texts)[0]


def test_pairs_of_large_buckets_that_no_star_links(spark, monkeypatch):
    """Every near copy shares its buckets with many texts that are like neither of the two."""
    rng = random.Random(3)
    words = ["".join(rng.choices("abcdefghijklm", k=6)) for _ in range(4000)]
    texts = [" ".join(rng.choices(words, k=80)) for _ in range(60)]
    texts += [t.rsplit(" ", 3)[0] + " other words here" for t in texts]
    stays, pairs = expected(texts)
    assert pairs == 60 and stays == [*range(60)]
    made = nearcopies.shingle_prints

    def crowded(docs, **options):
        bands = F.array([F.lit(i).cast("long") for i in range(nearcopies.BANDS)])
        return made(docs, **options).withColumns({"fp": F.xxhash64("node"), "bands": bands})

    monkeypatch.setattr(nearcopies, "shingle_prints", crowded)
    docs = corpus_pipeline.stage(table(spark, texts), "no-star")
    assert sorted(r["doc_id"] for r in nearcopies.survivors(docs, mark="doc_id", order=[]).collect()) == stays


@pytest.mark.parametrize("parts", [2, 1000])
def test_rare_shingles_lose_no_pair(spark, texts, parts):
    """Candidates of different components contain every pair at the threshold, whatever the parts."""
    sets = [sorted({hash(s) % (1 << 40) for s in shingles(t)}) for t in texts[:160]]
    rows = [(i, i // 2, s) for i, s in enumerate(sets)]
    made = corpus_pipeline.stage(spark.createDataFrame(rows, "node long, component long, hashes array<long>"), "rare-sets")
    got = {(r["a"], r["b"]) for r in nearcopies.rare_candidates(made, 0.8, parts).collect()}
    whole = [set(s) for s in sets]
    want = {(i, j) for i, x in enumerate(whole) for j in range(i)
            if i // 2 != j // 2 and len(x & whole[j]) >= 0.8 * len(x | whole[j])}
    assert want and want <= got and all(a // 2 != b // 2 for a, b in got)


def test_lower_thresholds_are_refused(spark):
    with pytest.raises(ValueError):
        nearcopies.survivors(table(spark, []), mark="doc_id", order=[], threshold=0.7)


def test_rare_candidates_do_not_grow_with_the_square_of_a_family(spark):
    """Texts that share three quarters of their shingles are no near copies: hardly a pair of them is made."""
    rng = random.Random(7)
    common = list(range(300))

    def made(n):
        own = [sorted({*common, *(1000 + 100 * i + k for k in range(40)), *rng.sample(range(300, 400), 10)}) for i in range(n)]
        rows = [(i, i, [h * 0x9E3779B97F4A7C15 % (1 << 63) for h in s]) for i, s in enumerate(own)]
        sets = spark.createDataFrame(rows, "node long, component long, hashes array<long>")
        return nearcopies.rare_candidates(corpus_pipeline.stage(sets, "family"), 0.8).count()

    assert made(200) == 0


def test_sketches_differ_in_no_more_bits_than_sets_in_hashes(spark):
    rng = random.Random(5)
    sets = [[rng.randrange(-(1 << 63), 1 << 63) for _ in range(rng.choice([0, 1, 40, 900]))] for _ in range(12)]
    sets += [s[:len(s) * 9 // 10] + [rng.randrange(-(1 << 63), 1 << 63)] for s in sets]
    rows = spark.createDataFrame(list(enumerate(sets)), "node long, hashes array<long>").select("node", *nearcopies.sketch("hashes")).collect()
    words = {r["node"]: [v & (1 << 64) - 1 for v in r[1:]] for r in rows}
    for i, x in enumerate(sets):
        for j, y in enumerate(sets):
            bits = sum((a ^ b).bit_count() for a, b in zip(words[i], words[j], strict=True))
            assert bits <= len(set(x) ^ set(y)) and (len(x) != 1 or i == j or len(y) or bits == 1)


def test_pairs_just_at_the_threshold_are_made(spark):
    """Equal and unequal sizes, at 0.8 exactly: the filters of the join lose none of them."""
    rows, want = [], set()
    for n, (common, one, other) in enumerate([(8, 1, 1), (8, 2, 0), (80, 10, 10), (80, 20, 0), (800, 150, 50), (4, 1, 0)]):
        base = [hash((n, k)) for k in range(common + one + other)]
        rows += [(2 * n, 2 * n, base[:common + one]), (2 * n + 1, 2 * n + 1, base[:common] + base[common + one:])]
        want.add((2 * n + 1, 2 * n))
    sets = corpus_pipeline.stage(spark.createDataFrame(rows, "node long, component long, hashes array<long>"), "at-threshold")
    assert {(r["a"], r["b"]) for r in nearcopies.rare_candidates(sets, 0.8).collect()} == want

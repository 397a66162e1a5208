"""Name rules against brute force over all pairs of rows."""

import random
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from ledgerlift.functions.similarity import similarity
from ledgerlift.functions.text import name_tokens
from ledgerlift.operators import duplicates as D
from ledgerlift.operators import skew
from ledgerlift.schemas import COMPANY_SUFFIXES, PERSON_TITLES


def people(spark, rows):
    return spark.createDataFrame(rows, "employee_id string, name string")


def tokens(name, drop):
    return [t for t in (w.strip(".,").lower() for w in name.strip().split()) if t not in drop]


def brute(rows, drop, blocked, abbreviations, trim, threshold=0.9):
    """(exact, short, fuzzy): rows with the earliest earlier row that matches, all pairs compared."""
    named = sorted((i, n, tokens(n, drop)) for i, n in rows if n is not None)
    named = [(i, n, t) for i, n, t in named if " ".join(t).strip()]
    first = {}
    for i, n, t in named:
        first.setdefault(" ".join(t), i)
    exact = {(i, first[" ".join(t)]) for i, n, t in named if first[" ".join(t)] != i}
    short, fuzzy = {}, {}
    for y, (j, m, u) in enumerate(named):
        for i, n, t in named[:y]:
            if i == j or (" ".join(t) == " ".join(u) and first[" ".join(t)] == i):
                continue
            a, b = (n.strip().lower(), m.strip().lower()) if trim else (n.lower(), m.lower())
            if abbreviations and len(t) > 1 and len(u) > 1 and t[0] == u[0] and t[-1] != u[-1]:
                x, z = sorted((t[-1], u[-1]), key=len)
                if len(x) == 1 and z.startswith(x):
                    short[j] = min(short.get(j, i), i)
                    continue
            if blocked and t[0][:3] != u[0][:3]:
                continue
            if SequenceMatcher(None, a, b).ratio() >= threshold:
                fuzzy[j] = min(fuzzy.get(j, i), i)
    return exact, set(short.items()), set(fuzzy.items())


def typo(rng, name):
    chars = list(name)
    for _ in range(rng.choice([0, 1, 1, 2])):
        at = rng.randrange(len(chars))
        kind = rng.random()
        if kind < 0.35:
            chars[at] = rng.choice("abcdeio")
        elif kind < 0.7:
            chars.insert(at, rng.choice("abcdeio "))
        elif len(chars) > 3:
            del chars[at]
    return "".join(chars)


def random_people(seed, n=160):
    rng = random.Random(seed)
    firsts = ["ann", "anna", "annabel", "bob", "bobby", "christopher", "li"]
    lasts = ["smith", "smyth", "stone", "montgomery", "montgomerie", "s", "o'neil", "li", "d"]
    out = []
    for i in range(n):
        name = f"{rng.choice(firsts)} {rng.choice(lasts)}"
        if rng.random() < 0.25:
            name = f"{rng.choice(firsts)} {rng.choice(['j', 'maria', 'k.'])} {rng.choice(lasts)}"
        if rng.random() < 0.4:
            name = typo(rng, name)
        if rng.random() < 0.2:
            name = rng.choice(["Dr ", "Mrs. "]) + name
        if rng.random() < 0.2:
            name = name + rng.choice([" ", ".", "  "])
        if rng.random() < 0.3:
            name = name.title()
        out.append((f"E{i:04d}", name))
    return out + [("E9001", None), ("E9002", "Dr"), ("E9003", "Mrs ."), ("E9004", "")]


def ids(df):
    return {(r["id"], r["other_id"]) for r in df.select("id", "other_id").collect()}


@pytest.mark.parametrize("seed", [1, 2])
def test_person_rules_find_what_all_pairs_find(spark, seed):
    data = random_people(seed)
    rows, known = D.staged_names(D.person_rows(people(spark, data)))
    exact, short, fuzzy = brute(data, PERSON_TITLES, True, True, True)
    assert ids(D.exact_matches(rows, known)) == exact
    assert ids(D.abbreviation_matches(rows, known)) == short
    assert ids(D.fuzzy_matches(rows, known=known)) == fuzzy
    assert fuzzy and short and exact


def test_company_rules_find_what_all_pairs_find(spark):
    rng = random.Random(5)
    bases = ["Green-Kelly", "Harris and Sons", "Harris & Sons", "Wood, Fox and Webb", "Ltd Brown", "Acme Holdings North",
             "Acme Holdings Norte", "Acme Holding North", "Li", "Lo"]
    data = [(f"V{i:03d}", typo(rng, rng.choice(bases)) + rng.choice(["", " Ltd", " Limited", " PLC"])) for i in range(80)]
    rows, known = D.staged_names(D.company_rows(spark.createDataFrame(data, "vendor_id string, vendor_name string")))
    exact, _, fuzzy = brute(data, COMPANY_SUFFIXES, False, False, False)
    assert ids(D.exact_matches(rows, known)) == exact
    assert ids(D.fuzzy_matches(rows, blocked=False, abbreviations=False, known=known)) == fuzzy


def test_salted_joins_change_nothing(spark, monkeypatch):
    """With a low limit every repeated name counts as heavy; results stay the same."""
    monkeypatch.setattr(skew, "HEAVY_ROWS", 2)
    data = [(f"E{i:04d}", "Ann Smith") for i in range(60)] + [(f"F{i:04d}", "ann s.") for i in range(40)] + [
        (f"G{i}", "Ann Smiths") for i in range(5)]
    rows = D.person_rows(people(spark, data))
    exact, short, fuzzy = brute(data, PERSON_TITLES, True, True, True)
    assert ids(D.exact_matches(rows)) == exact
    assert ids(D.abbreviation_matches(rows)) == short
    assert ids(D.fuzzy_matches(rows)) == fuzzy


def test_hot_name_gives_one_finding_per_row(spark):
    n = 3000
    data = [(f"E{i:05d}", "Ann Smith" if i % 3 else "Ann S.") for i in range(n)]
    rows = D.person_rows(people(spark, data))
    assert D.exact_matches(rows).count() == n - 2
    assert D.abbreviation_matches(rows).count() == n - 1
    assert D.fuzzy_matches(rows).count() <= n


def test_candidates_lose_nothing_at_other_thresholds(spark):
    rng = random.Random(9)
    names = sorted({typo(rng, typo(rng, rng.choice(["christopher wood", "montgomery burns", "elizabeth stone"])))
                    for _ in range(150)})
    keys = D.name_keys(D.person_rows(people(spark, [(f"E{i:04d}", n) for i, n in enumerate(names)])))
    for threshold in (0.88, 0.95):
        got = {(r.a, r.b) for r in D.similar_names(keys, threshold, blocked=False).select(
            F.col("early.raw").alias("a"), F.col("late.raw").alias("b")).collect()}
        rows = [n.strip().lower() for n in names]
        want = {(a, b) for i, a in enumerate(rows) for b in rows[i + 1:]
                if a != b and SequenceMatcher(None, a, b).ratio() >= threshold}
        assert {p for p in got if p[0] != p[1]} == want
    with pytest.raises(ValueError):
        D.similar_names(keys, 0.7)


def test_a_hot_signature_is_compared_in_a_triangle_of_parts(spark):
    """Many names that share their signatures: every part size gives the pairs that all pairs give."""
    rng = random.Random(2)
    names = sorted({"smithson" + "".join(rng.choices("abc", k=2)) for _ in range(400)} | {"smithsonian", "smithsonic"})
    keys = D.name_keys(D.person_rows(people(spark, [(f"E{i:04d}", n) for i, n in enumerate(names)]))).withColumn("block", F.lit(""))
    want = {(a, b) for i, a in enumerate(names) for b in names[i + 1:] if SequenceMatcher(None, a, b).ratio() >= 0.88}
    for part in (1, 3, 1000):
        got = D.near_names(keys.select("raw", "block"), 0.88, part_names=part)
        pairs = [(r["raw_1"], r["raw_2"]) for r in got.collect()]
        assert len(pairs) == len(set(pairs)) and want <= set(pairs)


def test_numbered_names_are_not_compared_with_all_others(spark, monkeypatch):
    """Names that differ in a few digits of one pattern share all common signatures; candidates stay near the result."""
    names = [f"Customer#{i:09d}" for i in range(0, 40_000, 10)]
    keys = D.name_keys(D.person_rows(people(spark, [(f"E{i:05d}", n) for i, n in enumerate(names)])))
    tried, compared = [], D._compared

    def counting(placed, *rest):
        tried.append(placed.groupBy("key").count().agg(F.sum(F.expr("count * (count - 1) / 2"))).first()[0] or 0)
        return compared(placed, *rest)

    monkeypatch.setattr(D, "_compared", counting)
    got = {(r.a, r.b) for r in D.similar_names(keys, 0.92, "levenshtein").select(
        F.col("early.raw").alias("a"), F.col("late.raw").alias("b")).collect()}
    digits = [f"{i:09d}" for i in range(0, 40_000, 10)]
    changed = {d: [d[:at] + x + d[at + 1:] for at in range(9) for x in "0123456789" if x > d[at]] for d in digits}
    known = set(digits)
    assert got == {(f"customer#{d}", f"customer#{c}") for d in digits for c in changed[d] if c in known}
    assert sum(tried) < 60 * len(names)


def test_subsequences_and_signatures_find_the_same_pairs(spark):
    """Whichever way names of two lengths meet, no pair of all pairs is lost."""
    rng = random.Random(4)
    bases = ["christopher wood", "montgomery burns", "li wu", "elizabeth stone of the northern highlands by the sea"]
    names = sorted({typo(rng, typo(rng, rng.choice(bases))).strip() for _ in range(200)})
    keys = D.name_keys(D.person_rows(people(spark, [(f"E{i:04d}", n) for i, n in enumerate(names)]))).withColumn("block", F.lit(""))
    want = {(a, b) for i, a in enumerate(names) for b in names[i + 1:] if SequenceMatcher(None, a, b).ratio() >= 0.9}
    assert any(len(a) > 45 for a, _ in want) and any(len(a) < 20 for a, _ in want)
    for keys_per_name, often in ((0, 1000), (0, 2), (40, 2), (5000, 200)):
        got = D.near_names(keys.select("raw", "block"), 0.9, 3, keys_per_name=keys_per_name, often=often)
        pairs = [(r["raw_1"], r["raw_2"]) for r in got.collect()]
        assert len(pairs) == len(set(pairs)) and want <= set(pairs)


def test_short_names_are_candidates(spark):
    names = sorted({"anna", "annas", "annxa", "xanna", "aaaa", "aaaaa", "abab", "ababa", "ann", "anns", "an", "ana", "bo", "bob"})
    keys = D.name_keys(D.person_rows(people(spark, [(f"E{i:04d}", n) for i, n in enumerate(names)])))
    for threshold in (0.86, 0.88, 0.9):
        got = {(r.a, r.b) for r in D.similar_names(keys, threshold, blocked=False).select(
            F.col("early.raw").alias("a"), F.col("late.raw").alias("b")).collect()}
        want = {(a, b) for i, a in enumerate(names) for b in names[i + 1:] if SequenceMatcher(None, a, b).ratio() >= threshold}
        assert got == want
        assert (("anna", "annas") in want) == (threshold < 0.889)


def test_shorter_names_reach_no_accepted_threshold():
    for threshold in (t / 1000 for t in range(500, 1000)):
        try:
            D.check_threshold(threshold)
        except ValueError:
            continue
        assert not [(a, b) for a in range(1, D.LEAST_LENGTH) for b in range(a, 20)
                    if 2 * (a if b > a else a - 1) / (a + b) >= threshold]


def test_tokens(spark):
    cases = {
        "Dr": [], ".": [""], "Ann Smith": ["ann", "smith"], "  Mrs. Ann  Smith, ": ["ann", "smith"], "": [],
        "Smith-Jones Dr J.": ["smith-jones", "j"],
    }
    df = spark.createDataFrame(list(cases.items()), "name string, want array<string>")
    for row in df.withColumn("got", name_tokens(F.col("name"), PERSON_TITLES)).collect():
        assert row["got"] == row["want"], row["name"]
    company = spark.createDataFrame([("Ltd Brown Ltd",)], "name string")
    assert company.select(name_tokens(F.col("name"), COMPANY_SUFFIXES)).first()[0] == ["brown"]


def test_similarity_takes_the_earlier_name_first(spark):
    """The ratio depends on the order of its arguments."""
    df = spark.createDataFrame([("tide", "diet"), ("diet", "tide")], "a string, b string")
    got = [r[0] for r in df.orderBy("a").select(similarity(F.col("a"), F.col("b"))).collect()]
    assert got == [SequenceMatcher(None, "diet", "tide").ratio(), SequenceMatcher(None, "tide", "diet").ratio()]
    assert got[0] != got[1]

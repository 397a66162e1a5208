import random
from collections import Counter
from datetime import date, timedelta
from difflib import SequenceMatcher

import pytest

from ledgerlift.operators import clusters as K
from ledgerlift.operators import duplicates as D
from ledgerlift.operators import skew


def components_of(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    return {n: find(n) for n in parent}


def solved(spark, edges):
    df = spark.createDataFrame(edges, "a string, b string")
    return {r["node"]: r["component"] for r in K.connected_components(df).collect()}


@pytest.mark.parametrize("shape", ["random", "chain", "star", "loops"])
def test_components(spark, shape, monkeypatch):
    rng = random.Random(3)
    name = "n{:04d}".format
    if shape == "random":
        edges = [(name(rng.randrange(150)), name(rng.randrange(150))) for _ in range(110)]
    elif shape == "chain":
        edges = [(name(i), name(i + 1)) for i in range(60)]
        rng.shuffle(edges)
    elif shape == "star":
        monkeypatch.setattr(skew, "HEAVY_ROWS", 10)
        edges = [(name(77), name(i)) for i in range(150) if i != 77]
    else:
        edges = [("a", "a"), ("b", "c"), ("c", "b"), ("b", "b")]
    assert solved(spark, edges) == components_of(edges)


def vendors(spark, rows):
    return spark.createDataFrame(
        [(f"PO-{i:03d}", v, n) for i, (v, n) in enumerate(rows)], "po_id string, vendor_id string, vendor_name string")


def test_vendor_master(spark):
    data = vendors(spark, [
        ("V1", "Green-Kelly"), ("V1", "Green-Kelly"), ("V2", "Green-Kelly Ltd"), ("V3", "Harris and Sons"),
        ("V4", "Harris and Sonss"), ("V5", "Ltd"), ("V6", "PLC"),
    ])
    clusters = K.vendor_clusters(data).cache()
    master = {r["vendor_id"]: r["canonical_vendor_name"] for r in K.vendor_master(clusters).collect()}
    # most orders, then the longer name; names of suffixes only stay alone
    assert master == {"V1": "Green-Kelly", "V2": "Green-Kelly", "V3": "Harris and Sonss", "V4": "Harris and Sonss",
                      "V5": "Ltd", "V6": "PLC"}
    assert K.consolidation(clusters).first().asDict() == {"vendors": 4, "raw_variants": 6}
    listed = {r["cluster"]: r["member_ids"] for r in K.member_list(clusters).collect()}
    assert listed == {"V1": "V1, V2", "V3": "V3, V4"}


def test_vendor_with_two_names_has_one_master_row(spark):
    """One id with two names, one of them shared with another vendor."""
    data = vendors(spark, [("V1", "Alpha Trading"), ("V1", "Omega Works"), ("V2", "Omega Works PLC"), ("V3", "Third")])
    master = K.vendor_master(K.vendor_clusters(data)).collect()
    assert sorted(r["vendor_id"] for r in master) == ["V1", "V2", "V3"]
    assert len({r["canonical_vendor_name"] for r in master if r["vendor_id"] in ("V1", "V2")}) == 1


HR = "employee_id string, name string, dept_code string, cost_centre string, hire_date date"


def test_review_of_missing_facts(spark):
    hr = spark.createDataFrame([
        ("E1", "Ann Smith", None, "CC-001", date(2020, 1, 1)), ("E2", "Ann Smith", None, "CC-001", date(2020, 1, 20)),
        ("E3", "Bob Stone", "D1", "CC-002", None), ("E4", "Bob Stone", "D1", "CC-002", date(2020, 1, 1)),
        ("E5", "Cy Young", "D1", "CC-002", date(2020, 1, 1)),
    ], HR)
    groups = K.person_clusters(hr).cache()
    rows = {r["employee_id"]: r for r in review_of(hr, groups).collect()}
    assert rows["E1"]["same_dept_code"] and rows["E1"]["recommendation"] == "likely_duplicate" and rows["E1"]["partner_id"] == "E2"
    assert rows["E3"]["hire_date_delta_days"] is None and rows["E3"]["recommendation"] == "needs_human_review"
    assert rows["E3"]["partner_id"] == "E4" and "E5" not in rows
    master = {r["employee_id"]: r["cluster_id"] for r in K.person_master(hr, groups).collect()}
    assert master == {"E1": "E1", "E2": "E1", "E3": "E3", "E4": "E3", "E5": None}


def review_of(hr, groups, issues=None, fuzzy=True):
    return K.person_review(hr, groups, D.name_links(D.person_rows(hr), fuzzy=fuzzy), with_issue=issues)


def ratio(left, right):
    (_, a), (_, b) = sorted([left, right])
    return SequenceMatcher(None, a.strip().lower(), b.strip().lower()).ratio()


@pytest.mark.parametrize(("seed", "size"), [(8, 70), (3, 130)])
def test_review_is_the_best_of_all_pairs(spark, seed, size):
    """Clusters of over 50 rows: counts, nearest hires, gaps that settle issues and best names against all pairs."""
    rng = random.Random(seed)
    names = ["Ann Smith", "Dr Ann Smith", "ann smith ", "Ann S.", "Ann Smiths", "Bob Stone", "Bob S", "Bob Stonne"]
    rows = [(f"E{i:03d}", rng.choice([*names, f"Solo N{i}x"]), rng.choice(["D1", "D2", None]), rng.choice(["CC-001", "CC-002"]),
             rng.choice([None, date(2020, 1, 1) + timedelta(days=rng.randrange(90))])) for i in range(size)]
    hr = spark.createDataFrame(rows, HR)
    groups = K.person_clusters(hr).cache()
    cluster = {r["id"]: r["cluster"] for r in groups.collect()}
    people = {r[0]: r for r in rows if r[0] in cluster}
    likely = {
        a: {b: abs((people[a][4] - people[b][4]).days) for b in people
            if a != b and cluster[a] == cluster[b] and people[a][2:4] == people[b][2:4] and people[a][4] and people[b][4]
            and abs((people[a][4] - people[b][4]).days) <= 30} for a in people}
    totals = K.review_metrics(K.review_totals(hr, groups)).first().asDict()
    sizes = Counter(cluster.values())
    assert max(sizes.values()) > 30 and totals["pairs"] == sum(n * (n - 1) // 2 for n in sizes.values())
    assert totals["likely"] == sum(map(len, likely.values())) // 2
    issues = spark.createDataFrame([(f"E{i:03d}",) for i in range(size) if i % 2], "row_identifier string")
    got = {r["employee_id"]: r for r in review_of(hr, groups, issues).collect()}
    assert set(got) == set(people)
    for a, r in got.items():
        gaps = likely[a]
        assert r["likely_rows"] == len(gaps)
        settling = [g for b, g in gaps.items() if b > a or int(b[1:]) % 2 == 0]
        assert r["settle_gap"] == min(settling, default=None)
        if gaps:
            assert r["hire_date_delta_days"] == min(gaps.values()) == gaps[r["partner_id"]]
            assert r["recommendation"] == "likely_duplicate"
        else:
            assert r["partner_id"] == r["named_partner_id"] and r["recommendation"] == "needs_human_review"
        raw = lambda i: people[i][1].strip().lower()
        same = sorted(b for b in people if b != a and raw(b) == raw(a))
        assert r["named_score"] == pytest.approx(ratio((a, people[a][1]), (r["named_partner_id"], people[r["named_partner_id"]][1])))
        if same:
            assert (r["named_partner_id"], r["named_score"]) == (same[0], 1.0)
        assert cluster[r["named_partner_id"]] == cluster[a]
        assert r["similarity_score"] == pytest.approx(ratio((a, r["name"]), (r["partner_id"], r["partner_name"])))


def test_review_of_a_large_cluster_has_a_row_per_record(spark):
    hr = spark.createDataFrame(
        [(f"E{i:05d}", "Ann Smith", "D1", "CC-001", date(2020, 1, 1)) for i in range(3000)], HR)
    groups = K.person_clusters(hr).cache()
    assert K.review_metrics(K.review_totals(hr, groups)).first()["likely"] == 3000 * 2999 // 2
    review = review_of(hr, groups)
    assert review.filter("likely_rows = 2999 and partner_id <> employee_id and named_partner_id <> employee_id").count() == 3000
    notes = K.member_notes(spark.createDataFrame(
        [(f"V{i:04d}", f"N{i}", 1, "V0000") for i in range(1500)] + [("W1", "a", 1, "W1"), ("W2", "a", 1, "W1"), ("X", "b", 1, "X")],
        "vendor_id string, vendor_name string, orders long, cluster string"))
    assert {r["member_ids"] for r in notes.collect()} == {"V0000 to V1499 (1500 vendors)", "W1 to W2 (2 vendors)"}


def test_joins_of_growing_tables_collect_no_side_in_the_driver(spark):
    """below the broadcast limit every such join sent one side to the driver."""
    from ledgerlift.operators.skew import join_to_groups

    rows = spark.createDataFrame([(n, f"g{n % 3}") for n in range(9)] + [(9, None)], "id int, g string")
    groups = spark.createDataFrame([("g0", 3, "x"), ("g1", 3, "y"), (None, 1, "z")], "g string, n long, fact string")
    got = join_to_groups(rows, groups, "g", "n", "id")
    assert sorted((r["id"], r["n"], r["fact"]) for r in got.collect()) == [(n, 3, "xy"[n % 3]) for n in (0, 1, 3, 4, 6, 7)]
    plan = got._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "SortMergeJoin [g" in plan and plan.count("BroadcastHashJoin") <= 2  # those of at most 256 heavy keys

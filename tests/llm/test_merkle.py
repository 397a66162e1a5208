"""Merkle proofs against a plain tree: nulls, ties, repeated rows, lone leaves, hot groups, borders of parts."""

import hashlib
import random
import zlib

import pytest
from oracle import connect, difference, spark_rows, sql_rows
from pyspark.sql import functions as F

from ledgerlift.llm import merkle
from ledgerlift.llm.queries import ORACLES, QUERIES

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def digest(row):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def tree(leaves):
    """Root and for each leaf its siblings, bottom up, as lists."""
    proofs, owners, nodes = [[] for _ in leaves], [[n] for n in range(len(leaves))], leaves
    while len(nodes) > 1:
        runs = [range(n, min(n + 16, len(nodes))) for n in range(0, len(nodes), 16)]
        for run in runs:
            for n in run:
                for leaf in owners[n]:
                    proofs[leaf].append("".join(nodes[m] for m in run if m != n))
        owners = [[leaf for n in run for leaf in owners[n]] for run in runs]
        nodes = [h(*(nodes[n] for n in run)) for run in runs]
    return nodes[0], proofs


def by_hand(rows):
    first = lambda v: (v is not None, v)
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = []
    for name in names:
        own = sorted(groups[name], key=lambda r: (first(r[0]), digest(r)))
        trees.append((own, *tree([digest(r) for r in own])))
    root, above = tree([t[1] for t in trees])
    out = []
    for (own, subroot, proofs), upper in zip(trees, above, strict=True):
        out += [(r[0], digest(r), subroot, root, h(*p, *upper)) for r, p in zip(own, proofs, strict=True)]
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    made = [(n, "hot" if n % 3 else f"s{n % 57}é", rng.choice(["en", "de", None]), n, f"Text {n} Ä") for n in range(1200)]
    made += [(2000 + n, f"lone{n}", "en", 1, "x") for n in range(40)]
    made += [(None, "hot", None, None, None), (None, None, None, None, None), (5, None, "", 0, ""), (7, "hot", "en", 3, "Tie")]
    return made + [(9, "hot", "en", 3, "again")] * 300 + [(3000, "long", "en", 5, "y" * 1_200_000)]


@pytest.mark.parametrize("part_rows", [7, 100, 5000])
def test_as_the_plain_tree(spark, rows, part_rows):
    table = spark.createDataFrame(rows, SCHEMA).repartition(5)
    leaves = table.withColumn("leaf", merkle.leaf_digest([F.col(c) for c in table.columns])).drop("text", "n_chars")
    proven = merkle.with_proofs(leaves, part_rows=part_rows).withColumn(
        "folded", merkle.folded(F.col("leaf"), F.col("proof"), F.col("places")))
    got = proven.select("doc_id", "leaf", "subroot", "root", F.sha2(F.array_join("proof", ""), 256), "folded", "lang").collect()
    assert sorted((tuple(r)[:5] for r in got), key=repr) == by_hand(rows)
    assert all(r["folded"] == r["root"] for r in got)


def test_one_row_no_row_and_clashing_names(spark):
    one = spark.createDataFrame([(1, "s", "abc")], "doc_id long, source string, leaf string")
    r = merkle.with_proofs(one).first()
    assert (r["subroot"], r["root"], r["proof"], r["places"]) == ("abc", "abc", [], [])
    nothing = merkle.with_proofs(one.limit(0))
    assert nothing.count() == 0 and nothing.columns == [*one.columns, "subroot", "root", "proof", "places"]
    with pytest.raises(ValueError, match="root"):
        merkle.with_proofs(one.withColumn("root", F.lit(1)))


def test_a_changed_leaf_leads_elsewhere(spark, rows):
    table = spark.createDataFrame(rows[:200], SCHEMA)
    leaves = table.select("doc_id", "source", merkle.leaf_digest([F.col(c) for c in table.columns]).alias("leaf"))
    roots = merkle.with_proofs(leaves).select(
        "root", merkle.folded(F.sha2("leaf", 256), F.col("proof"), F.col("places")).alias("folded")).collect()
    assert all(r["root"] != r["folded"] for r in roots)


def test_missing_nodes_are_the_fewest():
    for count in (1, 16, 17, 300, 5000):
        for low, end in ((0, count), (0, 1), (count // 2, count // 2 + 1), (count // 3, count)):
            if low >= end:
                continue
            leaves = [h(str(n)) for n in range(count)]
            root, proofs = tree(leaves)
            levels = [leaves]
            while len(levels[-1]) > 1:
                levels.append([h(*levels[-1][n:n + 16]) for n in range(0, len(levels[-1]), 16)])
            wanted = list(merkle.missing(low, end, count))
            assert len(wanted) == len(set(wanted)) <= 30 * len(levels)
            got = merkle.paths(low, leaves[low:end], count, {c: levels[c[0]][c[1]] for c in wanted})
            assert got[0] == root and ["".join(p[0]) for p in got[1]] == ["".join(p) for p in proofs[low:end]]


def test_registered_query(spark):
    con = connect("/root/testdata/sf0.001")
    got = QUERIES["op11_merkle_manifest"](spark, "/root/testdata/sf0.001").collect()
    rows = con.execute("SELECT doc_id, source, lang, n_chars, text FROM documents").fetchall()
    assert sorted((tuple(r)[:5] for r in got), key=repr) == by_hand(rows)
    changed = {r[0] for r in rows if r[4] and zlib.crc32(str(r[0]).encode()) % 5 == 0 and any("A" <= c <= "Z" for c in r[4])}
    assert difference(spark_rows(QUERIES["op11_merkle_manifest"](spark, "/root/testdata/sf0.001")),
                      sql_rows(con, ORACLES["op11_merkle_manifest"])) is None
    assert changed and {r["doc_id"] for r in got if not r["verified"]} == changed

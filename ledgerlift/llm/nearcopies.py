"""Groups of texts whose word shingles resemble each other, with exact tests of all candidates.

Rows with one set of shingles are one node. Candidates come from two sources:

* fingerprints linked at SimHash anchors (see ``simhash``),
* bands of minimum hashes: 32 bands of four. Two sets at resemblance s agree in a band with
  probability s^4, so at 0.8 all 32 differ for one pair in 20 million.

Buckets of a band with up to ``listed`` nodes give all their pairs. Larger ones give a star
around their least node, and their nodes meet again in the buckets of each two bands at most
eight apart (eight minimum hashes), which are listed or linked as stars in the same way.
So rows and candidates grow with the nodes, whatever the size of a group.

Every candidate is tested by the exact resemblance of the two shingle sets.

A pair all of whose common buckets are large on both levels may not be linked to either star.
So nodes of large buckets meet once more, in an exact way: two sets at the threshold share one
of the rarest shingles of each (``rare_candidates``). Nodes that are connected already need no
further link, so a group of near copies costs nothing here, whatever its size.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlift.llm.batches import arrow_schema, extended, map_slices, texts_of, with_fields
from ledgerlift.llm.simhash import at_anchors, fingerprint, links_at_anchors, shingle_hashes
from ledgerlift.operators.clusters import connected_components
from ledgerlift.operators.skew import join_to_groups
from ledgerlift.sources.stages import stage

LEAST_THRESHOLD = 0.8
BANDS, BAND_ROWS = 32, 4
APART = 8
LISTED = 16
PART_NODES = 1000
SKETCH = [f"bits_{i}" for i in range(8)]

_BLOCK = 1 << 11
_DRAWN = np.random.default_rng(20).integers(0, 1 << 63, (3, BANDS * BAND_ROWS), np.uint64)
_FLIP, _TIMES = _DRAWN[0], _DRAWN[1] * np.uint64(2) + np.uint64(1)
_FIRST, _FOLD = _DRAWN[2, :BANDS], np.uint64(0x9E3779B97F4A7C15)


def band_keys(hashes: np.ndarray) -> np.ndarray:
    """One 64-bit key a band of the set's minimum hashes; no hash: no key."""
    if not len(hashes):
        return np.empty(0, np.uint64)
    least = np.full(BANDS * BAND_ROWS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), _BLOCK):
        mixed = (hashes[at:at + _BLOCK, None] ^ _FLIP) * _TIMES
        np.minimum(least, mixed.min(axis=0), out=least)
    key = _FIRST
    for column in least.reshape(BANDS, BAND_ROWS).T:
        key = (key ^ column) * _FOLD
        key = key ^ (key >> np.uint64(31))
    return key


def shingle_prints(docs: DataFrame, *, words: int, text: str, keep: list[str]) -> DataFrame:
    """The columns ``keep``, node (a hash of the set of shingles), fp (SimHash) and bands of each whole text."""
    schema = with_fields(docs, keep, node=T.LongType(), fp=T.LongType(), bands=T.ArrayType(T.LongType()))
    fields = arrow_schema(schema)

    def start():
        from xxhash import xxh3_64_intdigest

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            node, fp, bands = [], [], []
            for t in texts_of(batch, text):
                found = shingle_hashes(t, words)
                fp.append(fingerprint(found))
                found = np.unique(found)
                node.append(xxh3_64_intdigest(found.tobytes()))
                bands.append(band_keys(found).view(np.int64))
            longs = {n: pa.array(np.array(v, np.uint64).view(np.int64)) for n, v in (("node", node), ("fp", fp))}
            return extended(batch, keep, longs | {"bands": pa.array(bands, pa.list_(pa.int64()))}, fields)

        return work

    return map_slices(docs.select(*dict.fromkeys([*keep, text])), text, start, schema)


def _bucket_links(placed: DataFrame, listed: int, name: str) -> tuple[DataFrame, DataFrame]:
    """Candidates (a, b) of the buckets of ``placed(key, node, ...)``, and the rows in buckets of over ``listed`` nodes.

    Large buckets give stars only; ``rare_candidates`` finds the rest of their pairs.
    """
    sizes = placed.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("least")).filter("n >= 2")
    rows = stage(join_to_groups(placed, stage(sizes, f"{name}-sizes"), "key", "n", "node"), name)
    few = rows.filter(F.col("n") <= listed).groupBy("key").agg(F.sort_array(F.collect_list("node")).alias("all"))
    pairs = F.flatten(F.transform("all", lambda b, i: F.transform(
        F.slice("all", i + 2, F.size("all")), lambda a: F.struct(a.alias("a"), b.alias("b")))))
    many = rows.filter(F.col("n") > listed)
    return few.select(F.inline(pairs)).unionByName(many.select(F.col("node").alias("a"), F.col("least").alias("b"))), many


def band_candidates(nodes: DataFrame, listed: int = LISTED) -> tuple[DataFrame, DataFrame]:
    """(a, b): nodes that meet in a bucket of one band, or of two where that is large; and the nodes of large buckets."""
    placed = nodes.select("node", F.posexplode("bands").alias("band", "key")).select("key", "node", "band")
    links, many = _bucket_links(placed, listed, "near-buckets")
    again = many.groupBy("node").agg(F.collect_list("band").alias("large")).join(nodes.select("node", "bands"), "node")
    both = F.flatten(F.transform("large", lambda i: F.transform(F.sequence(F.lit(1), F.lit(APART)), lambda d: F.xxhash64(
        F.get("bands", i), F.get("bands", (i + d) % BANDS)))))
    second, _ = _bucket_links(again.select(F.explode(both).alias("key"), "node"), listed, "near-second")
    return links.unionByName(second), many.select("node").distinct()


def sketch(hashes: str) -> list[Column]:
    """A bit for each of 512 classes of hashes, as eight longs: whether an odd number of the set is in it.

    Common hashes cancel, so two sets differ in at least as many hashes as their sketches in bits.
    """
    def word(i: int) -> Column:
        return F.aggregate(hashes, F.lit(0).cast("long"), lambda bits, h: F.when(
            F.pmod(F.shiftright(h, 6), F.lit(len(SKETCH))) == i,
            bits.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(h, F.lit(64)).cast("int")))).otherwise(bits))

    return [word(i).alias(c) for i, c in enumerate(SKETCH)]


def rare_candidates(sets: DataFrame, threshold: float, part_nodes: int = PART_NODES) -> DataFrame:
    """(a, b): nodes of different components that share one of the rarest shingles of both.

    ``sets`` is a written table (node, component, hashes). In any one order of all shingles, two
    sets at the threshold share one among the first ``size - ceil(threshold * size) + 1`` of each;
    rare ones come first here. At the first shingle that two sets share, no more of them can be
    common than what follows there in either, and they differ in no fewer shingles than their
    sketches in bits; pairs that either keeps below the threshold are not made. The nodes of a
    shingle are cut into parts and every two parts are a cell, so no task holds a shingle's nodes.
    """
    each = sets.select("node", F.explode("hashes").alias("key"))
    often = each.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    ordered = each.join(often, "key", "left").groupBy("node").agg(
        # bounded by one text
        F.sort_array(F.collect_list(F.struct(F.coalesce("n", F.lit(1)).alias("n"), "key"))).alias("all"))
    size = F.size("all")
    first = F.slice("all", 1, size - F.ceil(size * threshold - 1e-9).cast("int") + 1)
    sketched = sets.select("node", "component", *sketch("hashes"))
    placed = ordered.select("node", size.alias("size"), F.posexplode(first).alias("place", "s")).filter("s.n > 1").select(
        "node", "size", "place", F.col("s.key").alias("key")).join(sketched, "node")
    placed = stage(placed, "near-rare")
    mixed = placed.groupBy("key").agg(
        F.ceil(F.count(F.lit(1)) / part_nodes).cast("int").alias("parts"), F.min("component").alias("x"), F.max("component").alias("y")
    ).filter("x <> y").select("key", "parts")
    dealt = placed.join(mixed, "key").withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    x = dealt.withColumns({"i": F.col("part"), "j": F.explode(F.sequence("part", F.col("parts") - 1))}).alias("x")
    y = dealt.withColumns({"i": F.explode(F.sequence(F.lit(0), "part")), "j": F.col("part")}).alias("y")
    met = [F.col(f"x.{c}") == F.col(f"y.{c}") for c in ("key", "i", "j")]
    least, most = F.least("x.size", "y.size"), F.greatest("x.size", "y.size")
    both, follow = F.col("x.size") + F.col("y.size"), [F.col(f"{c}.size") - F.col(f"{c}.place") for c in "xy"]
    apart = reduce(Column.__add__, [F.bit_count(F.col(f"x.{c}").bitwiseXOR(F.col(f"y.{c}"))) for c in SKETCH])
    # a share t of the union is t / (1 + t) of both sizes
    return x.join(y, [*met, F.col("x.component") != F.col("y.component"), least >= most * threshold - 1e-9,
                      (F.col("x.i") < F.col("x.j")) | (F.col("x.node") < F.col("y.node")),
                      F.least(*follow) * (1 + threshold) >= both * threshold - 1e-6,
                      apart * (1 + threshold) <= both * (1 - threshold) + 1e-6]).select(
        F.greatest("x.node", "y.node").alias("a"), F.least("x.node", "y.node").alias("b")).distinct()


def anchor_candidates(nodes: DataFrame, threshold: int = 2) -> DataFrame:
    """(a, b): nodes whose fingerprints are equal or linked at an anchor, each with the least of its fingerprint."""
    prints = stage(nodes.groupBy("fp").agg(F.min("node").alias("head"), F.count(F.lit(1)).alias("n")), "near-prints")
    same = join_to_groups(nodes.select("fp", "node"), prints.filter("n > 1"), "fp", "n", "node")
    links = links_at_anchors(at_anchors(prints.select("fp"), threshold), threshold)
    ends = [prints.select(F.col("fp").alias(c), F.col("head").alias(f"head_{c}")) for c in "ab"]
    across = links.join(ends[0], "a").join(ends[1], "b")
    return same.select(F.col("node").alias("a"), F.col("head").alias("b")).unionByName(
        across.select(F.col("head_a").alias("a"), F.col("head_b").alias("b")))


def alike(pairs: DataFrame, texts: DataFrame, threshold: float, words: int) -> DataFrame:
    """The pairs (a, b) whose shingle sets have at least ``threshold`` of their union in common; ``texts`` is (node, text)."""
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])
    counts = pairs.groupBy("b").agg(F.count(F.lit(1)).alias("n"))
    centres = counts.join(texts.withColumnsRenamed({"node": "b", "text": "text_b"}), "b")
    both = join_to_groups(pairs, centres, "b", "n", "a").join(texts.withColumnsRenamed({"node": "a", "text": "text_a"}), "a")

    def start():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            sets: dict = {}

            def shingles(node: int, text: str) -> np.ndarray:
                if node not in sets:
                    sets[node] = np.unique(shingle_hashes(text, words))
                return sets[node]

            near = []
            for a, b, x, y in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "text_a", "text_b")), strict=True):
                left, right = shingles(a, x), shingles(b, y)
                common = len(np.intersect1d(left, right, assume_unique=True))
                near.append(common >= threshold * (len(left) + len(right) - common))
            return batch.select(["a", "b"]).filter(pa.array(near))

        return work

    return map_slices(both.select("a", "b", "text_a", "text_b"), "text_a", start, schema, 4 << 20)


def shingle_sets(texts: DataFrame, words: int) -> DataFrame:
    """(node, hashes): the distinct shingles of each of ``texts(node, text)``."""
    schema = T.StructType([T.StructField("node", T.LongType()), T.StructField("hashes", T.ArrayType(T.LongType()))])

    def start():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [np.unique(shingle_hashes(t, words)).view(np.int64) for t in texts_of(batch, "text")]
            return pa.RecordBatch.from_arrays([batch.column("node"), pa.array(found, pa.list_(pa.int64()))], names=["node", "hashes"])

        return work

    return map_slices(texts.select("node", "text"), "text", start, schema)


def survivors(
    docs: DataFrame, *, mark: str, order: list[str], threshold: float = LEAST_THRESHOLD, words: int = 5, text: str = "text",
    listed: int = LISTED,
) -> DataFrame:
    """(mark): one row of each group, the least by the columns ``order`` and then by its mark.

    A group is what pairs at a resemblance of ``threshold`` or more connect. ``docs`` should
    be a written table, as it is read twice, and ``mark`` a long that no two rows share.
    Texts without words are one group.
    """
    if threshold < LEAST_THRESHOLD:
        raise ValueError(f"bands are laid out for resemblances of {LEAST_THRESHOLD} and more, not {threshold}")
    prints = stage(shingle_prints(docs, words=words, text=text, keep=[*order, mark]), "near-rows")
    nodes = stage(prints.groupBy("node").agg(
        F.min(F.struct(*order, mark)).alias("least"), F.min("fp").alias("fp"), F.first("bands").alias("bands")), "near-nodes")
    banded, crowded = band_candidates(nodes, listed)
    pairs = stage(banded.unionByName(anchor_candidates(nodes)).filter("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "near-pairs")
    crowded = stage(crowded, "near-crowded")
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("node")).unionByName(crowded).distinct().join(
        nodes.select("node", F.col(f"least.{mark}").alias(mark)), "node")
    texts = stage(docs.select(mark, F.col(text).alias("text")).join(wanted, mark).select("node", "text"), "near-texts")
    links = stage(alike(pairs, texts, threshold, words), "near-links")
    joined = connected_components(links)
    if not crowded.isEmpty():
        sets = shingle_sets(texts.join(crowded, "node", "left_semi"), words).join(joined, "node", "left")
        sets = stage(sets.select("node", "hashes", F.coalesce("component", "node").alias("component")), "near-sets")
        rest = stage(rare_candidates(sets, threshold).join(pairs, ["a", "b"], "left_anti"), "near-rest")
        more = stage(alike(rest, texts, threshold, words), "near-more")
        if not more.isEmpty():
            joined = connected_components(links.unionByName(more))
    groups = nodes.select("node", "least").join(joined, "node", "left").groupBy(F.coalesce("component", "node").alias("g"))
    return groups.agg(F.min("least").alias("least")).select(f"least.{mark}")

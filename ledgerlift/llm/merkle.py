"""Merkle manifest of a dataset with one proof a row, by multiproofs of row ranges.

Rows become leaves, the leaves of a group ascend by key, and runs of 16 nodes become their
parent until one node is left, the group's subroot. Subroots ascend by group and are
joined into the root in the same way. A digest is the lowercase hex SHA-256 of its inputs,
digests as hex text.

Leaves lie in ascending parts of bounded size. Each part derives the nodes that it holds
completely and publishes those whose parent it does not; only parents across part borders
are joined level by level. For its proofs a part computes the union of node coordinates
that its leaves cannot derive, fetches them once, derives the interiors that its leaves
share and expands the proof of every leaf locally. A group of any size, or groups of one
row each, are cut by rows alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlift.llm.batches import arrow_schema, with_fields
from ledgerlift.operators.ordered import PART, in_parts, spans
from ledgerlift.sources.stages import stage

FAN = 16
TOP = -1  # number of the tree over the subroots
PART_ROWS = 32_768
SLICE_ROWS = 4096
_NODES = "tree long, height int, level int, index long, hash string"


def leaf_digest(fields: list[Column]) -> Column:
    """Digest of a row: each field as UTF-8 byte count, colon and value, or a dash if null."""
    def part(field: Column) -> Column:
        value = field.cast("string")
        return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value))

    return F.sha2(F.concat(*map(part, fields)), 256)


def joined(digests: list[str]) -> str:
    return hashlib.sha256("".join(digests).encode()).hexdigest()


def height(count: int) -> int:
    """Levels from ``count`` leaves to a single node."""
    levels = 0
    while count > 1:
        count, levels = -(-count // FAN), levels + 1
    return levels


def peaks(low: int, digests: list[str], count: int) -> Iterator[tuple[int, int, str]]:
    """(level, index, digest) of the nodes derived from leaves ``low`` onwards whose parent needs other leaves.

    ``count`` is the number of leaves of the whole tree; its root is a peak.
    """
    level = 0
    while digests:
        end = low + len(digests)
        first = -(-low // FAN)
        last = -(-count // FAN) if end == count else end // FAN
        if count == 1 or last <= first:
            yield from ((level, low + n, d) for n, d in enumerate(digests))
            return
        cut = first * FAN - low, min(last * FAN, end) - low
        yield from ((level, low + n, digests[n]) for n in (*range(cut[0]), *range(cut[1], len(digests))))
        digests = [joined(digests[n:n + FAN]) for n in range(*cut, FAN)]
        low, count, level = first, -(-count // FAN), level + 1


def missing(low: int, end: int, count: int) -> Iterator[tuple[int, int]]:
    """(level, index) of the fewest nodes that complete the proofs of leaves ``low`` to ``end`` - 1."""
    level = 0
    while count > 1:
        first, last = low // FAN, -(-end // FAN)
        yield from ((level, n) for n in range(first * FAN, low))
        yield from ((level, n) for n in range(end, min(last * FAN, count)))
        low, end, count, level = first, last, -(-count // FAN), level + 1


def paths(low: int, digests: list[str], count: int, fetched: dict[tuple[int, int], str]):
    """Root of the tree, and for each leaf from ``low`` on its siblings and its place in the run, level by level.

    Nodes that the leaves do not derive are looked up in ``fetched``; what several leaves
    share is derived once.
    """
    if count == 1:
        return digests[0], [((), ()) for _ in digests]
    end = low + len(digests)
    first, last = low // FAN, -(-end // FAN)
    runs = [
        [digests[n - low] if low <= n < end else fetched[0, n] for n in range(run * FAN, min(run * FAN + FAN, count))]
        for run in range(first, last)]
    above = {(level - 1, n): d for (level, n), d in fetched.items() if level}
    root, upper = paths(first, [joined(run) for run in runs], -(-count // FAN), above)
    own = []
    for n in range(low, end):
        run, place = runs[n // FAN - first], n % FAN
        siblings, places = upper[n // FAN - first]
        own.append((("".join(run[:place] + run[place + 1:]), *siblings), (place, *places)))
    return root, own


def _published(leaves: DataFrame, shares: DataFrame, order: list[str], groups: int) -> DataFrame:
    """The peaks of every part, in the trees of its groups and, from subroots it derives, in the top tree."""
    def derive(leaves: pa.Table, shares: pa.Table) -> pa.Table:
        if not leaves.num_rows:
            return pa.Table.from_pylist([], schema=schema)
        digests = _ascending(leaves, order).column("__leaf").to_pylist()
        shares = shares.sort_by("tree")
        out, roots, at = [], {}, 0
        for tree, n, first, total in zip(*(shares.column(c).to_pylist() for c in ("tree", "n", "first", "total")), strict=True):
            top = height(total)
            for level, index, digest in peaks(first, digests[at:at + n], total):
                if level == top:
                    roots[tree] = digest
                else:
                    out.append((tree, top, level, index, digest))
            at += n
        if roots:  # groups ascend, so those wholly in a part follow each other
            out += [(TOP, height(groups), *node) for node in peaks(min(roots), [roots[t] for t in sorted(roots)], groups)]
        return pa.Table.from_arrays(
            [pa.array(c, f.type) for c, f in zip(zip(*out, strict=True) if out else [[]] * 5, schema, strict=True)], schema=schema)

    schema = arrow_schema(T._parse_datatype_string(_NODES))
    return leaves.groupBy(PART).cogroup(shares.groupBy(PART)).applyInArrow(derive, _NODES)


def _across_borders(published: DataFrame, tallest: int, groups: int) -> list[DataFrame]:
    """The nodes of all levels, published and joined across part borders, as written tables."""
    tables = [published]

    def join_level(nodes: DataFrame, level: int) -> DataFrame:
        run = F.sort_array(F.collect_list(F.struct("index", "hash")))
        return stage(
            nodes.filter((F.col("level") == level) & (F.col("level") < F.col("height")))
            .groupBy("tree", "height", F.floor(F.col("index") / FAN).alias("parent")).agg(run.alias("run"))
            .select("tree", "height", F.lit(level + 1).alias("level"), F.col("parent").alias("index"),
                    F.sha2(F.array_join(F.col("run.hash"), ""), 256).alias("hash")), "merkle-level")

    own = made = published.filter(F.col("tree") != TOP)
    for level in range(tallest):
        made = join_level(own.unionByName(made) if level else own, level)
        tables.append(made)
    top = published.filter(F.col("tree") == TOP)
    for table in tables[1:]:
        top = top.unionByName(table.filter(F.col("level") == F.col("height")).select(
            F.lit(TOP).cast("long").alias("tree"), F.lit(height(groups)).alias("height"), F.lit(0).alias("level"),
            F.col("tree").alias("index"), "hash"))
    top = stage(top, "merkle-level")
    tables.append(top)
    made = top
    for level in range(height(groups)):
        made = join_level(top.unionByName(made) if level else top, level)
        tables.append(made)
    return tables


def _ascending(leaves: pa.Table, order: list[str]) -> pa.Table:
    return leaves.take(pc.sort_indices(
        leaves, sort_keys=[(c, "ascending") for c in [*order, "__leaf"]], null_placement="at_start"))


def with_proofs(
    rows: DataFrame, *, group: str = "source", key: str = "doc_id", leaf: str = "leaf", part_rows: int = PART_ROWS,
) -> DataFrame:
    """``rows`` with subroot, root, proof (sibling digests, one text a level, from the leaf up) and places.

    A level's text holds the other nodes of the run, left to right; places are the node's
    own positions in those runs. A null group or key is one like any other and comes
    first; equal keys of a group ascend by leaf, and repeated rows are leaves of their own.
    No rows: no rows. Columns with the names of the new ones are an error.
    """
    columns = rows.columns
    result = with_fields(rows, columns, subroot=T.StringType(), root=T.StringType(), proof=T.ArrayType(T.StringType()),
                         places=T.ArrayType(T.IntegerType()))
    fields = arrow_schema(result)
    order = ["__group", "__key"]
    helpers = {"__group": F.col(group), "__key": F.col(key), "__leaf": F.col(leaf)}
    placed = in_parts(
        stage(rows.withColumns(helpers), "merkle-leaves"),
        [F.col(c).asc_nulls_first() for c in [*order, "__leaf"]], part_rows=part_rows, name="merkle-parts")
    shares = stage(spans(placed, "__group").drop("__group"), "merkle-spans")
    groups, largest = shares.agg(F.max("tree") + 1, F.max("total")).first()
    if groups is None:
        return rows.sparkSession.createDataFrame([], result)
    published = stage(_published(placed.select(PART, *order, "__leaf"), shares, order, groups), "merkle-peaks")
    nodes, *others = _across_borders(published, height(largest), groups)
    for table in others:
        nodes = nodes.unionByName(table)

    def needed(shares: pa.Table) -> pa.Table:
        part = shares.column(PART)[0].as_py()
        trees = shares.column("tree").to_pylist()
        out = [(part, TOP, *c) for c in missing(min(trees), max(trees) + 1, groups)]
        for tree, n, first, total in zip(trees, *(shares.column(c).to_pylist() for c in ("n", "first", "total")), strict=True):
            out += [(part, tree, *c) for c in missing(first, first + n, total)]
        kinds = (pa.int32(), pa.int64(), pa.int32(), pa.int64())
        return pa.table({
            name: pa.array(c, kind) for name, c, kind in
            zip((PART, "tree", "level", "index"), zip(*out, strict=True) if out else [[]] * 4, kinds, strict=True)})

    wanted = shares.groupBy(PART).applyInArrow(needed, f"{PART} int, tree long, level int, index long")
    fetched = wanted.join(nodes.drop("height"), ["tree", "level", "index"])
    # one group a part: its leaves, its shares of groups and the nodes it fetched
    side = ["tree", "level", "index", "hash", "n", "first", "total"]
    renamed = {c: f"__{c}" for c in side}
    everything = (
        placed.withColumn("__is_leaf", F.lit(True))
        .unionByName(shares.withColumnsRenamed(renamed).withColumn("__is_leaf", F.lit(False)), allowMissingColumns=True)
        .unionByName(fetched.withColumnsRenamed(renamed).withColumn("__is_leaf", F.lit(False)), allowMissingColumns=True))

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(batches)
        leaves = _ascending(table.filter(table.column("__is_leaf")), order)
        rest = table.filter(pc.invert(table.column("__is_leaf"))).select([f"__{c}" for c in side])
        known: dict[int, dict] = {}
        own = []
        for tree, level, index, digest, n, first, total in zip(*(c.to_pylist() for c in rest.columns), strict=True):
            if n is None:
                known.setdefault(tree, {})[level, index] = digest
            else:
                own.append((tree, n, first, total))
        own.sort()
        digests = leaves.column("__leaf").to_pylist()
        at, below, roots = 0, [], []
        for tree, n, first, total in own:
            root, proofs = paths(first, digests[at:at + n], total, known.pop(tree, {}))
            roots.append(root)
            below.append(proofs)
            at += n
        top, above = paths(own[0][0], roots, groups, known.pop(TOP, {}))
        subroots, proofs, places = [], [], []
        for root, proof, leaf_proofs in zip(roots, above, below, strict=True):
            subroots += [root] * len(leaf_proofs)
            proofs += [p[0] + proof[0] for p in leaf_proofs]
            places += [p[1] + proof[1] for p in leaf_proofs]
        kept = leaves.select(columns)
        for begin in range(0, leaves.num_rows, SLICE_ROWS):
            cut = slice(begin, begin + SLICE_ROWS)
            arrays = [c.combine_chunks() for c in kept.slice(begin, SLICE_ROWS).columns]
            arrays += [pa.array(subroots[cut]), pa.array([top] * len(subroots[cut])), pa.array(proofs[cut], fields.field("proof").type),
                       pa.array(places[cut], fields.field("places").type)]
            yield pa.RecordBatch.from_arrays([a.cast(f.type) for a, f in zip(arrays, fields, strict=True)], schema=fields)

    return everything.groupBy(PART).applyInArrow(expand, result)


def folded(leaf: Column, proof: Column, places: Column) -> Column:
    """The root that a leaf's digest and its proof lead to."""
    def step(node: Column, level: Column) -> Column:
        siblings, before = F.get(proof, level), F.get(places, level) * 64
        return F.sha2(F.concat(F.substring(siblings, F.lit(1), before), node, F.substring(siblings, before + 1, F.length(siblings))), 256)

    levels = F.filter(F.sequence(F.lit(0), F.size(proof)), lambda n: n < F.size(proof))
    return F.aggregate(levels, leaf, step)

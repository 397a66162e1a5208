"""Connected components, master tables and the duplicate review.

Edges connect groups of equal names, not rows: a name on a third of all rows is one node.
The initial rule links every name to one node per (first token, letter), which connects
the same names as all pairs would.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from datetime import date

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ledgerlift.functions.similarity import similarity
from ledgerlift.functions.text import strip_space
from ledgerlift.operators.duplicates import (
    NameLinks, company_rows, exact_groups, initial_groups, initial_keyed, name_links, person_rows,
)
from ledgerlift.operators.skew import join_to_groups, list_in_parts, meet
from ledgerlift.schemas import HIRE_GAP_DAYS, NAME_THRESHOLD
from ledgerlift.sources.stages import freed_shuffles, stage, unstage

EDGES_AT_ONCE = 1 << 20


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``edges(a, b)``; the component is its least node.

    Each task first replaces its edges by a spanning forest of them, at most a million at a
    time. Then small-star and large-star steps alternate (Kiveris et al., 2014), which need
    O(log^2 n) rounds: the edges of a larger node meet in one task, which again keeps a
    forest, and children of a node move to its parent by one aggregate and one join; stars
    of hot nodes are salted. A step is written to shared storage, so lineage stays short and
    a lost executor repeats one step; the step before it is removed then, and with it what
    it was shuffled through, so the disk holds the edges of one step and one exchange.
    """
    pair = F.array("a", "b")  # of one type
    current = stage(_forest(edges.select(pair[0].alias("a"), pair[1].alias("b"))), _STEP)
    alone = current.filter(F.col("a").eqNullSafe(F.col("b"))).select(F.col("a").alias("node"), F.col("a").alias("component"))
    for step in range(max_rounds):
        linked = current.filter(F.col("a") != F.col("b"))
        if _settled(linked):
            break
        if not step:
            alone = stage(alone.distinct(), "component-alone")
        star = stage(_small_star(linked), _STEP)
        unstage(current, _STEP)
        current = stage(_large_star(star, star.count()), _STEP)
        unstage(star, _STEP)
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    linked = current.filter(F.col("a") != F.col("b"))
    found = linked.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = linked.select(F.col("b").alias("node"), F.col("b").alias("component"))
    return found.unionByName(roots).unionByName(alone).groupBy("node").agg(F.min("component").alias("component"))


_STEP = "component-edges"


def _settled(edges: DataFrame) -> bool:
    """Whether all is stars: a larger node has one edge and is the smaller end of none."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        edges.select("b", F.lit(0), F.lit(1)).toDF("node", "up", "down"))
    with freed_shuffles(edges.sparkSession):
        return ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).filter(
            "up > 1 OR (up = 1 AND down = 1)").isEmpty()


def _forest(edges: DataFrame, whole: bool = False) -> DataFrame:
    """Fewer edges with the same components: stars (node, least node) in each task, without any exchange.

    A task holds EDGES_AT_ONCE edges and a batch. With ``whole``, edges come sorted by their
    larger node ``a``, and those of one node are not parted. Nodes without another end, or
    with themselves as the other end, come as (node, node).
    """
    limit = EDGES_AT_ONCE

    def stars(edges: pa.Table) -> pa.Table:
        a, b = (edges[c].combine_chunks() for c in "ab")
        proper = pc.fill_null(pc.not_equal(a, b), False)
        odd = pc.invert(proper)
        alone = pc.unique(pa.concat_arrays([a.filter(odd), b.filter(odd)]))
        a, b = a.filter(proper), b.filter(proper)
        coded = pa.concat_arrays([a, b]).dictionary_encode()
        nodes = coded.dictionary
        order = pc.sort_indices(nodes).to_numpy()
        rank = np.empty(len(order), dtype=np.int64)
        rank[order] = np.arange(len(order))
        codes = rank[coded.indices.to_numpy()]
        x, y = codes[: len(a)], codes[len(a):]
        root = np.arange(len(order))
        while len(x):
            np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
            while (root != (upper := root[root])).any():
                root = upper
            x, y = root[x], root[y]
            live = x != y
            x, y = x[live], y[live]
        moved = np.flatnonzero(root != np.arange(len(order)))
        nodes = nodes.take(pa.array(order))
        return pa.table({
            "a": pa.concat_arrays([nodes.take(pa.array(moved)), alone]),
            "b": pa.concat_arrays([nodes.take(pa.array(root[moved])), alone])}, schema=edges.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size < limit:
                continue
            table, rest = pa.Table.from_batches(held), None
            if whole:
                last = pc.equal(table["a"], table["a"][-1])
                table, rest = table.filter(pc.invert(last)), stars(table.filter(last))
                # a node's own edge stays for its next ones; what else its edges joined is told now
                own = pc.equal(rest["a"], batch["a"][-1])
                table, rest = pa.concat_tables([table, rest.filter(pc.invert(own))]), rest.filter(own)
            yield from stars(table).to_batches(max_chunksize=1 << 16)
            held = rest.to_batches() if whole else []
            size = sum(b.num_rows for b in held)
        if held:
            yield from stars(pa.Table.from_batches(held)).to_batches(max_chunksize=1 << 16)

    return edges.mapInArrow(run, edges.schema)


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours move to the least of them, or of what those join in the same task.

    No node is hot here: a forest of a million edges has one edge up from a node.
    """
    return _forest(edges.repartition("a").sortWithinPartitions("a"), whole=True)


def _large_star(edges: DataFrame, known: int) -> DataFrame:
    """Every larger neighbour of a node moves to the least of its neighbourhood."""
    both = edges.select("a", "b", F.lit(0).alias("larger")).unionByName(
        edges.select(F.col("b").alias("a"), F.col("b"), F.lit(1).alias("larger")))
    least = both.groupBy("a").agg(F.min("b").alias("m"), F.sum("larger").alias("n")).filter(F.col("n") > 0)
    moved = join_to_groups(edges.select(F.col("b").alias("a"), F.col("a").alias("b")), least, "a", "n", "b", known)
    return _forest(moved.select(F.col("b").alias("a"), F.col("m").alias("b")))


# --- edges ------------------------------------------------------------------------


def _initial_edges(rows: DataFrame, known: int) -> DataFrame:
    """Names under one (first token, letter) key that has both sides, linked as a star."""
    groups = initial_groups(rows)
    named = initial_keyed(rows).groupBy("hub", "norm").agg(F.min("id").alias("node"))
    # the least node of the key stands for it
    hub = F.least(F.col("short.id"), F.col("full.id"))
    linked = join_to_groups(named.select("hub", "node"), groups.select("hub", "n", hub.alias("b")),
                            "hub", "n", "node", known)
    return linked.select(F.col("node").alias("a"), "b")


def _similar_edges(rows: DataFrame, pairs: DataFrame) -> DataFrame:
    heads = exact_groups(rows).select("norm", "first_id")
    across = pairs.select(F.col("early.norm").alias("norm_a"), F.col("late.norm").alias("norm_b")).filter(
        F.col("norm_a") != F.col("norm_b")).distinct()
    return (
        across.join(heads.select(F.col("norm").alias("norm_a"), F.col("first_id").alias("a")), "norm_a")
        .join(heads.select(F.col("norm").alias("norm_b"), F.col("first_id").alias("b")), "norm_b")
        .select("a", "b")
    )


def _node_clusters(rows: DataFrame, edges: DataFrame, known: int) -> DataFrame:
    """(id, norm, cluster): each row under the least id of its component."""
    heads = exact_groups(rows).select("norm", F.col("first_id").alias("node"), "n")
    found = meet(heads, connected_components(edges), "node", "left").select(
        "norm", F.coalesce("component", "node").alias("cluster"), "n")
    return join_to_groups(rows.select("id", "norm"), found, "norm", "n", "id", known).select("id", "norm", "cluster")


# --- persons ----------------------------------------------------------------------


def person_clusters(hr: DataFrame, threshold: float = NAME_THRESHOLD, metric: str = "ratio",
                    fuzzy: bool = True, links: NameLinks | None = None) -> DataFrame:
    """(id, cluster, cluster_rows) for rows in clusters of two and more."""
    links = links or name_links(person_rows(hr), threshold, metric, fuzzy=fuzzy)
    rows, known = links.rows, links.known
    edges = _initial_edges(rows, known)
    if links.pairs is not None:
        edges = edges.unionByName(_similar_edges(rows, links.pairs))
    members = _node_clusters(rows, edges, known)
    sizes = members.groupBy("cluster").agg(F.count(F.lit(1)).alias("cluster_rows")).filter(
        F.col("cluster_rows") > 1)
    return join_to_groups(members.select("id", "cluster"), sizes, "cluster", "cluster_rows", "id", known).select(
        "id", "cluster", "cluster_rows")


def person_master(hr: DataFrame, clusters: DataFrame) -> DataFrame:
    """Every employee under their own name; cluster_id is NULL when nobody resembles them."""
    return hr.select("employee_id", F.col("name").alias("canonical_name")).join(
        clusters.select(F.col("id").alias("employee_id"), F.col("cluster").alias("cluster_id")),
        "employee_id", "left")


def _review_rows(hr: DataFrame, clusters: DataFrame) -> DataFrame:
    return meet(hr.select(F.col("employee_id").alias("id"), "name", "dept_code", "cost_centre", "hire_date"), clusters, "id")


def recommendation(same_dept, same_cost_centre, gap):
    """Likely only when all three agree; an unknown hire date needs a human."""
    return F.when(same_dept & same_cost_centre & F.coalesce(gap <= HIRE_GAP_DAYS, F.lit(False)),
                  "likely_duplicate").otherwise("needs_human_review")


_PROFILE = ["cluster", "dept_code", "cost_centre"]


def _gap_window() -> WindowSpec:
    # range over day numbers: at most the distinct hire days of one profile in a partition
    return Window.partitionBy(*_PROFILE).orderBy("day")


def review_totals(hr: DataFrame, clusters: DataFrame) -> DataFrame:
    """(cluster, cluster_rows, pairs, likely, review) for clusters of any size, without pairs."""
    days = (
        _review_rows(hr, clusters).filter(F.col("hire_date").isNotNull())
        .withColumn("day", F.datediff("hire_date", F.lit(date(1970, 1, 1))))
        .groupBy(*_PROFILE, "day").agg(F.count(F.lit(1)).alias("rows"))
    )
    later = _gap_window().rangeBetween(1, HIRE_GAP_DAYS)
    known = days.withColumn("later", F.coalesce(F.sum("rows").over(later), F.lit(0)))
    n = F.col("rows").cast("decimal(38,0)")
    likely = known.groupBy("cluster").agg(
        F.sum(n * (F.col("rows") - 1) / 2 + n * F.col("later")).cast("bigint").alias("likely"))
    sizes = clusters.groupBy("cluster").agg(F.count(F.lit(1)).alias("cluster_rows"))
    size = F.col("cluster_rows").cast("decimal(38,0)")
    pairs = (size * (F.col("cluster_rows") - 1) / 2).cast("bigint")
    return (
        sizes.join(likely, "cluster", "left")
        .select("cluster", "cluster_rows", pairs.alias("pairs"),
                F.coalesce("likely", F.lit(0)).alias("likely"))
        .withColumn("review", F.col("pairs") - F.col("likely"))
    )


def review_metrics(totals: DataFrame) -> DataFrame:
    """Clusters, pairs, likely duplicates and pairs that need review."""
    return totals.agg(
        F.count(F.lit(1)).alias("clusters"),
        F.coalesce(F.sum("pairs"), F.lit(0)).alias("pairs"),
        F.coalesce(F.sum("likely"), F.lit(0)).alias("likely"),
        F.coalesce(F.sum("review"), F.lit(0)).alias("review"),
    )


def _day(column: str = "hire_date") -> Column:
    return F.datediff(column, F.lit(date(1970, 1, 1)))


def _near_hires(rows: DataFrame) -> DataFrame:
    """(id, likely_rows, near, settle_gap) of rows with others of their profile hired within 30 days.

    ``near`` is the nearest of them by hire day (id, name, gap): the earliest id of the
    nearest days, or of the own day the last one when the row itself is the earliest.
    ``settle_gap`` is the least gap to a later row, or to an earlier one that is ``free``.
    A hire day meets at most 60 others, so work per profile grows with its hire days.
    """
    dated = rows.filter(F.col("hire_date").isNotNull()).withColumn("day", _day())
    person = F.struct("id", "name")
    days = dated.groupBy(*_PROFILE, "day").agg(
        F.count(F.lit(1)).alias("rows"), F.min(person).alias("least"), F.max(person).alias("last"),
        F.min(F.when(F.col("free"), F.col("id"))).alias("least_free"))
    around = F.collect_list(F.struct("day", "rows", "least", "last", "least_free")).over(
        _gap_window().rangeBetween(-HIRE_GAP_DAYS, HIRE_GAP_DAYS))
    profile = F.sha2(F.to_json(F.struct(*_PROFILE, "day"), {"ignoreNullFields": "false"}), 256)
    facts = days.select(profile.alias("profile"), "rows", "day", around.alias("days")).withColumn(
        "near_rows", F.aggregate("days", F.lit(0).cast("long"), lambda n, d: n + d["rows"])).filter(F.col("near_rows") > 1)
    found = join_to_groups(dated.select("id", profile.alias("profile")), facts, "profile", "rows", "id")
    own = F.col("id")

    def candidate(d: Column) -> Column:
        gap = F.abs(d["day"] - F.col("day"))
        person = F.when((gap > 0) | (d["least"]["id"] != own), d["least"]).when(d["last"]["id"] != own, d["last"])
        return F.struct(gap.alias("gap"), person["id"].alias("id"), person["name"].alias("name"))

    others = F.filter(F.transform("days", candidate), lambda c: c["id"].isNotNull())
    settling = F.filter("days", lambda d: (d["last"]["id"] > own) | (d["least_free"] < own))
    return found.select(
        "id", (F.col("near_rows") - 1).alias("likely_rows"), F.array_min(others).alias("near"),
        F.array_min(F.transform(settling, lambda d: F.abs(d["day"] - F.col("day")))).alias("settle_gap"))


def _name_partners(links: NameLinks, metric: str) -> DataFrame:
    """(raw, n, first_id, second_id, score): the partners by name of the rows of each compared name.

    Rows of a name with several rows have each other: the first two stand for them, with
    score 1. The row of any other name has, of the rows that a rule links to it, the one
    whose name scores best, ties to the smaller id; of the names that one rule links in a
    group, the first row stands for the group.
    """
    rows, known = links.rows, links.known
    firsts = rows.select("raw", "id").withColumn(
        "place", F.row_number().over(Window.partitionBy("raw").orderBy("id"))).filter(F.col("place") <= 2)
    pairs = firsts.groupBy("raw").agg(F.min("id").alias("first_id"), F.max("id").alias("second_id"))
    names = stage(meet(
        links.keys.select("raw", "n", F.col("head.id").alias("id"), "norm", "first", "last", "words"), pairs, "raw"), "compared-names")
    single = names.filter(F.col("n") == 1)
    person = F.struct("id", "raw")
    # the same tokens: the first row of the group, or the second for the first itself
    groups = names.groupBy("norm").agg(F.min(person).alias("p"), F.count(F.lit(1)).alias("names")).filter(F.col("names") > 1)
    joined = join_to_groups(names.select("norm", "raw", "id"), groups, "norm", "names", "raw", known)
    second = joined.filter(F.col("id") != F.col("p.id")).groupBy("norm").agg(F.min(person).alias("q"))
    joined = join_to_groups(single.select("norm", "raw", "id"), meet(groups, second, "norm"), "norm", "names", "raw", known)
    found = joined.select("raw", "id", F.when(F.col("id") != F.col("p.id"), F.col("p")).otherwise(F.col("q")).alias("p"))
    # an initial: the first row of the other side
    keyed = initial_keyed(single).select("raw", "id", "hub", "is_short")
    other = F.when(F.col("is_short"), F.col("full")).otherwise(F.col("short"))
    sides = join_to_groups(keyed, initial_groups(rows), "hub", "n", "raw", known)
    found = found.unionByName(sides.select("raw", "id", F.struct(other["id"].alias("id"), F.lower(other["shown"]).alias("raw")).alias("p")))
    if links.pairs is not None:
        across = links.pairs.filter(F.col("early.norm") != F.col("late.norm"))

        def seen(own: str, other: str) -> DataFrame:
            head = F.struct(F.col(f"{other}.head.id").alias("id"), F.col(f"{other}.raw").alias("raw"))
            return across.select(F.col(f"{own}.raw").alias("raw"), head.alias("p"))

        found = found.unionByName(
            meet(single.select("raw", "id"), seen("early", "late").unionByName(seen("late", "early")), "raw"))
    first = F.col("id") < F.col("p.id")
    score = similarity(F.when(first, F.col("raw")).otherwise(F.col("p.raw")), F.when(first, F.col("p.raw")).otherwise(F.col("raw")), metric)
    best = found.distinct().withColumn("score", score).groupBy("raw").agg(
        F.min(F.struct((-F.col("score")).alias("least"), F.col("p.id").alias("id"))).alias("b"))
    return names.filter(F.col("n") > 1).select("raw", "n", "first_id", "second_id", F.lit(1.0).alias("score")).unionByName(
        best.select("raw", F.lit(1).cast("long").alias("n"), F.col("b.id").alias("first_id"), F.col("b.id").alias("second_id"),
                    (-F.col("b.least")).alias("score")))


def person_review(hr: DataFrame, clusters: DataFrame, links: NameLinks, metric: str = "ratio",
                  with_issue: DataFrame | None = None) -> DataFrame:
    """One row per record of a cluster of any size, for review by people.

    (employee_id, cluster, cluster_rows, name, partner_id, partner_name, similarity_score,
    same_dept_code, same_cost_centre, hire_date_delta_days, likely_rows, recommendation,
    named_partner_id, named_score, settle_gap). The partner is the record of the same
    department and cost centre hired nearest within 30 days, a likely duplicate; without
    one it is the best-scoring record by name (see ``_name_partners``), which
    ``named_partner_id`` names in any case. ``likely_rows`` counts a record's likely
    duplicates. ``settle_gap`` is the least gap of the pairs that settle the record's
    issue: a pair settles the issue of its first row, or of its second if the first has
    none (``with_issue(row_identifier)`` lists rows with issues). Output and work grow
    with the records, never with their pairs.
    """
    rows = _review_rows(hr, clusters)
    if with_issue is None:
        rows = rows.withColumn("free", F.lit(True))
    else:
        marks = with_issue.select(F.col("row_identifier").alias("id"), F.lit(False).alias("free")).distinct()
        rows = meet(rows, marks, "id", "left").withColumn("free", F.coalesce("free", F.lit(True)))
    rows = stage(rows.withColumn("raw", F.lower(strip_space(F.col("name")))), "review-rows")
    partners = _name_partners(links, metric)
    details = hr.select(F.col("employee_id").alias("pid"), F.struct(
        F.col("employee_id").alias("id"), "name", "dept_code", "cost_centre", "hire_date").alias("person"))
    # a partner's facts are fetched once per name, not once per row
    ids = partners.select(F.explode(F.array("first_id", "second_id")).alias("pid")).distinct()
    facts = stage(meet(details, ids, "pid"), "partner-facts")
    first = meet(partners, facts.select(F.col("pid").alias("first_id"), F.col("person").alias("one")), "first_id")
    partners = stage(
        meet(first, facts.select(F.col("pid").alias("second_id"), F.col("person").alias("two")), "second_id")
        .select("raw", "n", "one", "two", "score"), "partners")
    named = join_to_groups(rows, partners, "raw", "n", "id", links.known).withColumn(
        "named", F.when(F.col("one.id") != F.col("id"), F.col("one")).otherwise(F.col("two"))).drop("one", "two", "n")
    both = meet(named, _near_hires(rows), "id", "left")
    likely = F.col("near").isNotNull()
    partner = F.when(likely, F.col("near.name")).otherwise(F.col("named.name"))
    pid = F.when(likely, F.col("near.id")).otherwise(F.col("named.id"))
    raw = F.lower(strip_space(partner))
    first = F.col("id") < pid
    score = similarity(F.when(first, F.col("raw")).otherwise(raw), F.when(first, raw).otherwise(F.col("raw")), metric)
    same_dept = likely | F.col("dept_code").eqNullSafe(F.col("named.dept_code"))
    same_centre = likely | F.col("cost_centre").eqNullSafe(F.col("named.cost_centre"))
    gap = F.when(likely, F.col("near.gap")).otherwise(F.abs(F.datediff("hire_date", F.col("named.hire_date"))))
    return both.select(
        F.col("id").alias("employee_id"), "cluster", "cluster_rows", "name", pid.alias("partner_id"), partner.alias("partner_name"),
        score.alias("similarity_score"), same_dept.alias("same_dept_code"), same_centre.alias("same_cost_centre"),
        gap.alias("hire_date_delta_days"), F.coalesce("likely_rows", F.lit(0)).alias("likely_rows"),
        recommendation(same_dept, same_centre, gap).alias("recommendation"),
        F.col("named.id").alias("named_partner_id"), F.col("score").alias("named_score"), "settle_gap")


# --- companies --------------------------------------------------------------------


def vendor_clusters(procurement: DataFrame, threshold: float = NAME_THRESHOLD, metric: str = "ratio",
                    fuzzy: bool = True, links: NameLinks | None = None, orders: DataFrame | None = None) -> DataFrame:
    """(vendor_id, vendor_name, orders, cluster): one row per vendor id and name.

    Rows of one vendor id belong together whatever their names. Names without a usable
    token stay alone with their vendor id. ``orders`` are the written ``vendor_orders`` of
    the same table, if the caller has them; the orders are not read again then.
    """
    # the one pass over the orders
    known_as = F.col("vendor_id").isNotNull() & F.col("vendor_name").isNotNull()
    if orders is not None:
        named = orders.filter(known_as).select("vendor_id", "vendor_name", "name_orders")
    else:
        named = stage(procurement.filter(known_as).groupBy("vendor_id", "vendor_name").agg(
            F.count(F.lit(1)).alias("name_orders")), "vendor-names")
    links = links or name_links(company_rows(named), threshold, metric, blocked=False, fuzzy=fuzzy)
    rows, known = links.rows, links.known
    heads = exact_groups(rows).select("norm", F.col("first_id").alias("b"), "n")
    # a vendor joins the group of each of its names
    edges = join_to_groups(rows.select("id", "norm"), heads, "norm", "n", "id", known).select(
        F.col("id").alias("a"), "b").distinct()
    if links.pairs is not None:
        edges = edges.unionByName(_similar_edges(rows, links.pairs))
    components = connected_components(edges)
    orders = named.groupBy("vendor_id").agg(F.sum("name_orders").alias("orders"))
    return (
        named.join(orders, "vendor_id")
        .join(components.withColumnRenamed("node", "vendor_id"), "vendor_id", "left")
        .select("vendor_id", "vendor_name", "orders", F.coalesce("component", "vendor_id").alias("cluster"))
    )


def canonical_names(clusters: DataFrame) -> DataFrame:
    """Per cluster: name of the vendor with most orders, then the longest, then the first by text."""
    rank = F.struct(-F.col("orders"), -F.length("vendor_name"), F.col("vendor_name"))
    return clusters.groupBy("cluster").agg(
        F.min_by("vendor_name", rank).alias("canonical_vendor_name"),
        F.count_distinct("vendor_id").alias("members"),
    )


def vendor_master(clusters: DataFrame) -> DataFrame:
    """One row per vendor id under the canonical name of its cluster."""
    ids = clusters.select("vendor_id", "cluster").distinct()
    return join_to_groups(ids, canonical_names(clusters), "cluster", "members", "vendor_id").select(
        "vendor_id", "canonical_vendor_name")


def consolidation(clusters: DataFrame) -> DataFrame:
    """Consolidated vendors against raw (id, name) variants."""
    return clusters.agg(
        F.count_distinct("cluster").alias("vendors"), F.count(F.lit(1)).alias("raw_variants"))


def multi_member_clusters(clusters: DataFrame) -> DataFrame:
    """(cluster, members, least_id, last_id) of clusters with more than one vendor."""
    return clusters.groupBy("cluster").agg(
        F.count_distinct("vendor_id").alias("members"), F.min("vendor_id").alias("least_id"),
        F.max("vendor_id").alias("last_id")).filter(F.col("members") > 1)


def member_list(clusters: DataFrame) -> DataFrame:
    """(cluster, members, part, member_ids): the vendors of each cluster as text, whole."""
    return list_in_parts(
        clusters.select("vendor_id", "cluster").distinct(), multi_member_clusters(clusters),
        "cluster", "members", "vendor_id", "vendor_id", "member_ids")


def member_notes(clusters: DataFrame) -> DataFrame:
    """(cluster, members, member_ids): one short line per cluster, of one form at any size."""
    return multi_member_clusters(clusters).select("cluster", "members", F.concat(
        F.col("least_id"), F.lit(" to "), F.col("last_id"), F.lit(" ("), F.col("members").cast("string"),
        F.lit(" vendors)")).alias("member_ids"))

"""Sharding by a k-d tree over metadata, with DataFrame functions only.

The rows' metadata span a box. The box is cut at the weighted median of its widest
dimension, both halves are cut again, and so on until every leaf holds the target bytes.
Medians of all boxes of a level are found together: a histogram of bytes brackets each
median, and a finer histogram of the bracket follows until the cut is exact enough. What
reaches the driver is a histogram, bounded by boxes times bins.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlift.llm.batches import with_fields

BINS = 2048
NEAR = 0.0005  # a cut may miss its share by this part of the box
GROUP_NEAR = 0.005  # and by this part, if that keeps a group together


@dataclass
class Box:
    """A node of the tree; a leaf has no cut."""

    leaves: int
    cut: tuple[str, list[float]] | None = None  # dimension; least (value, group, key) of the upper side
    below: list["Box"] = field(default_factory=list)


def _upper(cut: tuple[str, list[float]]) -> Column:
    """Whether a row lies on the upper side: (value, group, key) from the cut on, in that order."""
    columns = [cut[0], "__group", "__key"]
    at_least = None
    for name, value in reversed(list(zip(columns, cut[1], strict=False))):
        here = F.col(name)
        at_least = here >= value if at_least is None else (here > value) | ((here == value) & at_least)
    return at_least


def _number(box: Box, of: dict[int, int]) -> Column:
    """The number of the row's leaf, by the tree's cuts."""
    if box.cut is None:
        return F.lit(of[id(box)])
    return F.when(_upper(box.cut), _number(box.below[1], of)).otherwise(_number(box.below[0], of))


def _leaves(box: Box) -> list[Box]:
    return [box] if box.cut is None else [leaf for b in box.below for leaf in _leaves(b)]


def _cut_level(rows: DataFrame, root: Box, dimensions: list[str]) -> bool:
    """Cut every leaf that still has to be cut; whether there was any."""
    leaves = _leaves(root)
    numbered = rows.withColumn("__box", _number(root, {id(b): n for n, b in enumerate(leaves)}))
    extents = {
        r["__box"]: r for r in numbered.groupBy("__box").agg(
            F.sum("__bytes").alias("bytes"),
            *[f(d).alias(f"{k}{n}") for n, d in enumerate(dimensions) for k, f in (("lo", F.min), ("hi", F.max))],
        ).collect()}
    scale = {
        n: max((e[f"hi{n}"] for e in extents.values()), default=0) - min((e[f"lo{n}"] for e in extents.values()), default=0)
        for n in range(len(dimensions))}
    open_cuts = {}
    for number, box in enumerate(leaves):
        if box.leaves < 2:
            continue
        e = extents.get(number)
        if e is None:  # no rows: all leaves but the first stay empty
            box.leaves = 1
            continue
        wide = max(range(len(dimensions)), key=lambda n: (e[f"hi{n}"] - e[f"lo{n}"]) / scale[n] if scale[n] else 0.0)
        wanted = e["bytes"] * (box.leaves // 2) / box.leaves
        open_cuts[number] = {
            "dimension": dimensions[wide], "fixed": [], "lo": e[f"lo{wide}"], "hi": e[f"hi{wide}"],
            "before": 0.0, "wanted": wanted, "bytes": e["bytes"]}
    found = bool(open_cuts)
    while open_cuts:
        _refine(numbered, leaves, open_cuts)
    return found


def _refine(numbered: DataFrame, leaves: list[Box], open_cuts: dict[int, dict]) -> None:
    """One histogram of every open bracket; brackets shrink, and cuts that are near enough are made."""
    bin_of, low_of = F.lit(None).cast("int"), None
    for number, c in open_cuts.items():
        columns = [c["dimension"], "__group", "__key"]
        value = F.col(columns[len(c["fixed"])])
        inside = (F.col("__box") == number) & (value >= c["lo"]) & (value <= c["hi"])
        for name, fixed in zip(columns, c["fixed"], strict=False):
            inside &= F.col(name) == fixed
        width = (c["hi"] - c["lo"]) / BINS
        own = F.least(F.floor((value - c["lo"]) / width), F.lit(BINS - 1)) if width > 0 else F.lit(0)
        bin_of = F.when(inside, own.cast("int")).otherwise(bin_of)
        low_of = F.when(inside, value) if low_of is None else low_of.when(inside, value)
    counted = (
        numbered.withColumns({"__bin": bin_of, "__value": low_of}).filter("__bin is not null")
        .groupBy("__box", "__bin")
        .agg(F.sum("__bytes").alias("bytes"), F.min("__value").alias("lo"), F.max("__value").alias("hi")).collect())
    bins: dict[int, list] = {}
    for r in counted:
        bins.setdefault(r["__box"], []).append(r)
    for number, c in list(open_cuts.items()):
        before, best = c["before"], None
        own = sorted(bins[number], key=lambda r: r["__bin"])
        for n, r in enumerate(own):
            if before + r["bytes"] >= c["wanted"] or n == len(own) - 1:
                break
            before += r["bytes"]
        # edges beside the bin that holds the median: its least value, or that of the next bin
        edges = []
        if n > 0 or c["before"] == 0 and not c["fixed"] and before > 0:
            edges.append((abs(before - c["wanted"]), r["lo"]))
        if n + 1 < len(own):
            edges.append((abs(before + r["bytes"] - c["wanted"]), own[n + 1]["lo"]))
        best = min(edges, default=None)
        single = r["lo"] == r["hi"]
        near = NEAR if not single or len(c["fixed"]) != 1 else GROUP_NEAR
        if best and (best[0] <= near * c["bytes"] or single and len(c["fixed"]) == 2):
            _make(leaves[number], c, best[1])
        elif single and len(c["fixed"]) == 2:
            _make(leaves[number], c, r["lo"])  # equal in all that tells rows apart
        elif single:
            c["fixed"] = [*c["fixed"], r["lo"]]
            c |= {"lo": 0.0, "hi": float(1 << 52), "before": before}
            continue
        else:
            c |= {"lo": r["lo"], "hi": r["hi"], "before": before}
            continue
        del open_cuts[number]


def _make(box: Box, c: dict, value: float) -> None:
    low = box.leaves // 2
    box.cut = (c["dimension"], [*c["fixed"], value])
    box.below = [Box(low), Box(box.leaves - low)]


def kd_shards(
    rows: DataFrame, *, size: str, dimensions: list[str], group: str, key: str, shards: int | None = None,
    target_bytes: int | None = None, name: str = "shard",
) -> DataFrame:
    """``rows`` with an int shard from 0; shards hold nearly equal sums of ``size``.

    Give the number of shards, or ``target_bytes`` to derive it. ``rows`` should be a
    written table: it is aggregated a few times a level. ``dimensions`` are numeric; null
    counts as 0. Rows equal in a dimension go by a hash of ``group``, so equal groups stay
    together wherever that misses the median by no more than 0.5 % of a box; larger
    groups are split by a hash of ``key``. Rows that agree in all of that stay together.
    The tree is part of the plan, so it is meant for up to a few thousand shards. A column
    ``name`` is an error.
    """
    with_fields(rows, rows.columns, **{name: T.IntegerType()})
    clear = lambda c: F.shiftrightunsigned(F.xxhash64(c), 12).cast("double")  # noqa: E731  52 bits are exact
    helpers = {f"__d{n}": F.coalesce(F.col(d).cast("double"), F.lit(0.0)) for n, d in enumerate(dimensions)}
    table = rows.withColumns(
        {"__bytes": F.coalesce(F.col(size), F.lit(0)).cast("double"), "__group": clear(group), "__key": clear(key), **helpers})
    if shards is None:
        total = rows.agg(F.sum(size)).first()[0] or 0
        shards = max(1, -(-int(total) // target_bytes))
    root = Box(shards)
    while _cut_level(table, root, list(helpers)):
        pass
    first, numbers = 0, {}
    for leaf in _leaves(root):
        numbers[id(leaf)] = first
        first += 1
    return table.withColumn(name, _number(root, numbers)).drop("__bytes", "__group", "__key", *helpers)


def with_slots(rows: DataFrame, *, shard: str, key: str, tie: str, name: str = "slot") -> DataFrame:
    """``rows`` with a long that numbers the rows of each shard from 0 without gaps.

    Rows are numbered inside (shard, block of keys), and each block starts after the rows
    of the blocks before it, so no window holds a whole shard. The table of block sizes is
    bounded by shards times blocks, and blocks follow the shuffle parallelism. A column
    ``name`` is an error.
    """
    with_fields(rows, rows.columns, **{name: T.LongType()})
    blocks = 4 * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.withColumn("__block", F.pmod(F.xxhash64(key, tie), F.lit(blocks)))
    earlier = Window.partitionBy(shard).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    sizes = dealt.groupBy(shard, "__block").agg(F.count(F.lit(1)).alias("__rows"))
    starts = sizes.select(shard, "__block", F.coalesce(F.sum("__rows").over(earlier), F.lit(0)).alias("__start"))
    inside = Window.partitionBy(shard, "__block").orderBy(key, tie)
    numbered = dealt.withColumn("__place", F.row_number().over(inside))
    return numbered.join(F.broadcast(starts), [shard, "__block"]).withColumn(
        name, F.col("__start") + F.col("__place") - 1).drop("__block", "__start", "__place")

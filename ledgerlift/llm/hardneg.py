"""Hard negatives by angular triangle filtering: rows of another label that score just below a positive.

Vectors become integers, so scores are exact. Every vector stores its angles to reference
directions. By the triangle inequality on the sphere, the angles of two vectors to one
direction bound the angle between them, hence its cosine and, times both norms, their
score; bounds are widened beyond any rounding. Rows lie in regions (nearest direction and
range of the angle to it) and, inside a task, in windows of like label and angle. An
anchor asks for rows of its label that beat its best ones so far, then for rows of other
labels inside the score ranges of its positives: it meets only the regions, and there the
windows, whose bounds overlap the range, and only those are scored.

Equal vectors of a label are one entry with their smallest ids. Regions and askers are
dealt in blocks of bounded size, so a region of any size is spread over many tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlift.sources.stages import stage

PAD = 2e-6  # radians; far above the rounding of a stored angle
LEAST, MOST = -(1 << 62), 1 << 62


@dataclass
class Settings:
    sample: int = 4096  # entries that directions and ranges are fitted on; results do not depend on them
    directions: int = 16
    ranges: int = 8
    window: int = 64
    block: int = 8192
    askers: int = 2048
    seed: int = 5


def integer_vectors(rows: DataFrame, *, key: str, vector: str, label: Column, scale: int = 256) -> DataFrame:
    """(id, label, vector as ints): floor(scale * component), without null ids, labels, vectors or unusable components.

    Vectors must have one size; if they do not, the most frequent size stays, ties to the
    smaller. Vectors of length 2**31 or more after scaling are left out, as their scores
    may not fit a long.
    """
    numbers = F.col(vector).cast("array<double>")
    fit = rows.select(F.col(key).cast("long").alias("id"), label.cast("long").alias("label"), numbers.alias("vector")).filter(
        F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull()
        & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    scaled = fit.withColumn("vector", F.transform("vector", lambda x: F.floor(x * scale).cast("double")))
    square = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x)
    short = scaled.filter(square < 2.0 ** 62).withColumn("vector", F.col("vector").cast("array<int>"))
    sizes = short.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    return short.filter(F.size("vector") == (sizes[0]["n"] if sizes else 0))


def entries_of(rows: DataFrame, most: int) -> DataFrame:
    """(mark, label, vector, ids, first): each different (label, vector) with its ``most`` smallest ids.

    The limit holds before the shuffle too, so a hot vector sends ``most`` ids a task.
    """
    order = Window.partitionBy("label", "vector").orderBy("id")
    few = rows.withColumn("__rank", F.dense_rank().over(order)).filter(F.col("__rank") <= most)
    ids = few.groupBy("label", "vector").agg(F.sort_array(F.collect_set("id")).alias("ids"))
    return stage(ids.select(
        F.monotonically_increasing_id().alias("mark"), "label", "vector", "ids", F.get("ids", 0).alias("first")), "hardneg-entries")


def directions_of(sample: np.ndarray, count: int, seed: int) -> np.ndarray:
    """Unit vectors of the sample, each as far in angle from those before as can be."""
    norms = np.sqrt((sample ** 2).sum(axis=1))
    units = sample[norms > 0] / norms[norms > 0][:, None]
    if not len(units):
        return np.zeros((1, sample.shape[1]))
    chosen = [int(np.random.default_rng(seed).integers(len(units)))]
    nearest = units @ units[chosen[0]]
    while len(chosen) < min(count, len(units)):
        chosen.append(int(nearest.argmin()))
        nearest = np.maximum(nearest, units @ units[chosen[-1]])
    return units[chosen]


def angles_to(directions: np.ndarray, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Norms and angles to every direction; a zero vector stands at a right angle."""
    norms = np.sqrt((vectors ** 2).sum(axis=1))
    cosines = vectors @ directions.T / np.where(norms > 0, norms, 1)[:, None]
    return norms, np.arccos(np.clip(cosines, -1, 1))


def score_bounds(norms: np.ndarray, angles: np.ndarray, low: np.ndarray, high: np.ndarray, short: np.ndarray,
                 long: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest score of each vector (norm, angles) with the rows of each window.

    A window knows the ranges of its rows' angles and norms. Rounding cannot leave the bounds.
    """
    shape = len(norms), len(low)
    near, far = np.zeros(shape), np.full(shape, np.pi)
    for k in range(angles.shape[1]):
        own = angles[:, k, None]
        np.maximum(near, np.maximum(low[:, k] - own, own - high[:, k]), out=near)
        np.minimum(far, np.minimum(own + high[:, k], 2 * np.pi - own - low[:, k]), out=far)
    closest, widest = np.cos(np.clip(near - PAD, 0, np.pi)), np.cos(np.clip(far + PAD, 0, np.pi))
    up = closest * np.where(closest >= 0, long, short)
    down = widest * np.where(widest >= 0, short, long)
    slack = 1 + 1e-9 * norms[:, None] * long
    return norms[:, None] * down - slack, norms[:, None] * up + slack


def _products(left: np.ndarray, right: np.ndarray, largest: float) -> np.ndarray:
    """Exact integer products; by floating point while no partial sum can leave its exact range."""
    if largest < 2.0 ** 52:
        return (left @ right.T).astype(np.int64)
    return left.astype(np.int64) @ right.astype(np.int64).T


class _Side:
    """Columns of one side of a tile as arrays."""

    def __init__(self, table: pa.Table):
        bits = lambda name, kind: np.frombuffer(b"".join(table.column(name).to_pylist()), kind).reshape(table.num_rows, -1)
        self.mark, self.label = table.column("mark").to_numpy(), table.column("label").to_numpy()
        self.vector, self.angles = bits("vector", np.int32).astype(np.float64), bits("angles", np.float32).astype(np.float64)
        self.norm = table.column("norm").to_numpy()


def _windows(label: np.ndarray, most: int) -> np.ndarray:
    """Starts of runs of one label and at most ``most`` rows, and the end."""
    edges = np.flatnonzero(np.diff(label, prepend=label[0] - 1))
    ends = np.append(edges[1:], len(label))
    return np.concatenate([*(np.arange(a, b, most) for a, b in zip(edges, ends, strict=True)), [len(label)]])


def tile(stored: pa.Table, asked: pa.Table, same: bool, top: int, window: int) -> tuple[list, int]:
    """[(asker's mark, slot, mark, score)]: for each asker and score range, the ``top`` best stored entries; and scores computed.

    ``same`` asks for entries of the asker's label, otherwise of others. Ties go to the
    smaller first id.
    """
    first = stored.column("first").to_numpy()
    rows, asks = _Side(stored), _Side(asked)
    region = rows.angles[:, rows.angles.mean(axis=0).argmin()]
    order = np.lexsort((first, region, rows.label))
    for name in ("mark", "label", "vector", "angles", "norm"):
        setattr(rows, name, getattr(rows, name)[order])
    first = first[order]
    cuts = _windows(rows.label, window)
    starts = cuts[:-1]
    low, high = np.minimum.reduceat(rows.angles, starts), np.maximum.reduceat(rows.angles, starts)
    short, long = np.minimum.reduceat(rows.norm, starts), np.maximum.reduceat(rows.norm, starts)
    lows, highs = asked.column("lows").to_pylist(), asked.column("highs").to_pylist()
    found, scored = [], 0
    for at in range(0, len(asks.mark), 256):
        part = slice(at, at + 256)
        down, up = score_bounds(asks.norm[part], asks.angles[part], low, high, short, long)
        least = np.array([min(x, default=MOST) for x in lows[part]], np.int64)
        most = np.array([max(x, default=LEAST) for x in highs[part]], np.int64)
        kin = asks.label[part, None] == rows.label[starts]
        need = (kin == same) & (up >= least[:, None]) & (down <= most[:, None])
        who, where, what = [], [], []
        for w in np.flatnonzero(need.any(axis=0)):
            own, span = np.flatnonzero(need[:, w]), slice(cuts[w], cuts[w + 1])
            scores = _products(asks.vector[part][own], rows.vector[span], asks.norm[part][own].max() * long[w])
            scored += scores.size
            a, b = np.nonzero((scores >= least[own, None]) & (scores <= most[own, None]))
            who.append(own[a])
            where.append(b + cuts[w])
            what.append(scores[a, b])
        if not who:
            continue
        who, where, what = map(np.concatenate, (who, where, what))
        best = np.lexsort((first[where], -what, who))
        who, where, what = who[best], where[best], what[best]
        ends = np.searchsorted(who, np.arange(len(least) + 1))
        for n in np.unique(who).tolist():
            a, b = ends[n], ends[n + 1]
            for slot, (lo, hi) in enumerate(zip(lows[at + n], highs[at + n], strict=True)):
                begin = a + np.searchsorted(-what[a:b], -hi)
                for i in range(begin, min(begin + top, b)):
                    if what[i] < lo:
                        break
                    found.append((int(asks.mark[at + n]), slot, int(rows.mark[where[i]]), int(what[i])))
    return found, scored


_STORED = "region int, mark long, first long, label long, vector binary, norm double, angles binary"


def _with_angles(entries: DataFrame, fitted) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        directions, edges = fitted.value
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                vectors = part.column("vector").flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, -1)
                norms, angles = angles_to(directions, vectors.astype(np.float64))
                cell = angles.argmin(axis=1)
                place = (angles[np.arange(len(cell)), cell][:, None] >= edges[cell]).sum(axis=1)
                bits = [[v.tobytes() for v in x] for x in (vectors.astype(np.int32), angles.astype(np.float32))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cell * (edges.shape[1] + 1) + place, pa.int32()), part.column("mark"), part.column("first"),
                     part.column("label"), pa.array(bits[0], pa.binary()), pa.array(norms), pa.array(bits[1], pa.binary())],
                    ["region", "mark", "first", "label", "vector", "norm", "angles"])

    return entries.select("mark", "first", "label", "vector").mapInArrow(run, _STORED)


def _region_ranges(stored: DataFrame) -> dict[str, np.ndarray]:
    """Ranges of angles and norms of every region; as many rows reach the driver as there are regions and directions."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            region, norm = (batch.column(c).to_numpy() for c in ("region", "norm"))
            if not len(region):
                continue
            angles = np.frombuffer(b"".join(batch.column("angles").to_pylist()), np.float32).reshape(len(region), -1)
            order = np.argsort(region, kind="stable")
            starts = np.flatnonzero(np.diff(region[order], prepend=-1))
            k = angles.shape[1]
            ends = [f.reduceat(x[order], starts) for f in (np.minimum, np.maximum) for x in (angles, norm)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(region[order][starts], k)), pa.array(np.tile(np.arange(k, dtype=np.int32), len(starts))),
                 pa.array(ends[0].ravel().astype(np.float64)), pa.array(ends[2].ravel().astype(np.float64)),
                 pa.array(np.repeat(ends[1], k)), pa.array(np.repeat(ends[3], k))],
                ["region", "k", "low", "high", "short", "long"])

    ranges = stored.select("region", "norm", "angles").mapInArrow(
        run, "region int, k int, low double, high double, short double, long double")
    rows = ranges.groupBy("region", "k").agg(
        F.min("low").alias("low"), F.max("high").alias("high"), F.min("short").alias("short"),
        F.max("long").alias("long")).orderBy("region", "k").toArrow()
    regions = np.unique(rows.column("region").to_numpy())
    shaped = {c: rows.column(c).to_numpy().reshape(len(regions), -1) for c in ("low", "high", "short", "long")}
    return {"region": regions, "low": shaped["low"], "high": shaped["high"], "short": shaped["short"][:, 0], "long": shaped["long"][:, 0]}


_ASKED = "region int, mark long, label long, vector binary, norm double, angles binary, lows array<long>, highs array<long>"


def _asking(asks: DataFrame, ranges, own_region: bool | None) -> DataFrame:
    """Each asker once for every region whose score bounds overlap one of its ranges.

    ``own_region``: only the region that it lies in, all but that, or (None) all.
    """
    kind = pa.schema([
        ("region", pa.int32()), ("mark", pa.int64()), ("label", pa.int64()), ("vector", pa.binary()), ("norm", pa.float64()),
        ("angles", pa.binary()), ("lows", pa.list_(pa.int64())), ("highs", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = ranges.value
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                angles = np.frombuffer(b"".join(part.column("angles").to_pylist()), np.float32).reshape(part.num_rows, -1)
                down, up = score_bounds(
                    part.column("norm").to_numpy(), angles.astype(np.float64), known["low"], known["high"], known["short"], known["long"])
                need = np.zeros(up.shape, bool)
                for n, (lows, highs) in enumerate(zip(part.column("lows").to_pylist(), part.column("highs").to_pylist(), strict=True)):
                    for lo, hi in zip(lows, highs, strict=True):
                        need[n] |= (up[n] >= lo) & (down[n] <= hi)
                if own_region is not None:
                    need &= (part.column("region").to_numpy()[:, None] == known["region"]) == own_region
                row, place = np.nonzero(need)
                arrays = [pa.array(known["region"][place], pa.int32())]
                arrays += [part.column(c).take(pa.array(row)) for c in kind.names[1:]]
                yield pa.RecordBatch.from_arrays([a.cast(f.type) for a, f in zip(arrays, kind, strict=True)], schema=kind)

    return asks.select(*kind.names).mapInArrow(run, _ASKED)


def _best(stored: DataFrame, asked: DataFrame, same: bool, top: int, settings: Settings) -> DataFrame:
    """(asker, slot, mark, score): the ``top`` best of every block that an asker meets."""
    window = settings.window

    def blocks(rows: DataFrame, size: int, name: str) -> DataFrame:
        return rows.groupBy("region").agg(F.ceil(F.count(F.lit(1)) / size).cast("int").alias(name))

    def dealt(rows: DataFrame, own: str, other: str) -> DataFrame:
        return rows.join(F.broadcast(both), "region").select(
            *rows.columns, F.pmod(F.xxhash64("mark"), F.col(own)).cast("int").alias(f"{own}_at"),
            F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias(f"{other}_at"))

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        rows = tile(left, right, same, top, window)[0] if left.num_rows and right.num_rows else []
        columns = zip(*rows, strict=True) if rows else [[]] * 4
        return pa.table({n: pa.array(c, k) for n, c, k in zip(
            ("asker", "slot", "mark", "score"), columns, (pa.int64(), pa.int32(), pa.int64(), pa.int64()), strict=True)})

    # a row a region, of which there are directions times ranges at most
    both = blocks(stored, settings.block, "p").join(blocks(asked, settings.askers, "q"), "region")
    at = ["region", "p_at", "q_at"]
    return dealt(stored, "p", "q").groupBy(*at).cogroup(dealt(asked, "q", "p").groupBy(*at)).applyInArrow(
        compare, "asker long, slot int, mark long, score long")


def mine(
    rows: DataFrame, *, key: str = "vec_id", vector: str = "embedding", label: Column, anchor: Column, positives: int = 5,
    negatives: int = 5, settings: Settings | None = None,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of every anchor and positive.

    An anchor's positives are the ``positives`` best other rows of its label. Its negatives
    for one are the ``negatives`` best rows of other labels that score at most as much as
    it and at least 80 % of that; scores are inner products of ``integer_vectors``, ties
    go to the smaller id. ``anchor`` is told from the id. Rows that ``integer_vectors``
    leaves out take no part. Repeats of an id with its label and vector count once; an id
    with several labels or vectors is a row with each, and never its own positive. All
    are returned where there are fewer; positives that score below zero have no negatives.
    """
    settings = settings or Settings()
    spark = rows.sparkSession
    known = stage(integer_vectors(rows, key=key, vector=vector, label=label), "hardneg-rows")
    entries = entries_of(known, positives + 1)
    sample = entries.orderBy(F.xxhash64("mark"), "mark").limit(settings.sample).select("vector").toArrow()
    empty = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if not sample.num_rows:
        return spark.createDataFrame([], empty)
    points = np.array(sample.column(0).to_pylist(), np.float64).reshape(sample.num_rows, -1)
    directions = directions_of(points, settings.directions, settings.seed)
    _, angles = angles_to(directions, points)
    cell, nearest = angles.argmin(axis=1), angles.min(axis=1)
    steps = np.arange(1, settings.ranges) / settings.ranges
    edges = np.array([np.quantile(nearest[cell == k], steps) if (cell == k).any() else np.pi * steps for k in range(len(directions))])
    stored = stage(_with_angles(entries, spark.sparkContext.broadcast((directions, edges))), "hardneg-stored")
    ranges = spark.sparkContext.broadcast(_region_ranges(stored))

    anchors = stage(
        known.filter(anchor).distinct().join(entries.select("mark", "label", "vector"), ["label", "vector"])
        .select(F.col("id").alias("anchor_id"), F.col("mark").alias("asker")), "hardneg-anchors")
    asks = stage(stored.join(anchors.select(F.col("asker").alias("mark")).distinct(), "mark", "left_semi"), "hardneg-asks")
    whole = lambda least: {"lows": F.array(least), "highs": F.array(F.lit(MOST))}
    most = positives + 1

    def merged(found: DataFrame, top: int) -> DataFrame:
        """(asker, slot, id, score): the ``top`` best ids of the entries found."""
        each = Window.partitionBy("asker", "slot").orderBy(F.desc("score"), "id")
        ids = found.join(entries.select("mark", "ids"), "mark").select("asker", "slot", "score", F.explode("ids").alias("id"))
        return ids.withColumn("place", F.row_number().over(each)).filter(F.col("place") <= top)

    near = stage(_best(stored, _asking(asks.withColumns(whole(F.lit(LEAST))), ranges, True), True, most, settings), "hardneg-near")
    reached = merged(near, most).groupBy(F.col("asker").alias("mark")).agg(
        F.when(F.count(F.lit(1)) == most, F.min("score")).otherwise(LEAST).alias("least"))
    later = asks.join(reached, "mark", "left").withColumns(whole(F.coalesce("least", F.lit(LEAST))))
    beyond = _best(stored, stage(_asking(later, ranges, False), "hardneg-asked"), True, most, settings)
    alike = stage(merged(near.unionByName(beyond), most).drop("slot", "place"), "hardneg-positives")

    scores = alike.filter(F.col("score") >= 0).groupBy(F.col("asker").alias("mark")).agg(F.sort_array(F.collect_set("score")).alias("highs"))
    lows = F.transform("highs", lambda s: s - F.floor(s.cast("decimal(19,0)") / 5).cast("long"))  # the least score with 100 * score >= 80 * s
    asked = stage(_asking(asks.join(scores, "mark").withColumn("lows", lows), ranges, None), "hardneg-asked")
    unlike = merged(_best(stored, asked, False, negatives, settings), negatives)
    unlike = unlike.join(scores.select(F.col("mark").alias("asker"), "highs"), "asker").select(
        "asker", F.get("highs", F.col("slot")).alias("positive_score"), F.col("place").alias("rank"),
        F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))

    each = Window.partitionBy("anchor_id", "asker").orderBy(F.desc("score"), "id")
    chosen = (
        anchors.join(alike, "asker").filter(F.col("id") != F.col("anchor_id"))
        .withColumn("place", F.row_number().over(each)).filter(F.col("place") <= positives)
        .select("anchor_id", "asker", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")))
    return chosen.join(unlike, ["asker", "positive_score"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")

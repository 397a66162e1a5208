"""Approximate nearest neighbours by balanced posting lists.

Centroids are fitted on a bounded sample by halving it along its main direction, so lists
are of like length. A vector enters the list of its nearest centroid and, near a boundary,
those of others about as near. Centroids are searched through an in-memory graph of their
neighbours. A query reads every list whose centroid is at most ``ratio`` times as far as
its nearest: first the nearest, whose best vectors give the score that those of the other
lists must reach, so these return few. Lists are cut into blocks of bounded size, so
neither a long list nor many queries of one list end in one task.

Equal vectors are one entry with their smallest ids, so a vector on a third of all rows is
compared once. Largest inner product becomes smallest distance by one extra dimension that
gives all vectors the same length; scores are inner products of the original vectors.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlift.sources.stages import stage


@dataclass
class Settings:
    sample: int = 20_000  # distinct vectors that centroids are fitted on
    list_vectors: int = 512
    most_lists: int = 2048  # bounds what is broadcast
    copies: int = 3
    boundary: float = 1.05
    ratio: float = 1.12
    neighbours: int = 24
    block: int = 4096
    seed: int = 3


def valid_vectors(rows: DataFrame, *, key: str, vector: str) -> DataFrame:
    """(id, vector as doubles): without null ids, and null, zero, non-finite or odd-sized vectors.

    Vectors must have one size; if they do not, the most frequent size stays, ties to the smaller.
    """
    v = F.col(vector).cast("array<double>")
    fit = rows.select(F.col(key).alias("id"), v.alias("vector")).filter(
        F.col("id").isNotNull() & F.col("vector").isNotNull()
        & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("vector", lambda x: x != 0))
    sizes = fit.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    return fit.filter(F.size("vector") == (sizes[0]["n"] if sizes else 0))


def distinct_vectors(vectors: DataFrame, most: int) -> DataFrame:
    """(key, ids, vector) of each different vector: its least id and its ``most`` smallest ids.

    The limit holds before the shuffle too, so a hot vector sends ``most`` ids a task.
    """
    order = Window.partitionBy("vector").orderBy("id")
    first = vectors.withColumn("__rank", F.dense_rank().over(order)).filter(F.col("__rank") <= most)
    ids = first.groupBy("vector").agg(F.sort_array(F.collect_set("id")).alias("ids"))
    return ids.select(F.get("ids", 0).alias("key"), "ids", "vector")


def balanced_centroids(sample: np.ndarray, lists: int, rng: np.random.Generator) -> np.ndarray:
    """Means of ``lists`` equal parts: halves along the main direction, again and again."""
    if lists <= 1 or len(sample) <= 1:
        return sample.mean(axis=0, keepdims=True)
    centred = sample - sample.mean(axis=0)
    axis = rng.normal(size=sample.shape[1])
    for _ in range(6):
        axis = centred.T @ (centred @ axis)
        axis /= max(np.linalg.norm(axis), 1e-300)
    order = np.argsort(centred @ axis, kind="stable")
    low = lists // 2
    cut = max(1, len(order) * low // lists)
    return np.concatenate([
        balanced_centroids(sample[order[:cut]], low, rng), balanced_centroids(sample[order[cut:]], lists - low, rng)])


def neighbour_graph(centroids: np.ndarray, degree: int) -> np.ndarray:
    """The nearest other centroids of each, and one of the next in order, which keeps the graph connected."""
    n = len(centroids)
    degree = min(degree, n - 1)
    out = np.empty((n, degree + 1), np.int64)
    for at in range(0, n, 256):
        part = centroids[at:at + 256]
        far = (part ** 2).sum(1)[:, None] - 2 * part @ centroids.T + (centroids ** 2).sum(1)
        far[np.arange(len(part)), at + np.arange(len(part))] = np.inf
        out[at:at + 256, :degree] = np.argpartition(far, max(0, degree - 1), axis=1)[:, :degree] if degree else 0
    out[:, degree] = (np.arange(n) + 1) % n
    return out


def search_graph(
    centroids: np.ndarray, graph: np.ndarray, points: np.ndarray, ratio: float, beam: int = 8, entries: int = 16,
) -> tuple[np.ndarray, np.ndarray]:
    """Distance of each point to the centroids that the search reached, else infinity; and whether within ``ratio`` of the nearest."""
    n, lists = len(points), len(centroids)
    far = np.full((n, lists), np.inf)
    opened = np.zeros((n, lists), bool)
    own, new = np.divmod(np.arange(n * min(entries, lists)), min(entries, lists))
    new = new * lists // min(entries, lists)
    while own.size:
        far[own, new] = np.sqrt(((points[own] - centroids[new]) ** 2).sum(axis=1))
        reach = ratio * far.min(axis=1)
        if lists > beam:
            reach = np.maximum(reach, np.partition(far, beam - 1, axis=1)[:, beam - 1])
        own, at = np.nonzero((far <= reach[:, None]) & ~opened & np.isfinite(far))
        opened[own, at] = True
        flat = np.unique((own[:, None] * lists + graph[at]).ravel())
        own, new = flat // lists, flat % lists
        unknown = ~np.isfinite(far[own, new])
        own, new = own[unknown], new[unknown]
    return far, far <= ratio * far.min(axis=1)[:, None]


def _lifted(vectors: np.ndarray, longest: float) -> np.ndarray:
    """Scaled so that the longest has length 1, with one more dimension that gives all that length."""
    scaled = vectors / longest
    return np.concatenate([scaled, np.sqrt(np.maximum(0, 1 - (scaled ** 2).sum(axis=1)))[:, None]], axis=1)


def _matrix(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _placed(distinct: DataFrame, fitted, settings: Settings, queries: bool) -> DataFrame:
    """(list, key, vector as bytes, nearest): where a vector is stored, or which lists a query reads; the nearest is marked."""
    schema = T.StructType([
        T.StructField("list", T.IntegerType()), T.StructField("key", T.LongType()), T.StructField("vector", T.BinaryType()),
        T.StructField("nearest", T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centroids, graph, longest = fitted.value
        for batch in batches:
            for first in range(0, batch.num_rows, 512):
                part = batch.slice(first, 512)
                keys, vectors = part.column(0).to_numpy(zero_copy_only=False), _matrix(part.column(1))
                if queries:  # a query's length does not change its order of neighbours
                    length = np.abs(vectors).max(axis=1, keepdims=True)
                    points = vectors / length
                    points = np.pad(points / np.sqrt((points ** 2).sum(axis=1, keepdims=True)), ((0, 0), (0, 1)))
                    far, near = search_graph(centroids, graph, points, settings.ratio)
                else:
                    far, near = search_graph(centroids, graph, _lifted(vectors, longest), settings.boundary)
                    if far.shape[1] > settings.copies:
                        worst = np.partition(far, settings.copies - 1, axis=1)[:, settings.copies - 1]
                        near &= far <= worst[:, None]
                row, place = np.nonzero(near)
                data = [v.tobytes() for v in vectors]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(place, pa.int32()), pa.array(keys[row], pa.int64()), pa.array([data[r] for r in row], pa.binary()),
                     pa.array(place == far.argmin(axis=1)[row])],
                    ["list", "key", "vector", "nearest"])

    return distinct.select(F.col("key").cast("long"), "vector").mapInArrow(run, schema)


def _blocked(rows: DataFrame, own: str, blocks: DataFrame, other: str) -> DataFrame:
    """Each row in its block of the list, once for every block of the other side."""
    mine = F.pmod(F.xxhash64("key"), F.col(own)).cast("int").alias(f"{own}_at")
    every = F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias(f"{other}_at")
    return rows.join(F.broadcast(blocks), "list").select(*rows.columns, mine, every)


def _compared(stored: DataFrame, reads: DataFrame, top: int, block: int) -> DataFrame:
    """(qkey, key, score): the ``top`` best of each block that a query reads, if they reach the query's ``bound``."""

    def sizes(rows: DataFrame, name: str) -> DataFrame:
        return rows.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias(name))

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        kind = pa.schema([("qkey", pa.int64()), ("key", pa.int64()), ("score", pa.float64())])
        if not left.num_rows or not right.num_rows:
            return pa.Table.from_pylist([], schema=kind)
        left = left.sort_by("key")  # equal scores keep the smaller keys
        keys, qkeys, bounds = left.column("key").to_numpy(), right.column("key").to_numpy(), right.column("bound").to_numpy()
        vectors, asked = (
            np.frombuffer(b"".join(t.column("vector").to_pylist())).reshape(t.num_rows, -1) for t in (left, right))
        # rounding of the matrix product is far below this share of the lengths
        slack = 1e-12 * np.sqrt((asked ** 2).sum(axis=1)) * np.sqrt((vectors ** 2).sum(axis=1).max())
        out = []
        for at in range(0, len(qkeys), 256):
            scores = asked[at:at + 256] @ vectors.T
            best = np.argsort(-scores, axis=1, kind="stable")[:, :top]
            least = (bounds - slack)[at:at + 256, None]
            row, column = np.nonzero(np.take_along_axis(scores, best, axis=1) >= least)
            place = best[row, column]
            exact = (asked[at + row] * vectors[place]).sum(axis=1)
            out.append(pa.Table.from_arrays([pa.array(qkeys[at + row]), pa.array(keys[place]), pa.array(exact)], schema=kind))
        return pa.concat_tables(out)

    blocks = sizes(stored, "p").join(sizes(reads, "q"), "list")
    at = ["list", "p_at", "q_at"]
    return _blocked(stored.select("list", "key", "vector"), "p", blocks, "q").groupBy(*at).cogroup(
        _blocked(reads.select("list", "key", "vector", "bound"), "q", blocks, "p").groupBy(*at)).applyInArrow(
        compare, "qkey long, key long, score double")


def search(
    candidates: DataFrame, queries: DataFrame, *, key: str = "vec_id", vector: str = "embedding", top: int = 20,
    settings: Settings | None = None,
) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's ``top`` nearest found, largest inner product first.

    Both sides have ``key`` (long) and ``vector``; a query is not its own neighbour. Ties go
    to the smaller id. Rows that repeat an id and its vector count once. Queries and
    candidates that ``valid_vectors`` leaves out take no part. Fewer candidates than
    ``top`` are all returned if the lists that hold them are read.
    """
    settings = settings or Settings()
    spark = candidates.sparkSession
    known = stage(distinct_vectors(valid_vectors(candidates, key=key, vector=vector), top + 1), "ann-vectors")
    asked = stage(valid_vectors(queries, key=key, vector=vector).distinct(), "ann-queries")
    asked_keys = asked.groupBy("vector").agg(F.min("id").alias("key"))
    squares = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x)
    count, longest = known.agg(F.count(F.lit(1)), F.sqrt(F.max(squares))).first()
    empty = "query_id long, rank int, vec_id long, score double"
    if not count:
        return spark.createDataFrame([], empty)
    sample = known.orderBy(F.xxhash64("key"), "key").limit(settings.sample).select("vector").toArrow()
    points = _lifted(_matrix(sample.column(0)), longest)
    lists = int(max(1, min(settings.most_lists, count // settings.list_vectors, len(points) // 2)))
    centroids = balanced_centroids(points, lists, np.random.default_rng(settings.seed))
    fitted = spark.sparkContext.broadcast((centroids, neighbour_graph(centroids, settings.neighbours), longest))
    stored = stage(_placed(known, fitted, settings, False), "ann-lists")
    reads = stage(_placed(asked_keys, fitted, settings, True), "ann-reads")
    first = Window.partitionBy("qkey").orderBy(F.desc("score"), "key")

    def best_of(found: DataFrame) -> DataFrame:
        once = found.groupBy("qkey", "key").agg(F.max("score").alias("score"))
        return once.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= top + 1)

    none = F.lit(float("-inf"))
    near = stage(best_of(_compared(
        stored, reads.filter("nearest").withColumn("bound", none), top + 1, settings.block)).drop("rank"), "ann-near")
    bounds = near.groupBy(F.col("qkey").alias("key")).agg(
        F.when(F.count(F.lit(1)) > top, F.min("score")).otherwise(none).alias("bound"))
    others = reads.filter(~F.col("nearest")).join(bounds, "key", "left").withColumn("bound", F.coalesce("bound", none))
    beyond = _compared(stored, others, top + 1, settings.block)
    best = best_of(near.unionByName(beyond)).drop("rank")
    each = Window.partitionBy("qkey").orderBy(F.desc("score"), "vec_id")
    rows = (
        best.join(known.select("key", "ids"), "key").select("qkey", "score", F.explode("ids").alias("vec_id"))
        .withColumn("rank", F.row_number().over(each)).filter(F.col("rank") <= top + 1).drop("rank"))
    named = asked.join(asked_keys.withColumnRenamed("key", "qkey"), "vector").select(F.col("id").alias("query_id"), "qkey")
    last = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        named.distinct().join(rows, "qkey").filter(F.col("vec_id") != F.col("query_id"))
        .withColumn("rank", F.row_number().over(last)).filter(F.col("rank") <= top)
        .select("query_id", "rank", "vec_id", "score"))

"""Removal of repeated passages by merged suffix structures.

Windows are brought together by their anchors (see ``regions``): only regions whose anchor
occurs twice can repeat. Equal regions collapse into one with a count before any text
moves. Buckets of different regions are then indexed by Burrows-Wheeler transforms that
are merged by interleave refinement (see ``bwtmerge``), and the blocks of rows that share
a whole window say which windows repeat. A bucket with a single region is a transform of
its own and needs no merge: its count decides. A bucket of more regions than one task
should hold is split further, by the window itself.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlift.llm.batches import arrow_schema, give_back, map_slices, texts_of, whole_text, with_fields
from ledgerlift.llm.bwtmerge import repeated_windows
from ledgerlift.llm.regions import Winnower
from ledgerlift.sources.stages import stage

BUCKET = ["__bucket", "__hash"]
DOC = ["__k1", "__k2"]


def _keyed(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``docs`` with 128 bits that name a row's key and text; repeated rows share them and their fate."""
    whole, name = whole_text(text), F.coalesce(F.col(key).cast("string"), F.lit(""))
    return docs.withColumns({
        "__k1": F.xxhash64(F.col(key).isNull(), name, whole), "__k2": F.xxhash64(whole, name, F.lit(2))})


def region_rows(docs: DataFrame, length: int, text: str) -> DataFrame:
    """(__k1, __k2, first, windows, __bucket, __hash): the regions of every whole text.

    ``first`` is the region's first window in its text, the bucket its anchor's hash and
    the hash that of its bytes.
    """
    schema = T.StructType([T.StructField(n, t) for n, t in (
        ("__k1", T.LongType()), ("__k2", T.LongType()), ("first", T.LongType()), ("windows", T.IntegerType()),
        ("__bucket", T.LongType()), ("__hash", T.LongType()))])
    fields = arrow_schema(schema)

    def start():
        from xxhash import xxh3_64_intdigest

        winnower = Winnower(length)

        def work(batch: pa.RecordBatch) -> pa.RecordBatch | None:
            texts = [t.encode() for t in texts_of(batch, text)]
            ends = np.cumsum([len(t) for t in texts])
            joined = b"".join(texts)
            parts = list(winnower.regions(np.frombuffer(joined, np.uint8), ends))
            if not parts:
                return None
            first, count, bucket = (np.concatenate(p) for p in zip(*parts, strict=True))
            hashes = np.fromiter(
                (xxh3_64_intdigest(joined[a:a + n + length - 1]) for a, n in zip(first.tolist(), count.tolist(), strict=True)),
                np.uint64, len(first))
            row = np.searchsorted(ends, first, side="right")
            begin = np.concatenate([[0], ends[:-1]])
            arrays = [
                batch.column("__k1").take(pa.array(row)), batch.column("__k2").take(pa.array(row)),
                pa.array(first - begin[row]), pa.array(count.astype(np.int32)), pa.array(bucket.view(np.int64)),
                pa.array(hashes.view(np.int64))]
            return pa.RecordBatch.from_arrays(arrays, schema=fields)

        return work

    return map_slices(docs.select(*DOC, text), text, start, schema, 2 << 20)


def _region_texts(docs: DataFrame, regions: DataFrame, length: int, text: str) -> DataFrame:
    """``regions`` (one document's place each) with their bytes, fetched from the documents in one join."""
    wanted = regions.groupBy(*DOC).agg(F.collect_list(F.struct("first", "windows", *BUCKET, "weight")).alias("__regions"))
    schema = T.StructType([
        T.StructField("__bucket", T.LongType()), T.StructField("__hash", T.LongType()), T.StructField("weight", T.LongType()),
        T.StructField("bytes", T.BinaryType())])

    def start():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            bucket, hashes, weight, data = [], [], [], []
            for t, own in zip(texts_of(batch, text), batch.column("__regions").to_pylist(), strict=True):
                whole = t.encode()
                for r in own:
                    bucket.append(r["__bucket"]), hashes.append(r["__hash"]), weight.append(r["weight"])
                    data.append(whole[r["first"]:r["first"] + r["windows"] + length - 1])
            return pa.RecordBatch.from_arrays(
                [pa.array(bucket, pa.int64()), pa.array(hashes, pa.int64()), pa.array(weight, pa.int64()), pa.array(data, pa.binary())],
                ["__bucket", "__hash", "weight", "bytes"])

        return work

    joined = docs.select(*DOC, text).join(wanted, DOC).select(text, "__regions")
    return map_slices(joined, text, start, schema, 4 << 20)


_VERDICT = T.StructType([
    T.StructField("__bucket", T.LongType()), T.StructField("__hash", T.LongType()),
    T.StructField("runs", T.ArrayType(T.IntegerType()))])


def _runs(mask: np.ndarray) -> list[int]:
    """First place and length of each run of true values, one after the other."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], mask.astype(np.int8), [0]])))
    edges[1::2] -= edges[::2]
    return edges.tolist()


def merged_verdicts(texts: DataFrame, length: int, most_bytes: int = 2 << 20) -> DataFrame:
    """(__bucket, __hash, runs): which windows of each region repeat, by merged transforms.

    A task takes whole buckets, ``most_bytes`` at a time, or one that is larger; a bucket is bounded before.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set = set()
        bucket: list = []
        hashes: list = []
        weight: list = []
        data: list = []

        def told(upto: int) -> pa.RecordBatch:
            masks = repeated_windows(data[:upto], np.array(weight[:upto]), length)
            out = pa.RecordBatch.from_arrays(
                [pa.array(bucket[:upto], pa.int64()), pa.array(hashes[:upto], pa.int64()),
                 pa.array([_runs(m) for m in masks], pa.list_(pa.int32()))], ["__bucket", "__hash", "runs"])
            for column in (bucket, hashes, weight, data):
                del column[:upto]
            return out

        held = done = ahead = 0  # bytes, and rows and bytes of the buckets that are complete
        for batch in batches:
            for b, h, w, t in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if bucket and b != bucket[-1]:
                    seen.clear()
                    done, ahead = len(data), held
                if h in seen:
                    continue  # a repeated row of the documents gave the same region again
                if done and held + len(t) > most_bytes:
                    yield told(done)
                    held, done, ahead = held - ahead, 0, 0
                seen.add(h)
                bucket.append(b), hashes.append(h), weight.append(w), data.append(t)
                held += len(t)
        if data:
            yield told(len(data))
        give_back()

    # much work for few bytes: as many tasks as the session asks for, not merged by size
    tasks = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = texts.repartition(tasks, "__bucket").sortWithinPartitions(*BUCKET)
    return dealt.mapInArrow(run, _VERDICT)


def window_verdicts(texts: DataFrame, length: int) -> DataFrame:
    """The same verdicts for regions of very large buckets: every window is a bucket of its own."""
    schema = T.StructType([T.StructField(n, T.LongType()) for n in ("__bucket", "__hash", "weight", "at", "h1", "h2")])

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_128_digest

        for batch in batches:
            for row in range(batch.num_rows):
                b, h, w, t = (c[row].as_py() for c in batch.columns)
                n = len(t) - length + 1
                found = np.frombuffer(b"".join(xxh3_128_digest(t[i:i + length]) for i in range(n)), np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, v)) for v in (b, h, w)] + [pa.array(np.arange(n)), pa.array(found[:, 0].copy()), pa.array(found[:, 1].copy())],
                    names)

    names = schema.names
    rows = stage(texts.dropDuplicates(BUCKET).mapInArrow(windows, schema), "dedup-windows")
    often = rows.groupBy("h1", "h2").agg(F.sum("weight").alias("n")).filter("n >= 2")
    return rows.join(often, ["h1", "h2"]).groupBy(*BUCKET).agg(
        F.flatten(F.collect_list(F.array(F.col("at").cast("int"), F.lit(1)))).alias("runs"))


HEAVY_REGIONS, HEAVY_BUCKETS, SALTS = 20_000, 256, 32


def _marked(regions: DataFrame, shared: DataFrame) -> DataFrame:
    """The regions of shared buckets with ``mixed``; an anchor that stands in very many texts is salted by the text.

    The largest buckets, 256 at most, are named in the plan; all others join as they are.
    """
    largest = shared.filter(F.col("n") >= HEAVY_REGIONS).orderBy(F.desc("n"), "__bucket").limit(HEAVY_BUCKETS)
    heavy = F.col("__bucket").isin([r["__bucket"] for r in largest.select("__bucket").collect()])
    salt = F.when(heavy, F.pmod(DOC[0], F.lit(SALTS)).cast("int")).otherwise(0)
    every = F.when(heavy, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    return regions.withColumn("__salt", salt).join(
        shared.select("__bucket", "mixed", F.explode(every).alias("__salt")), ["__bucket", "__salt"]).drop("__salt")


def repeated_runs(
    docs: DataFrame, *, length: int = 200, text: str = "text", most_regions: int = 20_000,
) -> DataFrame:
    """(__k1, __k2, __runs): first window and number of each run of repeated windows of a keyed document."""
    regions = stage(region_rows(docs, length, text), "dedup-regions")
    shared = stage(regions.groupBy("__bucket").agg(
        F.count(F.lit(1)).alias("n"), F.min("__hash").alias("lo"), F.max("__hash").alias("hi")).filter("n >= 2").select(
        "__bucket", "n", (F.col("lo") != F.col("hi")).alias("mixed")), "dedup-buckets")
    found = stage(_marked(regions, shared), "dedup-shared")
    variants = found.filter("mixed").groupBy(*BUCKET).agg(
        F.count(F.lit(1)).alias("weight"), F.min(F.struct(*DOC, "first", "windows")).alias("place")).select(
        *BUCKET, "weight", "place.*")
    variants = stage(variants, "dedup-variants")
    large = variants.groupBy("__bucket").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > most_regions).select(
        "__bucket", F.lit(True).alias("large"))
    texts = stage(
        _region_texts(docs, variants, length, text).join(large, "__bucket", "left").withColumn(
            "large", F.coalesce("large", F.lit(False))), "dedup-texts")
    plain = ["__bucket", "__hash", "weight", "bytes"]
    verdicts = stage(merged_verdicts(texts.filter("not large").select(*plain), length), "dedup-verdicts").unionByName(
        window_verdicts(texts.filter("large").select(*plain), length))
    whole = F.array(F.lit(0), F.col("windows"))
    pure = found.filter("not mixed").select(*DOC, "first", whole.alias("runs"))
    mixed = found.filter("mixed").join(verdicts.filter(F.size("runs") > 0), BUCKET).select(*DOC, "first", "runs")
    return pure.unionByName(mixed).groupBy(*DOC).agg(F.collect_list(F.struct("first", "runs")).alias("__runs"))


def remove_repeats(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", length: int = 200, keep: list[str] | None = None,
    most_regions: int = 20_000, whole_characters: bool = False,
) -> DataFrame:
    """Each document's kept bytes and removed spans.

    Removed is every byte covered by a string of ``length`` bytes that also starts anywhere
    else in the documents, the same one included; matches never cross documents and are
    judged on the input. Columns: ``keep`` (all but the text, unless named), kept (binary),
    n_bytes and spans (array of start and end). Null text counts as empty and shorter
    texts keep all. Two rows alike in key and text repeat each other and lose all that
    is long enough. ``whole_characters`` keeps a character of which a byte stays, so the
    kept bytes are text. Clashing names raise ValueError.
    """
    keep = [c for c in docs.columns if c != text] if keep is None else keep
    keyed = _keyed(docs, key, text)
    runs = repeated_runs(keyed, length=length, text=text, most_regions=most_regions)
    joined = keyed.select(*dict.fromkeys([*keep, text]), *DOC).join(runs, DOC, "left").drop(*DOC)
    span = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
    schema = with_fields(joined, keep, n_bytes=T.LongType(), kept=T.BinaryType(), spans=T.ArrayType(span))
    fields = arrow_schema(schema)

    def start():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            sizes, kept, spans = [], [], []
            for t, found in zip(texts_of(batch, text), batch.column("__runs").to_pylist(), strict=True):
                data = t.encode()
                edges = np.zeros(len(data) + 1, np.int32)
                for r in found or []:
                    for at, n in zip(r["runs"][::2], r["runs"][1::2], strict=True):
                        edges[r["first"] + at] += 1
                        edges[r["first"] + at + n + length - 1] -= 1
                covered = np.cumsum(edges[:-1]) > 0
                codes = np.frombuffer(data, np.uint8)
                if whole_characters:  # a character goes only if all of its bytes do
                    first = np.flatnonzero((codes & 0xC0) != 0x80)
                    if len(first):
                        covered = np.repeat(
                            np.logical_and.reduceat(covered, first), np.diff(np.concatenate([first, [len(codes)]])))
                cuts = np.flatnonzero(np.diff(np.concatenate([[0], covered.astype(np.int8), [0]])))
                sizes.append(len(data))
                kept.append(codes[~covered].tobytes())
                spans.append([{"start": int(a), "end": int(b)} for a, b in zip(cuts[::2], cuts[1::2], strict=True)])
            arrays = [batch.column(c) for c in keep] + [
                pa.array(sizes, pa.int64()), pa.array(kept, pa.binary()), pa.array(spans, fields.field("spans").type)]
            return pa.RecordBatch.from_arrays(
                [a.cast(f.type) for a, f in zip(arrays, fields, strict=True)], schema=fields)

        return work

    return map_slices(joined, text, start, schema, 2 << 20)


def removed_bytes(spans: str = "spans") -> Column:
    return F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])

"""SimHash fingerprints and near-duplicate groups by anchor-point covering.

Anchors are the words of a perfect covering code: the 63 low bits of an anchor form a word
of the Hamming code of length 63, the top bit is free. Every 64-bit value lies within
distance 1 of an anchor. Two fingerprints at distance t have a value halfway, at most
ceil(t/2) from both; its anchor is then within 1 + ceil(t/2) of both. So fingerprints are
replicated to every anchor within the covering radius plus half the threshold (the whole
threshold, shared between both ends) and compared with those at the same anchor. For two
bits that is 33 anchors a fingerprint, and an anchor can hold at most 4,160 different
fingerprints, however large the corpus: the comparison is bounded by geometry, not by a cap.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlift.llm.batches import arrow_schema, extended, map_slices, texts_of, with_fields
from ledgerlift.operators.clusters import connected_components
from ledgerlift.sources.stages import stage

_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def shingle_hashes(text: str, words: int, seed: int = 42) -> np.ndarray:
    """XXH64 of every run of ``words`` words, A-Z lowered, words joined by a space.

    Words are split at the six ASCII white-space bytes. Fewer words: the whole sequence
    is one shingle; none: no hash.
    """
    from xxhash import xxh64_intdigest

    found = text.encode().translate(_LOWER).split()
    if not found:
        return np.empty(0, np.uint64)
    joined = b" ".join(found)
    if len(found) <= words:
        return np.array([xxh64_intdigest(joined, seed)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    first = np.concatenate([[0], ends[:-1] + 1])[: len(found) - words + 1].tolist()
    last = ends[words - 1:].tolist()
    return np.array([xxh64_intdigest(joined[a:b], seed) for a, b in zip(first, last, strict=True)], np.uint64)


_BLOCK = 1 << 16


def fingerprint(hashes: np.ndarray) -> int:
    """A bit is 1 if it is set in over half the hashes; no hash: 0."""
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), _BLOCK):
        part = hashes[at:at + _BLOCK]
        ones += np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(
            axis=0, dtype=np.int64)
    return int(sum(1 << b for b in np.flatnonzero(2 * ones > len(hashes)).tolist()))


def fingerprints(
    docs: DataFrame, *, words: int = 5, text: str = "text", keep: list[str] | None = None, name: str = "fp",
) -> DataFrame:
    """The columns ``keep`` (all but the text) and the SimHash of each whole text as a long.

    Null and empty texts, and texts of white space only, have fingerprint 0. One row out
    for each row in; a column already called ``name`` raises ValueError.
    """
    keep = [c for c in docs.columns if c != text] if keep is None else keep
    schema = with_fields(docs, keep, **{name: T.LongType()})
    fields = arrow_schema(schema)

    def start():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = np.array([fingerprint(shingle_hashes(t, words)) for t in texts_of(batch, text)], np.uint64)
            return extended(batch, keep, {name: pa.array(found.view(np.int64))}, fields)

        return work

    return map_slices(docs.select(*dict.fromkeys([*keep, text])), text, start, schema)


def anchor_masks(threshold: int) -> list[np.ndarray]:
    """For each of the 64 syndromes the flips of at most 1 + ceil(threshold/2) bits that reach an anchor.

    Bit i (0 to 62) has the syndrome i + 1, bit 63 the syndrome 0; a value is an anchor
    if the syndromes of its set bits cancel.
    """
    radius = 1 + -(-threshold // 2)
    masks: list[list[int]] = [[] for _ in range(64)]
    for size in range(radius + 1):
        for bits in combinations(range(64), size):
            syndrome = 0
            for b in bits:
                syndrome ^= (b + 1) & 63
            masks[syndrome].append(sum(1 << b for b in bits))
    return [np.array(m, np.uint64) for m in masks]


_PARITY = [sum(1 << b for b in range(63) if (b + 1) >> k & 1) for k in range(6)]


def syndromes(values: np.ndarray) -> np.ndarray:
    out = np.zeros(len(values), np.int64)
    for k, mask in enumerate(_PARITY):
        out |= (np.bitwise_count(values & np.uint64(mask)).astype(np.int64) & 1) << k
    return out


def at_anchors(fps: DataFrame, threshold: int, fp: str = "fp") -> DataFrame:
    """(anchor, fp): every fingerprint at every anchor within reach."""
    schema = T.StructType([T.StructField("anchor", T.LongType()), T.StructField("fp", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        masks = anchor_masks(threshold)
        most = max(map(len, masks))
        table, count = np.zeros((64, most), np.uint64), np.array(list(map(len, masks)))
        for s, m in enumerate(masks):
            table[s, :len(m)] = m
        for batch in batches:
            for first in range(0, batch.num_rows, step := max(1, (1 << 20) // most)):
                own = batch.column(0)[first:first + step].to_numpy(zero_copy_only=False).view(np.uint64)
                s = syndromes(own)
                anchors = own[:, None] ^ table[s]
                real = np.arange(most) < count[s][:, None]
                row = np.broadcast_to(own[:, None], anchors.shape)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchors[real].view(np.int64)), pa.array(row[real].view(np.int64))], ["anchor", "fp"])

    return fps.select(F.col(fp).alias("fp")).mapInArrow(run, schema)


def links_at_anchors(placed: DataFrame, threshold: int) -> DataFrame:
    """(a, b): enough links to connect all fingerprints that the threshold connects.

    Rows of an anchor are compared in sorted order, a bounded group at a time. Each group
    gives at most one link a member, to the least member it is connected with there.
    """
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = (np.empty(0, np.int64), np.empty(0, np.uint64))

        def linked(anchor: np.ndarray, fp: np.ndarray) -> pa.RecordBatch | None:
            n = len(fp)
            least = np.arange(n)
            left, right = [], []
            for gap in range(1, n):
                same = np.flatnonzero(anchor[gap:] == anchor[:-gap])
                if not same.size:
                    break
                near = same[np.bitwise_count(fp[same] ^ fp[same + gap]) <= threshold]
                left.append(near)
                right.append(near + gap)
            if not left or not sum(map(len, left)):
                return None
            i, j = np.concatenate(left), np.concatenate(right)
            while True:
                low = np.minimum(least[i], least[j])
                moved = least.copy()
                np.minimum.at(moved, i, low)
                np.minimum.at(moved, j, low)
                moved = moved[moved]
                if (moved == least).all():
                    break
                least = moved
            low = np.flatnonzero(least != np.arange(n))
            pairs = np.unique(np.stack([fp[low].view(np.int64), fp[least[low]].view(np.int64)]), axis=1)
            return pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], ["a", "b"])

        for batch in batches:
            anchor = np.concatenate([held[0], batch.column(0).to_numpy(zero_copy_only=False)])
            fp = np.concatenate([held[1], batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)])
            if not len(anchor):
                continue
            cut = int(np.searchsorted(anchor, anchor[-1]))  # the last group may go on in the next batch
            if cut and (done := linked(anchor[:cut], fp[:cut])) is not None:
                yield done
            held = (anchor[cut:], fp[cut:])
        if len(held[0]) and (done := linked(*held)) is not None:
            yield done

    return placed.repartition("anchor").sortWithinPartitions("anchor", "fp").mapInArrow(run, schema).distinct()


def near_duplicates(prints: DataFrame, *, threshold: int = 2, key: str = "doc_id", fp: str = "fp") -> DataFrame:
    """``prints`` with component_id: the smallest key reachable over fingerprints that differ in at most ``threshold`` bits.

    ``prints`` should be a written table, as it is read twice. Documents with equal
    fingerprints are one node; a fingerprint on a third of all rows is one row from the
    first aggregation on. Null keys form no component id of their own: they take the
    smallest key that is not null, if any. An empty table gives an empty table. A column
    component_id is an error.
    """
    with_fields(prints, prints.columns, component_id=prints.schema[key].dataType)
    nodes = stage(prints.groupBy(fp).agg(F.min(key).alias("__least")), "simhash-nodes")
    links = links_at_anchors(at_anchors(nodes, threshold, fp), threshold)
    joined = connected_components(stage(links, "simhash-links"))
    roots = nodes.join(joined, nodes[fp] == joined["node"], "left").select(
        nodes[fp].alias("__fp"), "__least", F.coalesce("component", nodes[fp]).alias("__root"))
    ids = roots.groupBy("__root").agg(F.min("__least").alias("component_id"))
    groups = roots.join(ids, "__root").select("__fp", "component_id")
    return prints.join(groups, prints[fp] == groups["__fp"]).drop("__fp")

"""Byte-level BPE encoding and decoding by corpus-level merge replay.

The distinct pieces of a shard of the corpus are laid out as one array of symbols. An
inverted index maps every pair of neighbouring symbols to the positions where it stands.
The merges are then replayed in rank order: each takes its pair's positions from the
index, joins the symbols there and enters the two new neighbour pairs, so a merge touches
only the places where it applies. Every distinct piece is encoded once a shard, however
often it occurs, and pieces do not influence each other, so shards need no exchange.
"""

from __future__ import annotations

import base64
import heapq
import re
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ledgerlift.llm.batches import arrow_schema, extended, map_slices, texts_of, with_fields
from ledgerlift.llm.segments import SegmentStore

# A space before a visible character always starts a new match of the pattern, so texts
# may be cut there; matches are found in each distinct segment once.
_CUT = re.compile(r" (?=\S)")


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and rank of a rank file (base64 and rank a line); read on the driver, a few MB."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


class MergeReplay:
    """Replays the merges of a rank table over many pieces at once.

    A merge's rank is the id of the token it makes, so the index is kept by that id: the
    positions whose symbol and next symbol make the token. Positions are entered as
    arrays and checked when their merge is due.
    """

    def __init__(self, ranks: dict[bytes, int]):
        if any(bytes([b]) not in ranks for b in range(256)):
            raise ValueError("the rank table lacks a single byte")
        self.ranks = ranks
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        made = [
            (left << 32 | right, rank)
            for token, rank in ranks.items() for cut in range(1, len(token))
            if (left := ranks.get(token[:cut])) is not None and (right := ranks.get(token[cut:])) is not None
        ]
        made.sort()
        self.pairs = np.array([p for p, _ in made] or [-1], np.int64)
        self.makes = np.array([r for _, r in made] or [-1], np.int32)

    def _made(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The token that each pair makes, -1 if none; a negative symbol makes none."""
        pair = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
        return np.where((self.pairs[at] == pair) & (left >= 0) & (right >= 0), self.makes[at], -1)

    def encode(self, pieces: list[bytes]) -> list[list[int]]:
        """The ids of every piece; a piece that is itself a token stays whole."""
        split = [p for p in pieces if p not in self.ranks]
        replayed = iter(self._replay(split))
        return [[self.ranks[p]] if p in self.ranks else next(replayed) for p in pieces]

    def _replay(self, pieces: list[bytes]) -> list[list[int]]:
        if not pieces:
            return []
        size = np.fromiter(map(len, pieces), np.int64, len(pieces))
        stops = np.cumsum(size + 1) - 1  # a stop after each piece keeps neighbours in different pieces apart
        n = int(stops[-1]) + 1
        symbols = np.full(n, -1, np.int32)
        symbols[np.delete(np.arange(n), stops)] = self.single[np.frombuffer(b"".join(pieces), np.uint8)]
        after = np.arange(1, n + 1, dtype=np.int32)
        before = np.arange(-1, n - 1, dtype=np.int32)
        makes = np.full(n, -1, np.int32)
        index: dict[int, list[np.ndarray]] = {}
        due: list[int] = []

        def enter(at: np.ndarray, made: np.ndarray) -> None:
            order = made.argsort(kind="stable")
            made, at = made[order], at[order]
            cuts = [0, *(np.flatnonzero(made[1:] != made[:-1]) + 1).tolist(), len(made)]
            for rank, a, b in zip(made[cuts[:-1]].tolist(), cuts[:-1], cuts[1:], strict=True):
                places = index.get(rank)
                if places is None:
                    index[rank] = [at[a:b]]
                    heapq.heappush(due, rank)
                else:
                    places.append(at[a:b])

        makes[:-1] = self._made(symbols[:-1], symbols[1:])
        first = np.flatnonzero(makes >= 0)
        if first.size:
            enter(first, makes[first])
        while due:
            rank = heapq.heappop(due)
            places = index.pop(rank)
            at = places[0] if len(places) == 1 else np.concatenate(places)
            at = np.unique(at[makes[at] == rank])
            if not at.size:
                continue
            # in a run of overlapping places every other one merges, from the left
            new_run = np.concatenate([[True], after[at[:-1]] != at[1:]])
            if not new_run.all():
                place = np.arange(at.size)
                at = at[(place - np.maximum.accumulate(np.where(new_run, place, 0))) % 2 == 0]
            then = after[at]
            follow = after[then]
            symbols[at] = rank
            symbols[then] = -2
            makes[then] = -1
            after[at] = follow
            before[follow] = at  # a stop follows the last symbol of a piece
            touched = np.concatenate([before[at], at])
            touched = touched[touched >= 0]
            made = self._made(symbols[touched], symbols[after[touched]])
            makes[touched] = made
            real = made >= 0
            if real.any():
                enter(touched[real], made[real])
        live = symbols >= 0
        ids = symbols[live].tolist()
        ends = np.cumsum(live)[stops].tolist()
        return [ids[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]


def _segments(text: str) -> list:
    """The segments of a text; the first, which no space precedes, is told apart by its type."""
    parts: list = _CUT.split(text)
    parts[0] = parts[0].encode()
    return parts


class _SegmentEncoder:
    """Ids of segments by way of their distinct pieces."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.replay, self.find = MergeReplay(ranks), regex.compile(pattern).findall

    def __call__(self, segments: list) -> Iterable[list[int]]:
        pieces = [self.find(s.decode() if isinstance(s, bytes) else " " + s) for s in segments]
        distinct = list({p for found in pieces for p in found})
        ids = dict(zip(distinct, self.replay.encode([p.encode() for p in distinct]), strict=True))
        return ([i for p in found for i in ids[p]] for found in pieces)


def encode(
    docs: DataFrame, ranks: dict[bytes, int], pattern: str, *, text: str = "text", ids: str = "ids",
    keep: list[str] | None = None,
) -> DataFrame:
    """The columns ``keep`` (all but the text, unless named) and the token ids of each whole text.

    ``ids`` is an array of ints: each match of ``pattern`` is encoded by itself, without
    special tokens. Null counts as empty; an empty text has no ids. Rows are kept as they
    are, repeated ones too; a column already called ``ids`` raises ValueError. Very long
    texts are one row of a slice of their own. No exchange; a lost task is simply repeated.
    """
    keep = [c for c in docs.columns if c != text] if keep is None else keep
    schema = with_fields(docs, keep, **{ids: T.ArrayType(T.IntegerType())})
    fields = arrow_schema(schema)
    table = docs.sparkSession.sparkContext.broadcast(ranks)  # bounded by the vocabulary

    def start():
        store = SegmentStore(_SegmentEncoder(table.value, pattern))

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            found, offsets = store.ids_of(map(_segments, texts_of(batch, text)))
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(found, pa.int32()))
            return extended(batch, keep, {ids: lists}, fields)

        return work

    names = list(dict.fromkeys([*keep, text]))
    return map_slices(docs.select(*names), text, start, schema, 4 << 20)


def decode(
    rows: DataFrame, ranks: dict[bytes, int], *, ids: str = "ids", decoded: str = "decoded",
) -> DataFrame:
    """``rows`` with the bytes that the ids stand for in ``decoded`` (binary); null ids: null; no ids: no bytes.

    An id outside the vocabulary raises ValueError in the task.
    """
    columns = rows.columns
    schema = with_fields(rows, columns, **{decoded: T.BinaryType()})
    fields = arrow_schema(schema)
    table = rows.sparkSession.sparkContext.broadcast(ranks)

    def start():
        tokens = np.empty(max(table.value.values(), default=-1) + 1, dtype=object)
        for token, rank in table.value.items():
            tokens[rank] = token

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            column = batch.column(ids)
            own, sizes = column.flatten().to_numpy(zero_copy_only=False), pa.compute.list_value_length(column)
            if own.size and (own.min() < 0 or own.max() >= len(tokens)):
                raise ValueError(f"id outside the vocabulary: {own.min()} to {own.max()}")
            at, out = 0, []
            for size in sizes.to_pylist():
                out.append(None if size is None else b"".join(tokens[own[at:at + size]].tolist()))
                at += size or 0
            return extended(batch, columns, {decoded: pa.array(out, pa.binary())}, fields)

        return work

    return map_slices(rows, ids, start, schema, 4 << 20)

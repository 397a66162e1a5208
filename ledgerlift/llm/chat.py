"""Conversations as token sequences with a loss mask, assembled from token ids and read back from them.

A turn is ``<s>[INST]role[/INST]text</s>``. The four control strings are reserved ids that
are spliced between segments; role and text are encoded each by itself, so no token
reaches across a mark. Control strings that occur in a role or text are escaped by one
backslash after their first character, as are their escaped forms, so every text can be
read back. The mask follows from the segments' lengths by prefix sums.

Turns are dealt in ascending ranges of conversation and turn, so a conversation of any
size is spread over tasks; it comes in chunks, one unless it is long or crosses a border
of ranges. Memory is bounded by a batch and a chunk.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlift.llm.batches import arrow_schema, map_slices, slices, with_fields

MARKS = ["<s>", "[INST]", "[/INST]", "</s>"]
_ESCAPED = re.compile(r"(<(?=\\+/?s>)|\[(?=\\+/?INST\]))\\")
RANGE_ROWS = 8192
CHUNK_TOKENS = 32_768


def escaped(text: Column) -> Column:
    """The text with a backslash more in every control string, escaped or not; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"(<(?=\\*/?s>)|\[(?=\\*/?INST\]))", r"$1\\")


def unescaped(text: str) -> str:
    return _ESCAPED.sub(r"\1", text) if "\\" in text else text


def loss_mask(lengths: np.ndarray, learned: np.ndarray) -> np.ndarray:
    """True for the tokens of the learned segments: prefix sums of the lengths, then of the steps at their ends."""
    ends = np.cumsum(lengths)
    steps = np.zeros(int(ends[-1]) + 1 if len(ends) else 1, np.int64)
    np.add.at(steps, (ends - lengths)[learned], 1)
    np.add.at(steps, ends[learned], -1)
    return np.cumsum(steps)[:-1] > 0


def assemble(turns: list[tuple[list[int], list[int], bool]], first_mark: int) -> tuple[np.ndarray, np.ndarray]:
    """Token ids and loss mask of turns given as role ids, text ids and whether the text is learned."""
    begin, head, body, end = range(first_mark, first_mark + 4)
    parts, lengths, learned = [], [], []
    for role, text, learn in turns:
        parts += [[begin, head], role, [body], text, [end]]
        lengths += [2, len(role), 1, len(text), 1]
        learned += [False, False, False, learn, False]
    ids = np.fromiter((i for part in parts for i in part), np.int32, sum(lengths))
    return ids, loss_mask(np.array(lengths, np.int64), np.array(learned, bool))


def formatted(
    rows: DataFrame, ranks: dict[bytes, int], pattern: str, *, conversation: str = "conv_id", turn: str = "turn",
    role: str = "role", text: str = "text", learned_role: str = "assistant", range_rows: int = RANGE_ROWS,
    chunk_tokens: int = CHUNK_TOKENS,
) -> DataFrame:
    """(conversation, chunk, ids, loss): the chunks of a conversation ascend by ``chunk``.

    Turns ascend, a null turn first; equal turns go by role, then by a hash of the text,
    and repeated rows are turns of their own. Null roles and texts count as empty, and a
    null conversation is one like any other. Other columns are not read. No rows: no rows.
    """
    schema = T.StructType([
        T.StructField(conversation, rows.schema[conversation].dataType), T.StructField("chunk", T.LongType()),
        T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("loss", T.ArrayType(T.BooleanType()))])
    if len(set(schema.names)) < 4:
        raise ValueError(f"column already present: {conversation}")
    fields = arrow_schema(schema)
    table = rows.sparkSession.sparkContext.broadcast(ranks)  # bounded by the vocabulary
    turns = rows.select(
        F.col(conversation).alias("__conv"), F.col(turn).alias("__turn"), escaped(F.col(role)).alias("__role"),
        escaped(F.col(text)).alias("__text"), F.coalesce(F.col(role) == learned_role, F.lit(False)).alias("__learned"),
        F.xxhash64(text).alias("__hash"), F.monotonically_increasing_id().alias("__mark"))
    order = [F.col(c).asc_nulls_first() for c in ("__conv", "__turn", "__role", "__hash", "__mark")]
    ranges = max(1, -(-rows.count() // range_rows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken

        own = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=table.value, special_tokens={})
        roles: dict[str, list[int]] = {}
        number = TaskContext.get().partitionId() << 32
        at, waiting, tokens = None, [], 0

        def flushed(done: list[tuple]) -> pa.RecordBatch:
            conv, chunk, ids, loss = zip(*done, strict=True)
            offsets = pa.array(np.concatenate([[0], np.cumsum([len(i) for i in ids])]), pa.int32())
            return pa.RecordBatch.from_arrays([
                pa.array(conv, fields.field(0).type), pa.array(chunk, pa.int64()),
                pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(ids))).cast(fields.field(2).type),
                pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(loss))).cast(fields.field(3).type)], schema=fields)

        def cut() -> tuple:
            nonlocal number, waiting, tokens
            number += 1
            chunk = (at[0], number, *assemble(waiting, len(table.value)))
            waiting, tokens = [], 0
            return chunk

        for part in slices(batches, "__text"):
            done = []
            for conv, name, body, learn in zip(*(part.column(c).to_pylist() for c in ("__conv", "__role", "__text", "__learned")), strict=True):
                if waiting and (at != (conv,) or tokens >= chunk_tokens):
                    done.append(cut())
                at = (conv,)
                if name not in roles:
                    roles = {} if len(roles) > 1000 else roles
                    roles[name] = own.encode_ordinary(name)
                ids = own.encode_ordinary(body)
                waiting.append((roles[name], ids, learn))
                tokens += len(ids) + len(roles[name]) + 4
            if done:
                yield flushed(done)
        if waiting:
            yield flushed([cut()])
        pa.default_memory_pool().release_unused()

    dealt = turns.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    return dealt.select("__conv", "__role", "__text", "__learned").mapInArrow(run, schema)


def read_back(chunks: DataFrame, ranks: dict[bytes, int], *, conversation: str = "conv_id") -> DataFrame:
    """(conversation, chunk, turns, learned, n_chars) of formatted chunks, told from ids and mask alone.

    turns are (role, text) in order, learned the texts under the mask, both unescaped;
    n_chars counts the code points of the chunk with its marks. Null ids: no turns.
    """
    schema = with_fields(
        chunks.select(conversation, "chunk"), [conversation, "chunk"],
        turns=T.ArrayType(T.StructType([T.StructField("role", T.StringType()), T.StructField("text", T.StringType())])),
        learned=T.ArrayType(T.StringType()), n_chars=T.LongType())
    fields = arrow_schema(schema)
    table = chunks.sparkSession.sparkContext.broadcast(ranks)

    def start():
        first_mark = len(table.value)
        pieces = [b""] * first_mark + [m.encode() for m in MARKS]
        for piece, rank in table.value.items():
            pieces[rank] = piece
        begin, head, body, end = range(first_mark, first_mark + 4)

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            turns, learned, chars = [], [], []
            for ids, loss in zip(batch.column("ids"), batch.column("loss"), strict=True):
                ids = ids.values.to_numpy() if ids.is_valid else np.empty(0, np.int32)
                loss = loss.values.to_numpy(zero_copy_only=False) if loss.is_valid else np.empty(0, bool)

                def decoded(a: int, b: int, ids: np.ndarray = ids) -> str:
                    return b"".join(map(pieces.__getitem__, ids[a:b].tolist())).decode()

                heads, bodies, ends = (np.flatnonzero(ids == m) for m in (head, body, end))
                turns.append([
                    (unescaped(decoded(h + 1, b)), unescaped(decoded(b + 1, e)))
                    for h, b, e in zip(heads, bodies, ends, strict=True)])
                edges = np.flatnonzero(np.diff(np.concatenate([[False], loss, [False]]).astype(np.int8)))
                learned.append([unescaped(decoded(a, b)) for a, b in edges.reshape(-1, 2)])
                chars.append(len(decoded(0, len(ids))))
            made = [[dict(zip(("role", "text"), t, strict=True)) for t in row] for row in turns]
            arrays = [*(batch.column(c) for c in (conversation, "chunk")), pa.array(made, fields.field("turns").type),
                      pa.array(learned, fields.field("learned").type), pa.array(chars, pa.int64())]
            return pa.RecordBatch.from_arrays([a.cast(f.type) for a, f in zip(arrays, fields, strict=True)], schema=fields)

        return work

    sized = chunks.select(conversation, "chunk", "ids", "loss", F.array_join("ids", "").alias("__size"))
    return map_slices(sized, "__size", start, schema)


def digests(read: DataFrame, *, conversation: str = "conv_id") -> DataFrame:
    """(conversation, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars) of whole conversations.

    SHA-256 has no parts that could be joined, so the text of a conversation passes
    through one task, chunk by chunk and in order; no more than a batch is held.
    """
    schema = T.StructType([
        T.StructField(conversation, read.schema[conversation].dataType), T.StructField("n_turns", T.LongType()),
        T.StructField("turns_sha256", T.StringType()), T.StructField("loss_chars", T.LongType()),
        T.StructField("loss_sha256", T.StringType()), T.StructField("formatted_chars", T.LongType())])
    fields = arrow_schema(schema)
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    chunks = read.select(
        F.col(conversation).alias("__conv"), F.col("chunk"), F.size("turns").alias("n"), said.alias("said"),
        F.array_join("learned", "").alias("learned"), "n_chars")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, state = None, None
        for part in slices(batches, "said"):
            done = []
            rows = zip(*(part.column(c).to_pylist() for c in ("__conv", "n", "said", "learned", "n_chars")), strict=True)
            for (conv,), own in groupby(rows, key=lambda r: r[:1]):
                if at != (conv,):
                    if at:
                        done.append(finished(at[0], state))
                    at, state = (conv,), [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for _, n, said, learned, chars in own:
                    state[0] += n
                    state[1].update(said.encode())
                    state[2] += len(learned)
                    state[3].update(learned.encode())
                    state[4] += chars
            if done:
                yield pa.RecordBatch.from_pylist(done, schema=fields)
        if at:
            yield pa.RecordBatch.from_pylist([finished(at[0], state)], schema=fields)

    def finished(conv, state: list) -> dict:
        n, turns, chars, loss, formatted_chars = state
        return dict(zip(fields.names, (conv, n, turns.hexdigest(), chars, loss.hexdigest(), formatted_chars), strict=True))

    return chunks.repartition("__conv").sortWithinPartitions("__conv", "chunk").mapInArrow(run, schema)

"""Packing documents into token sequences by first-fit decreasing.

Documents become token ids, long ones are cut into pieces of the sequence length, and the
pieces are packed in randomised groups: inside a group, pieces go from long to short into
the first sequence with room, which a tournament tree over the rooms finds in
logarithmic time. Groups are packed independently, so memory is bounded by a group and
work is linear in the input; what is lost is at most one badly filled sequence a group.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlift.llm.batches import SLICE_BYTES, arrow_schema, map_slices, with_fields
from ledgerlift.llm.segments import SegmentStore


# letters that no normalizer of ``word_encoder`` changes: lower case, composed
LETTERS = "a-zß-öø-ÿ"
_JOINED = 2000  # words that are encoded as one text


def word_encoder(tokenizer: str):
    """The encoder of words of ``LETTERS`` alone, or None if the tokenizer may change or cut such a word.

    Where the normalizer only composes, lowers and evens out spaces, and the pre-tokenizer
    takes runs of letters as they are, such words need neither; what is left is the model.
    """
    told = json.loads(tokenizer)
    normal = told.get("normalizer") or {"type": "Sequence", "normalizers": []}
    steps = normal["normalizers"] if normal["type"] == "Sequence" else [normal]
    harmless = all(s["type"] in ("NFC", "Lowercase") or s == {
        "type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "} for s in steps)
    cutters = (told.get("pre_tokenizer") or {}).get("pretokenizers") or []
    split = {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
             "behavior": "Removed", "invert": True}
    whole = len(cutters) == 2 and cutters[0] == split and cutters[1]["type"] == "ByteLevel" and not (
        cutters[1]["add_prefix_space"] or cutters[1]["use_regex"])
    if not (harmless and whole) or any(t["content"].isalpha() for t in told.get("added_tokens") or []) or any(
            told.get(part) for part in ("truncation", "padding", "post_processor")):
        return None
    from tokenizers import Tokenizer

    return Tokenizer.from_str(json.dumps(told | {"normalizer": None, "pre_tokenizer": {
        "type": "Sequence", "pretokenizers": [{"type": "WhitespaceSplit"}, cutters[1]]}}))


def encoder(tokenizer: str):
    """segments -> (ids laid end to end, ids of each segment), without special tokens.

    Words of plain letters, nearly all segments, are encoded many at a time as one text; the
    others, and all of a tokenizer that ``word_encoder`` does not know, by themselves.
    """
    from tokenizers import Tokenizer

    own, words = Tokenizer.from_str(tokenizer), word_encoder(tokenizer)

    def one_by_one(segments: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids = [e.ids for e in own.encode_batch_fast(segments, add_special_tokens=False)]
        size = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter((i for part in ids for i in part), np.int32, int(size.sum())), size

    def encode(segments: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if words is None or not segments:
            return one_by_one(segments)
        plain = pc.match_substring_regex(pa.array(segments, pa.string()), f"^[{LETTERS}]+$").to_numpy(zero_copy_only=False)
        ids, size = [], np.zeros(len(segments), np.int64)
        at = np.flatnonzero(plain)
        for first in range(0, len(at), _JOINED):
            part = at[first:first + _JOINED]
            told = words.encode(" ".join([segments[i] for i in part]), add_special_tokens=False)
            ids.append(np.array(told.ids, np.int32))
            size[part] = np.bincount(np.array(told.word_ids, np.int64), minlength=len(part))
        rest = np.flatnonzero(~plain)
        found, size[rest] = one_by_one([segments[i] for i in rest])
        # back into the order of the segments
        flat, order = np.concatenate([*ids, found]), np.concatenate([at, rest])
        first = np.empty(len(segments), np.int64)
        first[order] = np.cumsum(size[order]) - size[order]
        ends = np.cumsum(size)
        return flat[np.repeat(first - (ends - size), size) + np.arange(len(flat))], size

    return encode


def _segments(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Stretches of the texts that are encoded by themselves: the distinct ones, their numbers in order, and how many a text has.

    Ids do not change where a space parts a letter from a mark that joins no letter, nor, where no
    mark may combine with a letter and no special token may arise, by lowering A-Z. So
    there are fewer distinct stretches than words with marks and case.
    """
    texts = pc.fill_null(texts, "")
    as_is = pc.or_(pc.match_substring(texts, "<|"), pc.match_substring_regex(texts, "[\u0300-\u036f]"))
    texts = pc.if_else(as_is, texts, pc.ascii_lower(texts))
    texts = pc.replace_substring(pc.replace_substring_regex(texts, f"([{LETTERS}])([.,;:!?*$%&#])", r"\1 \2"), "\n", " ")
    parts = pc.split_pattern(texts, " ")
    numbered = parts.flatten().dictionary_encode()
    return (numbered.dictionary.to_pylist(), numbered.indices.to_numpy(),
            pc.list_value_length(parts).to_numpy(zero_copy_only=False).astype(np.int64))


def tokenise(
    docs: DataFrame, tokenizer: str, *, text: str = "text", end: int | None = 2, capacity: int = 4096,
    keep: list[str] | None = None, slice_bytes: int = SLICE_BYTES,
) -> DataFrame:
    """Pieces of at most ``capacity`` token ids: columns ``keep``, start, length, doc_tokens, ids.

    ``tokenizer`` is the JSON of a `tokenizers` tokenizer that ignores spaces and line
    feeds between words, so words are encoded once a task; special tokens are not added.
    ``end`` is appended to each document; without it an empty document has no piece.
    start counts the document's ids before the piece. Null text counts as empty. A task
    encodes ``slice_bytes`` of text at a time and holds about 20 times that.
    """
    keep = [c for c in docs.columns if c != text] if keep is None else keep
    schema = with_fields(
        docs, keep, start=T.LongType(), length=T.LongType(), doc_tokens=T.LongType(),
        ids=T.ArrayType(T.IntegerType()))
    fields = arrow_schema(schema)
    table = docs.sparkSession.sparkContext.broadcast(tokenizer)  # bounded by the vocabulary

    def start():
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark gives a task one core
        store = SegmentStore(encoder(table.value))

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            found, offsets = store.ids_of_numbered(*_segments(batch.column(text)))
            if end is not None:
                found = np.insert(found, offsets[1:], end)
                offsets = offsets + np.arange(len(offsets))
            tokens = np.diff(offsets)
            pieces = -(-tokens // capacity)
            row = np.repeat(np.arange(len(tokens)), pieces)
            first = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            begin = first * capacity
            length = np.minimum(capacity, tokens[row] - begin)
            # pieces follow each other without gaps, so their lengths are the offsets of the lists
            lists = pa.ListArray.from_arrays(
                pa.array(np.concatenate([[0], np.cumsum(length)]), pa.int32()), pa.array(found, pa.int32()))
            columns = [batch.column(c).take(pa.array(row)) for c in keep]
            columns += [pa.array(begin), pa.array(length), pa.array(tokens[row]), lists]
            return pa.RecordBatch.from_arrays(
                [c.cast(f.type) for c, f in zip(columns, fields, strict=True)], schema=fields)

        return work

    names = list(dict.fromkeys([*keep, text]))
    return map_slices(docs.select(*names), text, start, schema, slice_bytes)


def first_fit_decreasing(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset in it for every item; sizes from 1 to ``capacity``.

    The tree's leaves are the rooms left in the bins, an inner node the larger of its two.
    Going left whenever the left room suffices finds the first bin that fits.
    """
    order = np.argsort(-sizes, kind="stable")
    leaves = 1 << max(0, int(len(sizes) - 1).bit_length())
    rooms = [capacity] * (2 * leaves)
    bins, offsets = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    for item in order.tolist():
        size = int(sizes[item])
        at = 1
        while at < leaves:
            at *= 2
            if rooms[at] < size:
                at += 1
        bins[item] = at - leaves
        offsets[item] = capacity - rooms[at]
        rooms[at] -= size
        while at > 1:
            at //= 2
            rooms[at] = max(rooms[2 * at], rooms[2 * at + 1])
    return bins, offsets


def assign(
    pieces: DataFrame, documents: int, *, key: str = "doc_id", capacity: int = 4096, group_docs: int = 4096,
) -> DataFrame:
    """``pieces`` with sequence_id and offset (gapless from 0 in each sequence).

    ``documents`` is the number of documents behind the pieces; groups hold about
    ``group_docs`` documents. Pieces are dealt to groups by a hash of the row's mark, so a
    very long document, and rows that share an id or have none, spread over all groups.
    Equal rows are packed once each. Pieces of one length go by key and start, a null key
    first, then by mark. No pieces: no rows; a column with a new name is an error.
    """
    groups = max(1, documents // group_docs)
    columns = pieces.columns
    schema = with_fields(pieces, columns, sequence_id=T.LongType(), offset=T.LongType())
    fields = arrow_schema(schema)

    def pack(rows: pa.Table) -> pa.Table:
        group = rows.column("__group")[0].as_py()
        rows = rows.take(pc.sort_indices(
            rows, sort_keys=[(key, "ascending"), ("start", "ascending"), ("__mark", "ascending")], null_placement="at_start"))
        bins, offsets = first_fit_decreasing(rows.column("length").to_numpy(), capacity)
        added = [pa.array(group << 32 | bins), pa.array(offsets)]
        arrays = [rows.column(c) for c in columns] + added
        return pa.Table.from_arrays([a.cast(f.type) for a, f in zip(arrays, fields, strict=True)], schema=fields)

    return (
        pieces.withColumn("__mark", F.monotonically_increasing_id())
        .withColumn("__group", F.pmod(F.xxhash64("__mark"), F.lit(groups)))
        .groupBy("__group").applyInArrow(pack, schema)
    )


def with_crc32(pieces: DataFrame, *, ids: str = "ids", name: str = "ids_crc32") -> DataFrame:
    """``pieces`` with the CRC-32 of the ids as little-endian unsigned 32-bit numbers; null ids: of no bytes."""
    schema = with_fields(pieces, pieces.columns, **{name: T.LongType()})
    fields = arrow_schema(schema)

    def run(batches):
        import zlib

        for batch in batches:
            column = batch.column(ids)
            values = column.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False)
            offsets = column.offsets.to_numpy()
            found = [zlib.crc32(values[a:b].tobytes()) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            arrays = [*batch.columns, pa.array(found, pa.int64())]
            yield pa.RecordBatch.from_arrays(
                [a.cast(f.type) for a, f in zip(arrays, fields, strict=True)], schema=fields)

    return pieces.mapInArrow(run, schema)

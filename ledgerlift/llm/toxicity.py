"""Toxicity scores by a factorization machine over hashed terms.

Terms are words and word beginnings, hashed into a fixed table. Beside a weight, each
term has a short vector; the inner products of the vectors of all pairs of terms enter the
score, so that two terms can weigh together what neither weighs alone. A text is scored in
passages of some hundred words, and its score is that of its most toxic passage, so that a
long text does not hide one. The machine is fitted in numpy on a bounded sample.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ledgerlift.llm.batches import arrow_schema, extended, map_slices, texts_of, with_fields
from ledgerlift.llm.samples import sampled_keys, sampled_texts
from ledgerlift.llm.segments import SegmentStore

PASSAGE = 64
LEAST_TERMS = 32  # shorter passages count as this long, so that few terms do not weigh too much
_WORD = re.compile(r"\w+")


@dataclass
class Machine:
    bias: float
    weights: np.ndarray  # a term
    vectors: np.ndarray  # terms x factors
    prior: float  # the share of toxic passages, which a text without terms gets


def terms_of(segment: str, buckets: int) -> list[int]:
    """Hashed terms of a stretch without white space: each word, and its beginning if it is longer."""
    out = []
    for word in _WORD.findall(segment):
        out.append(zlib.crc32(word.encode()) % buckets)
        if len(word) > 5:
            out.append(zlib.crc32(b"^" + word[:5].encode()) % buckets)
    return out


def passages(store: SegmentStore, texts: list[str], length: int = PASSAGE, overlap: bool = False):
    """Terms of all texts, the first term of each passage, and the text number of each passage.

    A text of n stretches gives ceil(n / length) passages of nearly equal length; an empty one gives one.
    With ``overlap`` there is one more from the middle of each passage to the middle of the
    next, so words that stand within half a passage of each other always meet in one.
    """
    owner: list[int] = []

    def cut():
        for number, t in enumerate(texts):
            found = t.lower().split()
            parts = max(1, -(-len(found) // length))
            edges = [len(found) * p // parts for p in range(parts + 1)]
            cuts = list(zip(edges[:-1], edges[1:], strict=True))
            if overlap:
                middles = [(a + b) // 2 for a, b in cuts]
                cuts += zip(middles[:-1], middles[1:], strict=True)
            for a, b in cuts:
                owner.append(number)
                yield list(dict.fromkeys(found[a:b]))  # once each, so repetition alone weighs nothing

    terms, offsets = store.ids_of(cut())
    return terms, offsets, np.array(owner, np.int64)


def _sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of the rows of each passage, also of passages without a row."""
    size = np.diff(offsets)
    out = np.zeros((len(size), *values.shape[1:]), np.float64)
    full = size > 0
    if full.any():
        out[full] = np.add.reduceat(values, offsets[:-1][full], axis=0, dtype=np.float64)
    return out


def logits(machine: Machine, terms: np.ndarray, offsets: np.ndarray, step: int = 8192) -> np.ndarray:
    """Of each passage; every different term counts 1/sqrt(number of terms). ``step`` passages are held at a time."""
    out = np.empty(len(offsets) - 1)
    for at in range(0, len(out), step):
        inside = offsets[at:at + step + 1]
        ids = terms[inside[0]:inside[-1]]
        inside = inside - inside[0]
        size = np.maximum(LEAST_TERMS, np.diff(inside))
        own = machine.vectors[ids]
        joint = _sums(own, inside)
        pairs = 0.5 * ((joint ** 2).sum(axis=1) - _sums((own ** 2).sum(axis=1), inside))
        out[at:at + step] = machine.bias + _sums(machine.weights[ids], inside) / np.sqrt(size) + pairs / size
    return out


def fit(
    terms: np.ndarray, offsets: np.ndarray, owner: np.ndarray, labels: np.ndarray, *, buckets: int, factors: int = 6,
    epochs: int = 10, batch: int = 128, rate: float = 6.0, caution: float = 1.0, least_texts: int = 3, seed: int = 11,
) -> Machine:
    """Train with Adagrad on passages; ``labels`` (0 or 1) are those of the texts, ``owner`` is a passage's text.

    Terms of fewer than ``least_texts`` toxic or clean texts together say too little and keep weight 0. ``caution`` is
    the squared gradient that every term is taken to have seen, which slows rare terms.
    The first epochs take every passage of a text for what the text is. Later ones take,
    of a toxic text, only the passages that score at least as high as half of it does.
    """
    rng = np.random.default_rng(seed)
    answer = labels[owner].astype(np.float64)
    prior = float(answer.mean()) if len(answer) else 0.0
    machine = Machine(
        float(np.log((prior + 1e-3) / (1 - prior + 1e-3))), np.zeros(buckets, np.float32),
        rng.normal(0, 0.02, (buckets, factors)).astype(np.float32), prior)
    if not len(answer):
        return machine
    sizes = np.diff(offsets)
    texts_with = np.zeros(buckets, np.int32)
    edges = np.searchsorted(owner, np.arange(len(labels) + 1))
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        texts_with[np.unique(terms[offsets[a]:offsets[b]])] += 1
    known = texts_with >= least_texts
    machine.vectors[~known] = 0
    seen_w = np.full(buckets, caution, np.float32)
    seen_v = np.full((buckets, factors), caution, np.float32)
    seen_b = 1.0
    batch = min(batch, max(16, len(answer) // 50))  # a small sample is seen more often and in smaller steps
    epochs = max(epochs, min(60, -(-1500 * batch // len(answer))))
    positive = np.where(answer > 0, min(10.0, (1 - prior) / max(prior, 1e-3)) ** 0.5, 1.0)
    for epoch in range(epochs):
        use = np.ones(len(answer), bool)
        if epoch >= epochs // 2:
            now = logits(machine, terms, offsets)
            best = np.full(len(labels), -np.inf)
            np.maximum.at(best, owner, now)
            use = (answer == 0) | (now >= best[owner] / 2) | (now == best[owner])
        order = rng.permutation(np.flatnonzero(use))
        for at in range(0, len(order), batch):
            own = order[at:at + batch]
            size = sizes[own]
            inside = np.concatenate([[0], np.cumsum(size)])
            rows = np.repeat(offsets[own] - inside[:-1], size) + np.arange(inside[-1])
            ids = terms[rows]
            n = np.maximum(LEAST_TERMS, size)
            vectors = machine.vectors[ids]
            joint = _sums(vectors, inside)
            pairs = 0.5 * ((joint ** 2).sum(axis=1) - _sums((vectors ** 2).sum(axis=1), inside))
            logit = machine.bias + _sums(machine.weights[ids], inside) / np.sqrt(n) + pairs / n
            error = (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - answer[own]) * positive[own]
            touched, place = np.unique(ids, return_inverse=True)
            passage = np.repeat(np.arange(len(own)), size)
            grad_w = np.bincount(place, (error / np.sqrt(n))[passage], len(touched)) * known[touched]
            pull = (error / n)[passage][:, None] * (joint[passage] - vectors)
            grad_v = np.stack([np.bincount(place, pull[:, f], len(touched)) for f in range(pull.shape[1])], axis=1)
            grad_v *= known[touched][:, None]
            seen_w[touched] += grad_w ** 2
            seen_v[touched] += grad_v ** 2
            seen_b += float(error.sum()) ** 2
            machine.weights[touched] -= (rate * grad_w / np.sqrt(seen_w[touched])).astype(np.float32)
            machine.vectors[touched] -= (rate * 0.2 * grad_v / np.sqrt(seen_v[touched])).astype(np.float32)
            machine.bias -= rate * 0.2 * float(error.sum()) / seen_b ** 0.5
    return machine


def train(
    docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", label: str = "toxic",
    per_label: int = 4000, buckets: int = 1 << 18, seed: int = 11,
) -> Machine:
    """Fit on at most ``per_label`` labelled texts of each label, taken by a hash of the key.

    The terms of those texts reach the driver. ``labels`` has key and label (0 or 1); null
    labels and labels without a text are left out. Without labels every text scores 0.
    """
    keys = sampled_keys(labels, key=key, label=label, per_label=per_label)
    chosen = sampled_texts(docs, keys, key=key, label=label, text=text, most=2 * per_label)
    schema = T.StructType([
        T.StructField("label", T.IntegerType()), T.StructField("size", T.ArrayType(T.IntegerType())),
        T.StructField("terms", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store = SegmentStore(lambda new: (terms_of(s, buckets) for s in new))
        for batch in batches:
            found, offsets, owner = passages(store, texts_of(batch, "text"))
            first = np.searchsorted(owner, np.arange(batch.num_rows + 1))
            sizes = [np.diff(offsets[a:b + 1]).tolist() for a, b in zip(first[:-1], first[1:], strict=True)]
            parts = [found[offsets[a]:offsets[b]].astype("<i4").tobytes() for a, b in zip(first[:-1], first[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int32()), pa.array(sizes, pa.list_(pa.int32())), pa.array(parts, pa.binary())],
                ["label", "size", "terms"])

    rows = chosen.mapInArrow(run, schema).toArrow().sort_by([("label", "ascending"), ("terms", "ascending")])
    sizes = rows.column("size").to_pylist()
    owner = np.repeat(np.arange(len(sizes)), [len(s) for s in sizes]).astype(np.int64)
    offsets = np.concatenate([[0], np.cumsum([n for s in sizes for n in s])]).astype(np.int64)
    terms = np.frombuffer(b"".join(rows.column("terms").to_pylist()), "<i4")
    marks = np.array(rows.column("label").to_pylist(), np.int64)
    return fit(terms, offsets, owner, marks, buckets=buckets, seed=seed)


def score(
    docs: DataFrame, machine: Machine, *, text: str = "text", keep: list[str] | None = None, name: str = "score",
) -> DataFrame:
    """The columns ``keep`` (all, unless named) and the toxicity of each whole text, 0 to 1.

    Null and empty texts get the score of a passage without terms. Repeated rows score alike.
    """
    keep = docs.columns if keep is None else keep
    schema = with_fields(docs, keep, **{name: T.DoubleType()})
    fields = arrow_schema(schema)
    table = docs.sparkSession.sparkContext.broadcast(
        (machine.bias, machine.weights, machine.vectors, machine.prior))  # bounded by buckets times factors

    def start():
        own = Machine(*table.value)
        buckets = len(own.weights)
        store = SegmentStore(lambda new: (terms_of(s, buckets) for s in new))

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            terms, offsets, owner = passages(store, texts_of(batch, text), overlap=True)
            best = np.full(batch.num_rows, -np.inf)
            np.maximum.at(best, owner, logits(own, terms, offsets))
            found = 1 / (1 + np.exp(-np.clip(best, -30, 30))) if own.prior > 0 else np.zeros(batch.num_rows)
            return extended(batch, keep, {name: pa.array(found)}, fields)

        return work

    return map_slices(docs.select(*dict.fromkeys([*keep, text])), text, start, schema)

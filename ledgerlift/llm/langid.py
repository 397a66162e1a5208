"""Language identification with a convolutional network over bytes, written in numpy.

A text is cut into windows of fixed length. Bytes are embedded, filters of several widths
run over each window, every filter's largest response is kept and a softmax layer names
the language. The network is fitted on the driver on a bounded sample of labelled texts;
all windows of all texts are then scored in batches, and a text's answer is the mean of
its windows' log-probabilities.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ledgerlift.llm.batches import arrow_schema, extended, map_slices, texts_of, with_fields
from ledgerlift.llm.samples import sampled_keys, sampled_texts

UNKNOWN = "und"


@dataclass
class Network:
    """Parameters; filters of all widths stand in one matrix, padded with zeros to the widest."""

    classes: list[str]
    window: int
    widths: tuple[int, ...]
    embedding: np.ndarray  # 257 x dims, the last row for padding
    filters: np.ndarray  # (widest * dims) x filters
    offset: np.ndarray
    weights: np.ndarray  # filters x classes
    bias: np.ndarray


def _mask(widths: tuple[int, ...], each: int, dims: int) -> np.ndarray:
    """1 where a filter of its width may have a weight."""
    mask = np.zeros((max(widths) * dims, each * len(widths)), np.float32)
    for n, width in enumerate(widths):
        mask[:width * dims, n * each:(n + 1) * each] = 1
    return mask


def windows_of(text: bytes, window: int) -> np.ndarray:
    """All bytes of the text as rows of ``window`` codes; the last row begins early rather than short, 256 pads."""
    codes = np.frombuffer(text, np.uint8).astype(np.int16)
    if len(codes) <= window:
        return np.concatenate([codes, np.full(window - len(codes), 256, np.int16)])[None]
    starts = np.minimum(np.arange(0, len(codes), window), len(codes) - window)
    return codes[starts[:, None] + np.arange(window)]


def _columns(net: Network, codes: np.ndarray) -> np.ndarray:
    """The embedded bytes under the widest filter at every place: windows x places x (widest * dims)."""
    widest, dims = max(net.widths), net.embedding.shape[1]
    padded = np.concatenate([codes, np.full((len(codes), widest - 1), 256, codes.dtype)], axis=1)
    embedded = net.embedding[padded].reshape(len(codes), -1)
    return np.lib.stride_tricks.sliding_window_view(embedded, widest * dims, axis=1)[:, ::dims]


def log_probabilities(net: Network, codes: np.ndarray) -> np.ndarray:
    """Of every class for every window."""
    out = []
    for at in range(0, len(codes), 256):
        columns = np.ascontiguousarray(_columns(net, codes[at:at + 256]))
        n, places, width = columns.shape
        best = (columns.reshape(-1, width) @ net.filters).reshape(n, places, -1).max(axis=1)
        logits = np.maximum(best + net.offset, 0) @ net.weights + net.bias
        logits -= logits.max(axis=1, keepdims=True)
        out.append(logits - np.log(np.exp(logits).sum(axis=1, keepdims=True)))
    return np.concatenate(out)


def fit(
    codes: np.ndarray, labels: np.ndarray, classes: list[str], *, widths: tuple[int, ...] = (2, 3, 4),
    each: int = 16, dims: int = 8, epochs: int = 6, batch: int = 32, rate: float = 3e-3, seed: int = 7,
) -> Network:
    """Train on windows and their class numbers with Adam."""
    rng = np.random.default_rng(seed)
    mask = _mask(widths, each, dims)
    filters = mask.shape[1]
    net = Network(
        classes, codes.shape[1], widths, rng.normal(0, 0.5, (257, dims)).astype(np.float32),
        (rng.normal(0, 0.3, mask.shape) * mask).astype(np.float32), np.zeros(filters, np.float32),
        rng.normal(0, 0.1, (filters, len(classes))).astype(np.float32), np.zeros(len(classes), np.float32))
    names = ["embedding", "filters", "offset", "weights", "bias"]
    first = {n: np.zeros_like(getattr(net, n)) for n in names}
    second = {n: np.zeros_like(getattr(net, n)) for n in names}
    share = np.bincount(labels, minlength=len(classes)) / max(1, len(labels))
    weight = (1 / np.maximum(share, 1e-9) / len(classes)).astype(np.float32)
    step = 0
    rounds = max(epochs, -(-1500 * batch // max(1, len(codes))))  # a small sample is seen more often
    for _ in range(min(rounds, 60)):
        order = rng.permutation(len(codes))
        for at in range(0, len(order), batch):
            own = order[at:at + batch]
            columns = np.ascontiguousarray(_columns(net, codes[own]))
            n, places, width = columns.shape
            found = (columns.reshape(-1, width) @ net.filters).reshape(n, places, filters)
            place = found.argmax(axis=1)
            best = np.take_along_axis(found, place[:, None], axis=1)[:, 0] + net.offset
            hidden = np.maximum(best, 0)
            logits = hidden @ net.weights + net.bias
            odds = np.exp(logits - logits.max(axis=1, keepdims=True))
            odds /= odds.sum(axis=1, keepdims=True)
            odds[np.arange(n), labels[own]] -= 1
            odds *= weight[labels[own]][:, None] / n
            back = (odds @ net.weights.T) * (best > 0)
            picked = columns[np.arange(n)[:, None], place]  # windows x filters x (widest * dims)
            grads = {
                "weights": hidden.T @ odds, "bias": odds.sum(axis=0), "offset": back.sum(axis=0),
                "filters": np.einsum("nfw,nf->wf", picked, back) * mask}
            padded = np.concatenate([codes[own], np.full((n, max(widths) - 1), 256, codes.dtype)], axis=1)
            spread = back[:, :, None] * net.filters.T[None]
            touched = padded[np.arange(n)[:, None, None], place[:, :, None] + np.arange(max(widths))]
            embedding = np.zeros_like(net.embedding)
            np.add.at(embedding, touched.reshape(-1), spread.reshape(-1, net.embedding.shape[1]))
            grads["embedding"] = embedding
            step += 1
            for name in names:
                g = grads[name].astype(np.float32)
                first[name] += 0.1 * (g - first[name])
                second[name] += 0.001 * (g * g - second[name])
                move = first[name] / (1 - 0.9 ** step) / (np.sqrt(second[name] / (1 - 0.999 ** step)) + 1e-8)
                setattr(net, name, getattr(net, name) - np.float32(rate) * move)
    return net


def train(
    docs: DataFrame, *, text: str = "text", label: str = "lang", key: str = "doc_id", per_label: int = 1500,
    most: int = 50_000, windows_each: int = 4, window: int = 192, seed: int = 7,
) -> Network:
    """Fit on at most ``per_label`` texts of each label, ``most`` in all, and ``windows_each`` windows of each.

    These parameters bound what reaches the driver. Null labels are left out. Without any
    labelled text that has a letter the network knows no class.
    """
    keys = sampled_keys(docs, key=key, label=label, per_label=per_label)
    chosen = sampled_texts(docs, keys, key=key, label=label, text=text, most=most)
    kind = T.StructType([T.StructField("label", T.StringType()), T.StructField("codes", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels, codes = [], []
            for name, t in zip(batch.column(0).to_pylist(), texts_of(batch, "text"), strict=True):
                if not any(map(str.isalpha, t)):
                    continue
                rows = windows_of(t.encode(), window)
                pick = np.unique(np.linspace(0, len(rows) - 1, min(len(rows), windows_each)).astype(int))
                labels += [name] * len(pick)
                codes += [r.tobytes() for r in rows[pick]]
            yield pa.RecordBatch.from_arrays([pa.array(labels, pa.string()), pa.array(codes, pa.binary())], ["label", "codes"])

    rows = chosen.mapInArrow(run, kind).toArrow()
    rows = rows.sort_by([("label", "ascending"), ("codes", "ascending")])  # the fit does not depend on task order
    names = rows.column(0).to_pylist()
    classes = sorted(set(names))
    codes = np.array([np.frombuffer(c, np.int16) for c in rows.column(1).to_pylist()], np.int16).reshape(-1, window)
    numbers = {c: n for n, c in enumerate(classes)}
    return fit(codes, np.array([numbers[n] for n in names], np.int64), classes, seed=seed)


def predict(
    docs: DataFrame, net: Network, *, text: str = "text", keep: list[str] | None = None,
    name: str = "lang_pred", score: str = "score",
) -> DataFrame:
    """The columns ``keep`` (all, unless named) with the likeliest class of each whole text and its probability.

    A text that is null or has no letter is ``und`` with score 0, as is any text if the
    network knows no class. Repeated rows are scored alike; clashing names raise ValueError.
    """
    keep = docs.columns if keep is None else keep
    schema = with_fields(docs, keep, **{name: T.StringType(), score: T.DoubleType()})
    fields = arrow_schema(schema)

    def start():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = texts_of(batch, text)
            names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
            rows, counts, held = [], [], []

            def score_held() -> None:
                if not held:
                    return
                found = np.add.reduceat(
                    log_probabilities(net, np.concatenate(rows)), np.cumsum([0, *counts[:-1]]), axis=0)
                mean = found / np.array(counts)[:, None]
                odds = np.exp(mean - mean.max(axis=1, keepdims=True))
                odds /= odds.sum(axis=1, keepdims=True)
                for n, own in zip(held, odds, strict=True):
                    best = int(own.argmax())
                    names[n], scores[n] = net.classes[best], float(own[best])
                rows.clear(), counts.clear(), held.clear()

            for n, t in enumerate(texts):
                if net.classes and any(map(str.isalpha, t)):
                    own = windows_of(t.encode(), net.window)
                    rows.append(own), counts.append(len(own)), held.append(n)
                    if sum(map(len, rows[-256:])) > 8192 or len(rows) >= 256:
                        score_held()
            score_held()
            return extended(batch, keep, {name: names, score: scores}, fields)

        return work

    return map_slices(docs.select(*dict.fromkeys([*keep, text])), text, start, schema)


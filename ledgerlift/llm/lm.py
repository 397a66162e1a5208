"""Language-model scores of documents with a log-bilinear neural model, written in numpy.

Two things are learnt, both from every training token. Word counts are a distributed
aggregation over the corpus. The neural model predicts the class of the next word from
the two words before it: each position has vectors of its own, their sum meets the vector
of the next class, and noise-contrastive estimation spares the normaliser in training.
The frequent words are classes of their own; all others share classes by their ending,
inside which a word has its add-one share. Tasks train on the tokens they hold from one
common start, and their parameters are averaged by token counts, so what is gathered
grows with the corpus while a model stays small.

Scoring computes the softmax over all classes in batches, once for every different pair
of context words in a slice, and so gives normalised probabilities. Words beyond the most
frequent ones are looked up by a join with the counts, never by a broadcast of them all.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlift.llm.batches import arrow_schema, extended, slices, texts_of, with_fields
from ledgerlift.sources.stages import stage

END = b" "  # no word holds a space
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


@dataclass
class Settings:
    known_words: int = 200_000  # bounds what is broadcast
    own_classes: int = 960
    shared_classes: int = 64
    factors: int = 32
    batch: int = 4096
    noise: int = 32
    noise_weight: float = 10.0
    rate: float = 0.1
    rounds: int = 1
    seed: int = 5

    @property
    def classes(self) -> int:
        return self.own_classes + self.shared_classes


def words_of(text: str) -> list[bytes]:
    """Words with A-Z lowered, split at the six ASCII white-space bytes; without the end."""
    return text.encode().translate(_LOWER).split()


def shared_class(word: bytes, own: int, shared: int) -> int:
    """The class of a word without one of its own, by its last three bytes."""
    return own + zlib.crc32(word[-3:]) % shared


def count_words(docs: DataFrame, *, text: str = "text") -> DataFrame:
    """(word, n): how often each word and the end occur; null text is an end alone."""
    schema = T.StructType([T.StructField("word", T.BinaryType()), T.StructField("n", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def told(seen: Counter) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(list(seen.keys()), pa.binary()), pa.array(list(seen.values()), pa.int64())], ["word", "n"])

        seen: Counter = Counter()
        for batch in slices(batches, text, 4 << 20):
            for t in texts_of(batch, text):
                seen.update(words_of(t))
            seen[END] += batch.num_rows
            if len(seen) > 300_000:
                yield told(seen)
                seen.clear()
        if seen:
            yield told(seen)
        pa.default_memory_pool().release_unused()

    return docs.select(text).mapInArrow(run, schema).groupBy("word").agg(F.sum("n").alias("n"))


class Vocabulary:
    """The known words' numbers and counts; classes of all words."""

    def __init__(self, words: list[bytes], counts: list[int], settings: Settings):
        self.settings = settings
        self.number = {w: n for n, w in enumerate(words)}
        self.counts = np.array([*counts, 0], np.float64)  # the last stands for any other word
        own, shared = settings.own_classes, settings.shared_classes
        self.end = self.number.get(END, len(words))
        self.classes = np.array(
            [n if n < own else shared_class(w, own, shared) for n, w in enumerate(words)] + [-1], np.int32)
        if self.end == len(words):
            self.classes[-1] = -1

    def read(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[list[bytes]]]:
        """Numbers and classes of all tokens, the offset of each text, and each text's words that are not known."""
        get, other = self.number.get, len(self.number)
        own, shared = self.settings.own_classes, self.settings.shared_classes
        numbers, classes, rest, offsets = [], [], [], [0]
        for t in texts:
            words = words_of(t)
            words.append(END)
            at = list(map(get, words))
            unknown = []
            if None in at:
                places = [n for n, a in enumerate(at) if a is None]
                unknown = [words[n] for n in places]
                for n in places:
                    at[n] = other
            found = np.array(at, np.int32)
            kinds = self.classes[found]
            if unknown:
                kinds[found == other] = [shared_class(w, own, shared) for w in unknown]
            numbers.append(found)
            classes.append(kinds)
            rest.append([w for w in unknown if w != END])
            offsets.append(offsets[-1] + len(at))
        return np.concatenate(numbers), np.concatenate(classes), np.array(offsets, np.int64), rest


def _contexts(classes: np.ndarray, offsets: np.ndarray, start: int) -> tuple[np.ndarray, np.ndarray]:
    """The class before each token and the one before that; before a text stands ``start``."""
    one, two = np.empty_like(classes), np.empty_like(classes)
    one[1:], two[2:] = classes[:-1], classes[:-2]
    one[offsets[:-1]] = start
    two[offsets[:-1]] = start
    second = offsets[:-1] + 1
    two[second[second < offsets[1:]]] = start
    return one, two


@dataclass
class Model:
    """Vectors of the two context positions and of the classes, and class biases."""

    before: np.ndarray
    earlier: np.ndarray
    target: np.ndarray
    bias: np.ndarray

    def flat(self) -> np.ndarray:
        return np.concatenate([a.ravel() for a in (self.before, self.earlier, self.target, self.bias)])

    @staticmethod
    def shaped(flat: np.ndarray, classes: int, factors: int) -> Model:
        size = classes * factors
        parts = [flat[n * size:(n + 1) * size].reshape(classes, factors).astype(np.float32) for n in range(3)]
        return Model(*parts, flat[3 * size:].astype(np.float32))


def initial(shares: np.ndarray, settings: Settings) -> Model:
    """Small vectors and the classes' shares as biases: to begin with, each class has its share."""
    rng = np.random.default_rng(settings.seed)
    vectors = [rng.normal(0, 0.1, (settings.classes, settings.factors)).astype(np.float32) for _ in range(3)]
    return Model(*vectors, np.log(shares).astype(np.float32))


class Trainer:
    """Noise-contrastive estimation with Adagrad; a batch shares its noise classes."""

    def __init__(self, model: Model, shares: np.ndarray, settings: Settings, seed: int):
        self.model, self.settings = model, settings
        self.rng = np.random.default_rng(seed)
        self.cumulated = np.cumsum(shares)
        self.level = np.log(settings.noise_weight * shares).astype(np.float32)
        self.seen = [np.full_like(a, 0.1) for a in (model.before, model.earlier, model.target, model.bias)]

    def _move(self, rows: np.ndarray, *moves: tuple[int, np.ndarray]) -> None:
        """Add up the gradients of equal rows and take an Adagrad step, for each (parameter, gradients)."""
        order = rows.astype(np.uint16).argsort(kind="stable")
        rows = rows[order]
        first = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]]))
        rows = rows[first]
        for which, grads in moves:
            total = np.add.reduceat(grads[order], first, axis=0)
            values = (self.model.before, self.model.earlier, self.model.target, self.model.bias)[which]
            self.seen[which][rows] += total ** 2
            values[rows] -= self.settings.rate * total / np.sqrt(self.seen[which][rows])

    def step(self, one: np.ndarray, two: np.ndarray, word: np.ndarray) -> None:
        m, s = self.model, self.settings
        n = len(word)
        noise = np.minimum(np.searchsorted(self.cumulated, self.rng.random(s.noise)), s.classes - 1)
        context = m.before[one] + m.earlier[two]
        own = m.target[word]
        real = 1 / (1 + np.exp(-np.clip((context * own).sum(axis=1) + m.bias[word] - self.level[word], -30, 30))) - 1
        false = context @ m.target[noise].T + (m.bias[noise] - self.level[noise])
        false = (s.noise_weight / s.noise) / (1 + np.exp(-np.clip(false, -30, 30)))
        real, false = (real * (64 / n)).astype(np.float32), (false * (64 / n)).astype(np.float32)
        back = real[:, None] * own + false @ m.target[noise]
        self._move(
            np.concatenate([word, noise]), (2, np.concatenate([real[:, None] * context, false.T @ context])),
            (3, np.concatenate([real, false.sum(axis=0)])))
        self._move(one, (0, back))
        self._move(two, (1, back))


def _train_round(docs: DataFrame, text: str, table, model: Model, shares: np.ndarray, settings: Settings) -> Model:
    """Every task trains on all its tokens from ``model``; the mean of the tasks' parameters, by tokens."""
    blocks = 16
    schema = T.StructType([
        T.StructField("block", T.IntegerType()), T.StructField("weight", T.DoubleType()),
        T.StructField("values", T.BinaryType())])
    sizes = (settings.classes, settings.factors)
    start = docs.sparkSession.sparkContext.broadcast((model.flat(), shares))  # bounded by classes times factors

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Vocabulary(*table.value, settings)
        flat, own_shares = start.value
        trainer = Trainer(
            Model.shaped(flat.copy(), *sizes), own_shares, settings, settings.seed + TaskContext.get().partitionId())
        tokens = 0
        for batch in slices(batches, text, 4 << 20):
            _, classes, offsets, _ = words.read(texts_of(batch, text))
            one, two = _contexts(classes, offsets, int(words.classes[words.end]))
            order = trainer.rng.permutation(len(classes))
            for at in range(0, len(order), settings.batch):
                own = order[at:at + settings.batch]
                trainer.step(one[own], two[own], classes[own])
            tokens += len(classes)
        if tokens:
            for number, part in enumerate(np.array_split(trainer.model.flat().astype(np.float64) * tokens, blocks)):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number], pa.int32()), pa.array([float(tokens)]), pa.array([part.tobytes()], pa.binary())],
                    ["block", "weight", "values"])
        pa.default_memory_pool().release_unused()

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, list] = {}
        for batch in batches:
            for block, weight, values in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                have = sums.setdefault(block, [0.0, 0.0])
                have[0] += weight
                have[1] = have[1] + np.frombuffer(values)
        for block, (weight, values) in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([block], pa.int32()), pa.array([weight]), pa.array([values.tobytes()], pa.binary())],
                ["block", "weight", "values"])

    parts = docs.select(text).mapInArrow(train, schema).repartition(blocks, "block").mapInArrow(added, schema)
    rows = parts.toArrow().sort_by("block")
    if not rows.num_rows:
        return model
    weight = rows.column("weight")[0].as_py()
    flat = np.concatenate([np.frombuffer(v) for v in rows.column("values").to_pylist()]) / weight
    return Model.shaped(flat, *sizes)


class ClassScores:
    """log10 of the normalised probabilities of classes; the softmax of a context is computed when it first occurs."""

    def __init__(self, model: Model):
        self.model = model
        self.level = np.full(len(model.bias) ** 2, np.nan, np.float32)  # a few MB for the usual classes

    def __call__(self, one: np.ndarray, two: np.ndarray, word: np.ndarray) -> np.ndarray:
        m, count = self.model, len(self.model.bias)
        out = np.empty(len(word), np.float32)
        for at in range(0, len(word), 1 << 16):
            own = slice(at, at + (1 << 16))
            pairs = one[own].astype(np.int64) * count + two[own]
            new = np.unique(pairs[np.isnan(self.level[pairs])])
            for first in range(0, len(new), 2048):
                part = new[first:first + 2048]
                logits = (m.before[part // count] + m.earlier[part % count]) @ m.target.T
                logits += m.bias
                most = logits.max(axis=1)
                logits -= most[:, None]
                np.exp(logits, out=logits)
                self.level[part] = most + np.log(logits.sum(axis=1))
            context = m.before[one[own]] + m.earlier[two[own]]
            out[own] = np.einsum("nf,nf->n", context, m.target[word[own]]) + m.bias[word[own]] - self.level[pairs]
        return out / np.float32(np.log(10))


def class_log10(model: Model, one: np.ndarray, two: np.ndarray, word: np.ndarray) -> np.ndarray:
    """log10 of the normalised probability of each token's class, by one softmax for each different context."""
    return ClassScores(model)(one, two, word)


def score(
    docs: DataFrame, training: Column, *, text: str = "text", keep: list[str] | None = None,
    settings: Settings | None = None,
) -> DataFrame:
    """The columns ``keep`` with n_tokens, n_known, train_tokens, base_score and score of each whole text.

    Rows where ``training`` holds are learnt from, all rows are scored. base_score is the
    add-one score of single words, score the model's; both are log10 and count the end.
    Null text is an end alone. Without training rows every word is as likely as any other
    class allows and base_score is 0. Repeated rows count and score each. A column with a
    new name is an error. The model depends on how the table is split, as every task trains
    on its own rows from one start.
    """
    settings = settings or Settings()
    keep = [c for c in docs.columns if c != text] if keep is None else keep
    with_fields(docs, keep, n_tokens=T.LongType(), n_known=T.LongType(), train_tokens=T.LongType(), base_score=T.DoubleType(),
                score=T.DoubleType())
    learnt = docs.filter(training).select(text)
    counts = stage(count_words(learnt, text=text), "lm-counts")
    total, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    first = counts.orderBy(F.col("word") != F.lit(bytearray(END)), F.desc("n"), "word").limit(settings.known_words).toArrow()
    words, known = first.column("word").to_pylist(), first.column("n").to_pylist()
    own, shared = settings.own_classes, settings.shared_classes

    def by_class(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((shared, 2), np.int64)
        for batch in batches:
            kinds = [shared_class(w, 0, shared) for w in batch.column(0).to_pylist()]
            n = batch.column(1).to_numpy(zero_copy_only=False)
            sums[:, 0] += np.bincount(kinds, n, shared).astype(np.int64)
            sums[:, 1] += np.bincount(kinds, minlength=shared)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(shared)), *map(pa.array, sums.T)], ["kind", "n", "v"])

    totals = np.zeros((shared, 2), np.int64)
    for r in counts.mapInArrow(by_class, "kind long, n long, v long").groupBy("kind").agg(F.sum("n"), F.sum("v")).collect():
        totals[r[0]] = r[1], r[2]
    for w, n in zip(words[:own], known[:own], strict=True):  # words with a class of their own leave the shared ones
        totals[shared_class(w, 0, shared)] -= n, 1
    room = totals[:, 0] + totals[:, 1] + 1.0  # add-one, and one for all words never seen
    shares = np.concatenate([np.array(known[:own] + [0] * (own - len(known[:own])), float), totals[:, 0]]) + 0.5
    shares /= shares.sum()
    table = docs.sparkSession.sparkContext.broadcast((words, known))  # bounded by known_words
    model = initial(shares, settings)
    for _ in range(settings.rounds if total else 0):
        model = _train_round(learnt, text, table, model, shares, settings)
    parts = stage(_local_scores(docs, text, keep, table, model, room, settings), "lm-scores")
    rest = (
        parts.select("__row", F.explode("__rest").alias("__word")).groupBy("__row", "__word").agg(F.count(F.lit(1)).alias("__tf"))
        .join(counts, F.col("__word") == counts["word"])
        .groupBy("__row").agg(F.sum("__tf").alias("__known"), F.sum(F.col("__tf") * F.log10(F.col("n") + 1)).alias("__log")))
    level = float(np.log10(total + distinct + 1))
    log = F.coalesce("__log", F.lit(0.0))
    return parts.join(rest, "__row", "left").select(
        *keep, "n_tokens", (F.col("__n_known") + F.coalesce("__known", F.lit(0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("__base") + log - F.col("n_tokens") * level).alias("base_score"),
        (F.col("__model") + log).alias("score"))


def _local_scores(
    docs: DataFrame, text: str, keep: list[str], table, model: Model, room: np.ndarray, settings: Settings,
) -> DataFrame:
    """What a task can tell of its texts, and the words of each that it does not know."""
    schema = with_fields(
        docs, keep, __row=T.LongType(), n_tokens=T.LongType(), __n_known=T.LongType(), __base=T.DoubleType(),
        __model=T.DoubleType(), __rest=T.ArrayType(T.BinaryType()))
    fields = arrow_schema(schema)
    sizes = (settings.classes, settings.factors)
    parameters = docs.sparkSession.sparkContext.broadcast((model.flat(), room))  # bounded by classes times factors

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Vocabulary(*table.value, settings)
        flat, own_room = parameters.value
        class_scores = ClassScores(Model.shaped(flat, *sizes))
        row = TaskContext.get().partitionId() << 36  # rows are written once, so their numbers stay
        logs = np.log10(words.counts + 1)
        inside = np.zeros(settings.classes)
        inside[settings.own_classes:] = np.log10(own_room)
        for batch in slices(batches, text, 4 << 20):
            numbers, classes, offsets, rest = words.read(texts_of(batch, text))
            classes = np.where(classes < 0, settings.own_classes, classes)
            one, two = _contexts(classes, offsets, int(max(0, words.classes[words.end])))
            own = class_scores(one, two, classes) - inside[classes]
            own += np.where(classes >= settings.own_classes, logs[numbers], 0)
            yield extended(batch, keep, {
                "__row": row + np.arange(batch.num_rows), "n_tokens": np.diff(offsets),
                "__n_known": np.add.reduceat((words.counts[numbers] > 0).astype(np.int64), offsets[:-1]),
                "__base": np.add.reduceat(logs[numbers], offsets[:-1]), "__model": np.add.reduceat(own, offsets[:-1]),
                "__rest": rest}, fields)
            row += batch.num_rows
        pa.default_memory_pool().release_unused()

    return docs.select(*dict.fromkeys([*keep, text])).mapInArrow(run, schema)

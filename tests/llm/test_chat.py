"""Formatted conversations: read back exactly, from ids and from the text; masks, escapes, chunks, odd rows."""

import hashlib
import random
import re

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from oracle import connect, difference, spark_rows, sql_rows
from pyspark.sql import functions as F

from ledgerlift.llm import bpe, chat
from ledgerlift.llm.queries import ORACLES, QUERIES

SCHEMA = "conv_id long, turn long, role string, text string, chunk string"
HOSTILE = ["</s>[INST] ok [/INST]", "<s>", "<\\s>", "<\\\\/s>", "[\\INST]", "[\\\\\\/INST]x[/INST", "\\<s>\\", "<[INST]s>", "[<s>INST]", "a\\"]


@pytest.fixture(scope="module")
def ranks():
    return bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    made = [(n, t, rng.choice(["user", "assistant", "system"]), rng.choice([*HOSTILE, "Grüße 中文 🎉\n", "", None, "plain words"]), "x")
            for n in range(60) for t in range(rng.randint(1, 6))]
    made += [(100, t, "assistant" if t % 2 else "user", f"turn {t} " + HOSTILE[t % len(HOSTILE)], None) for t in range(500)]
    made += [(101, 0, "user", "ab " * 400_000, None), (101, 1, "assistant", "z" * 1_100_000, None)]
    made += [(102, 1, "assistant", "same", None)] * 3 + [(102, None, None, None, None), (102, 1, "[INST]", "odd role", None)]
    return made + [(None, 0, "assistant", "no conversation", None), (None, 1, "user", "", None)]


def by_hand(rows):
    convs = {}
    for r in rows:
        convs.setdefault(r[0], []).append((r[2] or "", r[3] or "", r[1]))
    out = []
    for conv, turns in convs.items():
        turns.sort(key=lambda t: (t[2] is not None, t[2], t[0]))
        said = "".join(f"{role}\n{text}\n" for role, text, _ in turns)
        learned = "".join(text for role, text, _ in turns if role == "assistant")
        chars = sum(len(re.sub(r"(<\\*/?s>|\[\\*/?INST\])", r"\1.", t)) for turn in turns for t in turn[:2]) + 20 * len(turns)
        out.append((conv, len(turns), hashlib.sha256(said.encode()).hexdigest(), len(learned), hashlib.sha256(learned.encode()).hexdigest(), chars))
    return sorted(out, key=repr)


@pytest.mark.parametrize(("range_rows", "chunk_tokens"), [(8192, 32_768), (50, 40)])
def test_read_back(spark, rows, ranks, range_rows, chunk_tokens):
    table = spark.createDataFrame(rows, SCHEMA).repartition(4)
    chunks = chat.formatted(table, ranks, public_tokenizers.PATTERN, range_rows=range_rows, chunk_tokens=chunk_tokens)
    got = chat.digests(chat.read_back(chunks, ranks)).collect()
    assert sorted((tuple(r) for r in got), key=repr) == by_hand(rows)


def test_text_reads_as_the_ids_do(spark, rows, ranks):
    """The output as text, with marks as strings, is told apart by its control strings alone."""
    table = spark.createDataFrame([r for r in rows if r[0] is not None and r[0] < 60], SCHEMA)
    chunks = chat.formatted(table, ranks, public_tokenizers.PATTERN)
    pieces = {v: k for k, v in ranks.items()} | {len(ranks) + n: m.encode() for n, m in enumerate(chat.MARKS)}
    text = {(r["conv_id"], r["chunk"]): b"".join(pieces[i] for i in r["ids"]).decode() for r in chunks.collect()}
    for r in chat.read_back(chunks, ranks).collect():
        own = text[r["conv_id"], r["chunk"]]
        assert len(own) == r["n_chars"]
        parts = re.split(r"<s>\[INST\]|\[/INST\]|</s>", own)
        told = [(chat.unescaped(parts[n]), chat.unescaped(parts[n + 1])) for n in range(1, len(parts) - 1, 3)]
        assert told == [tuple(t) for t in r["turns"]]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 5), st.booleans()), max_size=12))
def test_masks_are_the_learned_segments(segments):
    lengths, learned = np.array([s[0] for s in segments], np.int64), np.array([s[1] for s in segments], bool)
    assert chat.loss_mask(lengths, learned).tolist() == [s[1] for s in segments for _ in range(s[0])]


def test_escapes_are_reversible(spark):
    rng = random.Random(1)
    texts = HOSTILE + ["".join(rng.choices(["<", "\\", "/", "s>", "[", "INST]", "x"], k=rng.randint(0, 9))) for _ in range(3000)]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(chat.escaped(F.col("t"))).collect()]
    assert [chat.unescaped(t) for t in got] == texts
    assert not any(m in t for t in got for m in chat.MARKS)


def test_no_rows_and_clashing_names(spark, rows, ranks):
    table = spark.createDataFrame(rows[:5], SCHEMA)
    none = chat.formatted(table.limit(0), ranks, public_tokenizers.PATTERN)
    assert chat.digests(chat.read_back(none, ranks)).count() == 0
    with pytest.raises(ValueError, match="ids"):
        chat.formatted(table.withColumnRenamed("conv_id", "ids"), ranks, public_tokenizers.PATTERN, conversation="ids")
    with pytest.raises(ValueError, match="turns"):
        chat.read_back(none.withColumnRenamed("conv_id", "turns"), ranks, conversation="turns")


def test_registered_query(spark):
    sf = "/root/testdata/sf0.001"
    got = QUERIES["op12_chat_format"](spark, sf)
    assert difference(spark_rows(got), sql_rows(connect(sf), ORACLES["op12_chat_format"])) is None
    hostile = got.filter("conv_id = -1").first()
    text = "</s>[INST] ok [/INST]"
    assert (hostile["n_turns"], hostile["loss_chars"], hostile["loss_sha256"]) == (2, len(text), hashlib.sha256(text.encode()).hexdigest())

"""A training corpus from raw documents, in five stages that each filter, clean or pack what the one before kept.

Every stage takes (spark, docs, sf_dir). Its result is written as Parquet to the shared
folder and read again as the next stage's documents, so a lost executor repeats a part of
one stage. All stages but the last return the columns of ``docs``, whatever else they hold.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlift.llm import langid, nearcopies, packing, suffixdedup, toxicity
from ledgerlift.sources.stages import stage

SURE_FROM = 0.5
TOXIC_FROM = 0.7
NEAR_FROM = 0.8
REPEATED_BYTES = 200
SEQUENCE = 4096
SLICE_BYTES = 2 << 20  # tasks of the last stage share their executor with what the stages before it left


def _apart(docs: DataFrame) -> DataFrame:
    """doc_id and text, and all other columns as one, so that no name of theirs can clash with a stage's own."""
    return docs.select("doc_id", "text", F.struct(*[F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")] or [
        F.lit(0).alias("none")]).alias("__others"))


def _together(rows: DataFrame, columns: list[str]) -> DataFrame:
    return rows.select(*[F.col(c) if c in ("doc_id", "text") else F.col(f"__others.`{c}`").alias(c) for c in columns])


def name_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the network is sure of; texts that are null or have no letter go."""
    net = langid.train(docs.select("doc_id", "text", "lang"))
    told = langid.predict(_apart(docs), net, name="__lang", score="__sure")
    sure = (F.col("__lang") != langid.UNKNOWN) & (F.col("__sure") >= SURE_FROM)
    return _together(told.filter(sure), docs.columns)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold, learnt from all labels of these documents.

    A null text scores as an empty one; a null doc_id has no label but a score.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    machine = toxicity.train(docs.select("doc_id", "text"), labels)
    told = toxicity.score(_apart(docs), machine, name="__toxic")
    return _together(told.filter(F.col("__toxic") < TOXIC_FROM), docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies: the least by (doc_id, text hash, row mark), null ids last.

    Near copies have 0.8 or more of their five-word shingles in common; SimHash and minimum
    hashes name the candidates. Rows are told apart by their mark, not by doc_id: of repeated
    rows one stays, a row without id stays unless another row copies it, and of one doc_id
    with several texts each text is judged by itself.
    """
    marked = stage(_apart(docs).withColumn("__row", F.monotonically_increasing_id()), "pipeline-marked")
    ranked = marked.withColumns({"__none": F.col("doc_id").isNull(), "__text": F.xxhash64("text")})
    kept = nearcopies.survivors(ranked, mark="__row", order=["__none", "doc_id", "__text"], threshold=NEAR_FROM)
    return _together(marked.join(kept, "__row"), docs.columns)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages of 200 bytes that also start elsewhere; texts of which nothing visible stays go.

    Only whole characters are cut, so what is left is the text's own.
    """
    cut = suffixdedup.remove_repeats(
        _apart(docs), length=REPEATED_BYTES, whole_characters=True, keep=["doc_id", "__others"])
    changed = cut.withColumn("text", F.col("kept").cast("string"))
    changed = _together(changed.filter(F.trim(F.regexp_replace("text", r"\s+", " ")) != ""), docs.columns)
    if "n_chars" in docs.columns:
        changed = changed.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return changed


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences: every piece with its ids, its sequence and its place there; a null text is an end alone."""
    with open(public_tokenizers.path("word_bpe_49k.json")) as file:
        pieces = packing.tokenise(docs, file.read(), end=2, capacity=SEQUENCE, keep=["doc_id"], slice_bytes=SLICE_BYTES)
    return packing.assign(pieces, docs.count(), capacity=SEQUENCE)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", name_language),
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_copies),
    ("suffix_array_dedup", cut_repeats),
    ("packing", pack),
]

ORACLE_SQL = None  # fitted models, tokenizers and byte passages are beyond SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, apply in STAGES:
        rows = stage(apply(spark, rows, sf_dir), f"pipeline-{name}")
    return rows

"""CSV with quoted line breaks, read in splits, with rejected records kept.

A line break inside quotes does not end a record, and a split of a file cannot see
whether it begins inside quotes. So the quotes of every split are counted first; the sum
over the splits before it tells each split how it begins. Each task then joins the lines
of its splits to records. Only the records that cross a border between splits are put
together afterwards, from one piece a split. Files stay as splittable as plain lines.

A record that does not fit the schema is kept as it is, with its file and line.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlift.operators.checks import findings_from
from ledgerlift.schemas import Domain
from ledgerlift.sources.stages import stage

LONGEST_RECORD = 64 << 20
_WHOLE, _START, _REST = 0, 1, 2
_PIECES = T.StructType([
    T.StructField("file", T.StringType()), T.StructField("block", T.LongType()), T.StructField("line", T.LongType()),
    T.StructField("kind", T.IntegerType()), T.StructField("text", T.StringType())])


@dataclass(frozen=True)
class Loaded:
    """Rows that fit the schema, and rejected records as (file, line, record)."""

    rows: DataFrame
    rejected: DataFrame


def _lines(spark: SparkSession, path: str) -> DataFrame:
    meta = F.col("_metadata")
    return spark.read.option("lineSep", "\n").text(path).select(
        meta["file_path"].alias("file"), meta["file_block_start"].alias("block"), F.col("value").alias("text"))


def records(spark: SparkSession, path: str, quote: str = '"', longest: int = LONGEST_RECORD) -> DataFrame:
    """(file, line, record): the records of all files below ``path`` with the line they start in, from 0.

    Line feeds end lines, with or without a carriage return. A quote that is never closed
    makes one record of the rest of its file, as for any reader; records of more than
    ``longest`` characters raise.
    """
    lines = _lines(spark, path)
    quotes = F.length("text") - F.length(F.replace(F.col("text"), F.lit(quote), F.lit("")))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = stage(lines.groupBy("file", "block").agg(F.sum(quotes).alias("quotes"), F.count(F.lit(1)).alias("lines")), "csv-splits")
    begins = blocks.select(
        "file", "block", (F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1).alias("inside"),
        F.coalesce(F.sum("lines").over(before), F.lit(0)).alias("first"))
    # a row a split; joined where the lines are, so their order within a split stays
    known = lines.join(F.broadcast(begins), ["file", "block"]).select("file", "block", "inside", "first", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, size, start, line, inside, kind = None, [], 0, 0, 0, False, _WHOLE

        def told(done: list) -> pa.RecordBatch:
            columns = zip(*done, strict=True)
            types = (pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.string())
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["file", "block", "line", "kind", "text"])

        for batch in batches:
            done = []
            for file, block, opens, first, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if at != (file, block):
                    if held:  # the split ended inside quotes
                        done.append((*at, start, _REST if kind == _REST else _START, "\n".join(held)))
                    at, held, size, line, inside = (file, block), [], 0, first, opens
                    kind, start = (_REST if inside else _WHOLE), first
                held.append(text)
                size += len(text)
                if size > longest:
                    raise ValueError(f"a record of more than {longest} characters starts in line {start} of {file}")
                inside ^= text.count(quote) % 2 == 1
                line += 1
                if not inside:
                    done.append((file, block, start, kind, "\n".join(held)))
                    held, size, kind, start = [], 0, _WHOLE, line
            if done:
                yield told(done)
        if held:
            yield told([(*at, start, _REST if kind == _REST else _START, "\n".join(held))])

    pieces = stage(known.mapInArrow(run, _PIECES), "csv-pieces")
    # at most two pieces a split: the end of a record begun before, and the begin of one that goes on
    cut = pieces.filter(F.col("kind") != _WHOLE)
    order = Window.partitionBy("file").orderBy("block", "line")
    numbered = cut.withColumn("number", F.sum((F.col("kind") == _START).cast("int")).over(order))
    joined = numbered.groupBy("file", "number").agg(
        F.min("line").alias("line"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("block", "line", "text"))), lambda p: p["text"]), "\n").alias("text"))
    every = pieces.filter(F.col("kind") == _WHOLE).select("file", "line", "text").unionByName(joined.select("file", "line", "text"))
    return every.select("file", "line", F.regexp_replace("text", "\r$", "").alias("record"))


def read_csv_records(
    spark: SparkSession, path: str, schema: T.StructType, *, header: bool = True, mode: str = "keep", quote: str = '"',
    delimiter: str = ",",
) -> Loaded:
    """The rows of CSV files whose texts may hold line breaks, and the records that do not fit ``schema``.

    Quotes in texts are doubled. Blank lines are no records. ``mode`` "keep" lists
    rejected records, "fail" raises on the first few of them.
    """
    if mode not in ("keep", "fail"):
        raise ValueError(f"mode {mode!r} is neither keep nor fail")
    told = records(spark, path, quote).filter(F.trim("record") != "")
    if header:
        told = told.filter(F.col("line") != 0)
    wide = T.StructType([*(T.StructField(f.name, f.dataType, True) for f in schema), T.StructField("__rejected", T.StringType(), True)])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "__rejected", "quote": quote, "escape": quote, "sep": delimiter,
               "nullValue": "\u0000", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false", "lineSep": "\u0001"}
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in wide)
    parsed = stage(told.withColumn("row", F.from_csv("record", F.lit(ddl), options)), "csv-parsed")
    bad = F.col("row.__rejected").isNotNull()
    rejected = parsed.filter(bad).select("file", "line", "record")
    if mode == "fail":
        few = rejected.orderBy("file", "line").limit(3).collect()
        if few:
            raise ValueError("malformed records: " + "; ".join(f"line {r['line']} of {r['file']}" for r in few))
    return Loaded(parsed.filter(~bad).select(*[F.col("row")[f.name].alias(f.name) for f in schema]), rejected)


def rejected_findings(rejected: DataFrame, domain: Domain) -> DataFrame:
    """Rejected records as findings: the row is told by file name and line."""
    name = F.element_at(F.split("file", "/"), -1)
    row = F.concat(name, F.lit(":"), F.col("line").cast("string"))
    text = F.concat(F.lit("Record could not be read and was left out of the load: "), F.substring("record", 1, 200))
    return findings_from(rejected.withColumn("__row", row), domain.label, domain.table, "*", "__row", "accuracy", text, "high",
                         "rejected_record")

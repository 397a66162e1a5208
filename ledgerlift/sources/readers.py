"""Readers for source tables, the ground-truth manifest and stage tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlift.schemas import DOMAINS, MANIFEST_SCHEMA, SOURCE_SCHEMAS


def read_csv(spark: SparkSession, path: str, schema: T.StructType, blank_text: bool = False) -> DataFrame:
    """Headered UTF-8 CSV with a stated schema; blanks are NULL and edge spaces are kept.

    ``blank_text`` tells an empty text, written as two quotes, from a missing value. A
    malformed line ends the read; ``csv_records`` reads files with quoted line breaks and
    keeps rejected records.
    """
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("encoding", "UTF-8")
        .option("escape", '"')
        .option("multiLine", False)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("nullValue", "\u0000" if blank_text else "")
        .option("mode", "FAILFAST")
        .csv(path)
    )


def spread(df: DataFrame) -> DataFrame:
    """Give a scan that fills fewer tasks than there are cores one task per core.

    Only small inputs, such as one file with one row group, are reshuffled; a scan with
    more splits than cores is returned as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def read_sources(spark: SparkSession, folder: str, fmt: str = "csv") -> dict[str, DataFrame]:
    """The four source tables below ``folder``, by domain key."""
    out = {}
    for key, domain in DOMAINS.items():
        if fmt == "csv":
            out[key] = read_csv(spark, f"{folder}/{domain.table}.csv", SOURCE_SCHEMAS[key])
        else:
            path = f"{folder}/{domain.table}.{fmt}"
            out[key] = spark.read.format(fmt).load(path).select(*SOURCE_SCHEMAS[key].names)
    return out


def read_manifest(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Ground truth: one JSON array of objects, or (``lines``) one object per line.

    A single array is read by one task, so large manifests should use lines.
    """
    return spark.read.schema(MANIFEST_SCHEMA).option("multiLine", not lines).json(path)


def manifest_lookup(manifest: DataFrame) -> DataFrame:
    """All planted issue types per row; a row may carry several."""
    return manifest.groupBy("row_identifier").agg(
        F.sort_array(F.collect_set("issue_type")).alias("issue_types")
    )


def require_tables(spark: SparkSession, names: Iterable[str]) -> None:
    """Raise with the full list when tables or views are missing."""
    missing = [n for n in names if not spark.catalog.tableExists(n)]
    if missing:
        raise RuntimeError(f"required tables are missing: {', '.join(missing)}")


def require_inputs(frames: Mapping[str, DataFrame | None], names: Iterable[str]) -> None:
    missing = [n for n in names if frames.get(n) is None]
    if missing:
        raise RuntimeError(f"required inputs are missing: {', '.join(missing)}")

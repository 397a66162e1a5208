"""Findings scored against planted defects; the key is (row, issue type)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlift.schemas import RECALL_GATE_PERCENT

KEY = ["row_identifier", "issue_type"]


def matched(manifest: DataFrame, findings: DataFrame) -> DataFrame:
    return manifest.join(findings.select(*KEY).distinct(), KEY, "left_semi")


def missed(manifest: DataFrame, findings: DataFrame) -> DataFrame:
    return manifest.join(findings.select(*KEY).distinct(), KEY, "left_anti")


def false_positives(manifest: DataFrame, findings: DataFrame) -> DataFrame:
    return findings.join(manifest.select(*KEY).distinct(), KEY, "left_anti")


def _caught(manifest: DataFrame, findings: DataFrame) -> DataFrame:
    seen = findings.select(*KEY).distinct().withColumn("seen", F.lit(True))
    return manifest.join(seen, KEY, "left").withColumn("seen", F.coalesce("seen", F.lit(False)))


def recall(manifest: DataFrame, findings: DataFrame, gate: int = RECALL_GATE_PERCENT) -> DataFrame:
    """One row: planted, caught, missed, recall in percent and the gate."""
    n, hits = F.col("planted"), F.col("caught")
    rate = F.when(n > 0, hits * 100.0 / n).otherwise(F.lit(0.0))
    return _caught(manifest, findings).agg(
        F.count(F.lit(1)).alias("planted"), F.count_if("seen").alias("caught"),
    ).select("planted", "caught", (n - hits).alias("missed"), rate.alias("recall_percent"),
             F.when(rate >= gate, "PASS").otherwise("FAIL").alias("gate"))


def recall_by_type(manifest: DataFrame, findings: DataFrame) -> DataFrame:
    return _caught(manifest, findings).groupBy("issue_type").agg(
        F.count(F.lit(1)).alias("planted"), F.count_if("seen").alias("caught"))


def false_positive_rate(manifest: DataFrame, findings: DataFrame) -> DataFrame:
    """One row: findings, those without a planted defect, and their share in percent."""
    known = manifest.select(*KEY).distinct().withColumn("known", F.lit(True))
    n, wrong = F.col("findings"), F.col("false_positives")
    return findings.select(*KEY).join(known, KEY, "left").agg(
        F.count(F.lit(1)).alias("findings"), F.count_if(F.col("known").isNull()).alias("false_positives"),
    ).select("findings", "false_positives",
             F.when(n > 0, wrong * 100.0 / n).otherwise(F.lit(0.0)).alias("false_positive_percent"))

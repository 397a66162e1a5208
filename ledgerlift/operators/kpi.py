"""Effect of code repair on a grouped figure."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlift.functions.codes import COST_CENTRE, CodeFormat
from ledgerlift.functions.values import money_sum


def grouped_total(df: DataFrame, group: str = "cost_centre", amount: str = "amount") -> DataFrame:
    """(group, row_count, total_amount)."""
    return df.groupBy(group).agg(
        F.count(F.lit(1)).alias("row_count"), money_sum(F.col(amount)).cast("double").alias("total_amount"))


def figures_before(source: DataFrame, held_ids: DataFrame, row_id: str = "gl_entry_id",
                   group: str = "cost_centre", amount: str = "amount") -> DataFrame:
    """The figure as the source shows it; held rows are left out on both sides of the comparison."""
    return grouped_total(source.join(held_ids, row_id, "left_anti"), group, amount)


def figures_after(target: DataFrame, group: str = "cost_centre", amount: str = "amount") -> DataFrame:
    return grouped_total(target, group, amount)


def split_codes(before: DataFrame, group: str = "cost_centre", code: CodeFormat = COST_CENTRE) -> DataFrame:
    """Canonical codes that some other spelling is repaired to."""
    repaired = code.normalise(F.col(group))
    return before.filter(repaired.isNotNull() & ~repaired.eqNullSafe(F.col(group))).select(
        repaired.alias("canonical")).distinct()


def impact_table(before: DataFrame, after: DataFrame, group: str = "cost_centre",
                 code: CodeFormat = COST_CENTRE) -> DataFrame:
    """Both figures with a scenario tag; affected are codes that were split and their fragments."""
    both = before.withColumn("scenario", F.lit("before")).unionByName(after.withColumn("scenario", F.lit("after")))
    split = split_codes(before, group, code)
    return (
        both.withColumn("canonical", code.normalise(F.col(group)))
        .join(split.withColumn("hit", F.lit(True)), "canonical", "left")
        .select("scenario", group, "row_count", "total_amount",
                F.coalesce("hit", F.lit(False)).alias("is_affected_by_cascade"))
    )


def impact_deltas(before: DataFrame, after: DataFrame, group: str = "cost_centre",
                  code: CodeFormat = COST_CENTRE) -> DataFrame:
    """Per canonical code: the fragments, the main line, the merged line and what the main line was off by."""
    money = "decimal(28,2)"
    is_main = F.col(group).eqNullSafe(F.col("canonical"))

    def part(which: Column, column: str) -> Column:
        return F.coalesce(F.sum(F.when(which, F.col(column))), F.lit(0))

    old = (
        before.withColumn("canonical", code.normalise(F.col(group)))
        .withColumn("total_amount", F.col("total_amount").cast(money))
        .groupBy("canonical").agg(
            part(~is_main, "row_count").alias("fragment_rows"), part(~is_main, "total_amount").alias("fragment_total"),
            part(is_main, "row_count").alias("main_rows"), part(is_main, "total_amount").alias("main_total"))
    )
    new = after.select(F.col(group).alias("code"), F.col("row_count").alias("merged_rows"),
                       F.col("total_amount").cast(money).alias("merged_total"))
    delta = F.col("main_total") - F.col("merged_total")
    return old.join(new, F.col("canonical").eqNullSafe(F.col("code"))).select(
        F.col("canonical").alias(group), "fragment_rows",
        F.col("fragment_total").cast("double").alias("fragment_total"), "main_rows",
        F.col("main_total").cast("double").alias("main_total"), "merged_rows",
        F.col("merged_total").cast("double").alias("merged_total"), delta.cast("double").alias("delta"),
        F.when(delta > 0, "higher").otherwise("lower").alias("direction"))


def require_scenario(source: DataFrame, row_id: str, row: str, column: str, expected: str,
                     issues: DataFrame | None = None, issue_id: str | None = None) -> None:
    """Raise when the worked example no longer matches the data or its issue is not resolved."""
    found = source.filter(F.col(row_id) == row).select(column).first()
    if found is None or found[0] != expected:
        raise RuntimeError(f"expected {column} of {row} to be {expected!r}, found "
                           f"{'no such row' if found is None else repr(found[0])}")
    if issues is not None:
        status = issues.filter(F.col("issue_id") == issue_id).select("status").first()
        if status is None or status[0] != "Resolved":
            raise RuntimeError(f"expected {issue_id} to be resolved, found "
                               f"{'no such issue' if status is None else status[0]}")


def scenario_rows(impact: DataFrame, text: str) -> DataFrame:
    return impact.filter(F.lower("scenario").contains(text.lower()))


def money_rows(figures: DataFrame, group: str = "cost_centre", currency: str = "GBP") -> DataFrame:
    """The figure as a rendered table row."""
    amount = F.format_number("total_amount", 2)
    return figures.select(group, F.concat(
        F.lit("| "), F.coalesce(group, F.lit("None")), F.lit(" | "), F.col("row_count").cast("string"),
        F.lit(f" | {currency} "), amount, F.lit(" |")).alias("line"))

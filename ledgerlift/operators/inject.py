"""Planting defects in any table, with a manifest of what was planted.

Rows are chosen by a bucket number, so the choice needs no sort and no shuffle, is the same
on every run, and two defects with different buckets never share a row.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlift.schemas import DOMAINS, MANIFEST_SCHEMA, Domain, require_issue_type


def hash_bucket(row_id: str, buckets: int, seed: int = 42) -> Column:
    return F.pmod(F.xxhash64(F.lit(seed), F.col(row_id)), F.lit(buckets))


@dataclass(frozen=True)
class Defect:
    """A change of ``column`` in the rows of one bucket; ``also`` changes further columns."""

    bucket: int
    column: str
    issue_type: str
    value: Column
    description: Column
    also: tuple[tuple[str, Column], ...] = ()
    only: Column | None = None
    copies: bool = False

    def __post_init__(self) -> None:
        require_issue_type(self.issue_type)


def _chosen(defect: Defect, bucket: Column) -> Column:
    hit = bucket == F.lit(defect.bucket)
    return hit if defect.only is None else hit & F.coalesce(defect.only, F.lit(False))


def plant(df: DataFrame, domain: Domain, defects: Sequence[Defect], bucket: Column) -> tuple[DataFrame, DataFrame]:
    """(changed rows, manifest). Copies are added under the new identifier in ``also``.

    Each bucket may serve one defect, so no row carries two.
    """
    used = [d.bucket for d in defects]
    if len(set(used)) != len(used):
        raise ValueError("two defects share a bucket")
    columns = df.columns
    # choose before anything changes: defects may rewrite the columns they choose by
    marks = [F.when(_chosen(d, bucket), F.lit(i)) for i, d in enumerate(defects)]
    marked = df.withColumn("_defect", F.coalesce(*marks, F.lit(-1)))
    new = [dict([(d.column, d.value), *d.also]) for d in defects]
    copied = [i for i, d in enumerate(defects) if d.copies]

    def rewritten(indexes: Sequence[int]) -> list[Column]:
        out = []
        for c in columns:
            value = F.col(c)
            for i in indexes:
                if c in new[i]:
                    value = F.when(F.col("_defect") == i, new[i][c]).otherwise(value)
            out.append(value.cast(df.schema[c].dataType).alias(c))
        return out

    changed = marked.select(*rewritten([i for i in range(len(defects)) if i not in copied]))
    if copied:
        changed = changed.unionByName(marked.filter(F.col("_defect").isin(copied)).select(*rewritten(copied)))

    # one pass for the manifest of all defects
    def entry(i: int, d: Defect) -> Column:
        row_id = new[i].get(domain.row_id, F.col(domain.row_id)).cast("string")
        return F.when(F.col("_defect") == i, F.struct(
            F.concat(F.lit(f"{domain.key}-{d.bucket}-"), row_id).alias("issue_id"),
            row_id.alias("row_identifier"), F.lit(d.column).alias("column"),
            F.lit(d.issue_type).alias("issue_type"), d.description.alias("description")))

    entries = F.coalesce(*[entry(i, d) for i, d in enumerate(defects)])
    manifest = marked.filter(F.col("_defect") >= 0).select(entries.alias("e")).select(
        "e.*", F.lit(domain.label).alias("domain"), F.lit(domain.table).alias("table"))
    return changed, manifest.select(*MANIFEST_SCHEMA.names)


# --- defect builders -----------------------------------------------------------------


def duplicate_person(bucket: int, variant: str) -> Defect:
    """A person entered again under a new id: ``space`` after the name, or the surname as ``initial``."""
    name = F.col("name")
    words = F.split(F.trim(name), " ")
    if variant == "space":
        new = F.concat(name, F.lit(" "))
    elif variant == "initial":
        new = F.concat(F.element_at(words, 1), F.lit(" "), F.substring(F.element_at(words, -1), 1, 1), F.lit("."))
    else:
        raise ValueError(f"variant {variant!r} is neither space nor initial")
    new_id = F.concat("employee_id", F.lit(f"-D{bucket}"))
    return Defect(
        bucket, "name", "duplication", new,
        F.concat(F.lit("Likely duplicate of "), "employee_id", F.lit(" ('"), name, F.lit("'): re-entered as "), new_id,
                 F.lit(" with name variant '"), new, F.lit("'.")),
        also=(("employee_id", new_id),), copies=True)


def contradiction(bucket: int, ended: date) -> Defect:
    return Defect(
        bucket, "employment_status", "consistency", F.lit("Active"),
        F.lit("employment_status is 'Active' but termination_date is populated with a past date "
              f"({ended.isoformat()}) - contradictory record."),
        also=(("termination_date", F.lit(ended)),), only=F.col("employment_status") == "Active")


def duplicate_vendor(bucket: int) -> Defect:
    """A vendor entered again: `` Ltd`` added, or spelled out where it is there already."""
    name = F.col("vendor_name")
    variant = F.when(name.contains("Ltd"), F.replace(name, F.lit(" Ltd"), F.lit(" Limited"))).otherwise(
        F.concat(name, F.lit(" Ltd")))
    new_vendor = F.concat("vendor_id", F.lit("-D"))
    return Defect(
        bucket, "vendor_name", "duplication", variant,
        F.concat(F.lit("Vendor '"), variant, F.lit("' ("), new_vendor, F.lit(") appears to be a duplicate of '"), name,
                 F.lit("' ("), F.col("vendor_id"),
                 F.lit(") - minor name variant, likely same vendor entered as two master records.")),
        also=(("vendor_id", new_vendor), ("po_id", F.concat("po_id", F.lit("-D")))), copies=True)


def negative(bucket: int, column: str = "quantity") -> Defect:
    value = -F.abs(F.col(column))
    return Defect(bucket, column, "accuracy", value,
                  F.concat(F.lit(f"{column} is negative ("), value.cast("string"),
                           F.lit(") - not a valid PO quantity.")),
                  only=F.col(column) != 0)


def code_drift(bucket: int, prefix: str, column: str = "cost_centre") -> Defect:
    """``C005`` (prefix C) or ``005`` (no prefix) instead of ``CC-005``."""
    drifted = F.concat(F.lit(prefix), F.substring(F.col(column), 4, 3))
    return Defect(bucket, column, "consistency", drifted,
                  F.concat(F.lit(f"{column} stored as '"), drifted, F.lit("' instead of canonical format '"),
                           F.col(column), F.lit("'.")),
                  only=F.col(column).rlike(r"^CC-[0-9]{3}\z"))


def orphan_key(bucket: int, column: str, bad: str, description: str) -> Defect:
    return Defect(bucket, column, "obsolete_orphaned", F.lit(bad), F.lit(description))


def typo(bucket: int, column: str = "currency", bad: str = "GPB") -> Defect:
    return Defect(bucket, column, "accuracy", F.lit(bad),
                  F.lit(f"{column} recorded as '{bad}', a typo of the valid ISO code 'GBP'."))


def blank(bucket: int, column: str = "cost_centre") -> Defect:
    return Defect(bucket, column, "completeness", F.lit(""), F.lit(f"{column} is missing (blank) on this expense claim."))


def standard_defects(key: str) -> list[Defect]:
    """The planted defects of a domain, in buckets 0, 1, 2, ..."""
    if key == "hr":
        return [duplicate_person(0, "space"), duplicate_person(1, "initial"), contradiction(2, date(2023, 6, 1))]
    if key == "procurement":
        return [duplicate_vendor(0), negative(1), code_drift(2, "C")]
    if key == "finance":
        return [orphan_key(0, "vendor_id", "VEND-999",
                           "References vendor_id 'VEND-999', which does not exist in the Procurement vendor pool - "
                           "orphaned reference."),
                typo(1), code_drift(2, "")]
    return [blank(0), orphan_key(1, "employee_id", "EMP-9999",
                                 "References employee_id 'EMP-9999', not present in HR - simulates a leaver whose "
                                 "record was never deactivated/reassigned.")]


def plant_all(sources: dict[str, DataFrame], buckets: int = 100, seed: int = 42) -> tuple[dict[str, DataFrame], DataFrame]:
    """Standard defects in all four tables, one row in ``buckets`` per defect."""
    changed, manifest = {}, None
    for key, df in sources.items():
        d = DOMAINS[key]
        changed[key], part = plant(df, d, standard_defects(key), hash_bucket(d.row_id, buckets, seed))
        manifest = part if manifest is None else manifest.unionByName(part)
    return changed, manifest


def planted_counts(manifest: DataFrame) -> DataFrame:
    return manifest.groupBy("domain", "issue_type").agg(F.count(F.lit(1)).alias("planted"))

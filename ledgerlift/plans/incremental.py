"""Findings of a changed load from those of the load before.

A state keeps, besides the findings, an id and 128 bits of every row and the few columns
that rules look up across rows. The next load is compared with it by one aggregate over
ids and hashes. Then only this is found again:

* row rules: for changed rows;
* rules on persons' names: for the blocks (first three letters of the first token) of
  changed rows, old and new, as no rule relates names of different blocks;
* rules on vendors' names, which know no blocks: for the vendor names, which are few, if a
  vendor, its name or its first order has changed, and not at all otherwise;
* references: for changed rows, and for rows that name a vendor or employee who came or went.

All other findings are kept. Resolutions are a table of their own that is only added to.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlift.functions.values import row_hash
from ledgerlift.operators import checks as C
from ledgerlift.operators import duplicates as D
from ledgerlift.schemas import DOMAINS, EARLIEST_DATE, SOURCE_SCHEMAS
from ledgerlift.sources.stages import passes_for, stage

# columns that rules of other rows look up
_LOOKED_UP = {"hr": ["name"], "procurement": ["vendor_id"], "finance": ["vendor_id"], "expenses": ["employee_id"]}
_PERSON_RULES = ("exact_name_match", "name_abbreviation", "fuzzy_name_match")
_VENDOR_RULES = ("company_suffix_match", "fuzzy_name_match")


@dataclass(frozen=True)
class State:
    """The rows that the findings were made from, as ids and hashes, the vendor names, and the findings."""

    rows: dict[str, DataFrame]
    vendors: DataFrame
    findings: DataFrame

    def numbered(self) -> DataFrame:
        return C.number_findings(self.findings)


def _snapshot(df: DataFrame, key: str) -> DataFrame:
    lo, hi = row_hash([F.col(c) for c in SOURCE_SCHEMAS[key].names])
    return stage(df.select(F.col(DOMAINS[key].row_id).alias("id"), lo.alias("lo"), hi.alias("hi"), *_LOOKED_UP[key]), f"rows-{key}")


def changed_ids(before: DataFrame, after: DataFrame) -> DataFrame:
    """(id): rows that came, went or differ; where an id repeats or is missing its rows count as a whole."""
    both = before.select("id", "lo", "hi", F.lit(1).alias("side")).unionByName(
        after.select("id", "lo", "hi", F.lit(-1).alias("side")))
    # the sums of one load are taken away from those of the other
    rest = both.groupBy("id").agg(
        F.sum("side").alias("n"), F.bit_xor("lo").alias("lo"), F.bit_xor("hi").alias("hi"),
        F.sum(F.shiftright("lo", 32) * F.col("side")).alias("sum"))
    return rest.filter("n <> 0 OR lo <> 0 OR hi <> 0 OR sum <> 0").select("id")


def _changed(before: DataFrame, after: DataFrame, name: str) -> DataFrame:
    """``changed_ids``, written; of large loads a part of the ids at a time, as every row is exchanged."""
    passes = passes_for(before.count() + after.count())
    if passes == 1:
        return stage(changed_ids(before, after), name)
    part = F.pmod(F.xxhash64("id"), F.lit(passes))
    return reduce(DataFrame.unionByName, [
        stage(changed_ids(before.filter(part == i), after.filter(part == i)), name) for i in range(passes)])


def _only(df: DataFrame, column: str, ids: DataFrame, how: str = "left_semi") -> DataFrame:
    return df.join(ids.select(F.col(ids.columns[0]).alias("__id")), F.col(column).eqNullSafe(F.col("__id")), how)


def _raw(parts: list[DataFrame]) -> DataFrame:
    return stage(C.collect_findings(parts), "raw-findings")


def _person_rules(rows: DataFrame) -> list[DataFrame]:
    links = D.name_links(rows)
    return [D.person_exact_findings(links.rows, links.known), D.person_abbreviation_findings(links.rows, links.known),
            D.person_fuzzy_findings(links.rows, known=links.known, links=links)]


def _vendor_rules(orders: DataFrame) -> list[DataFrame]:
    links = D.name_links(D.company_rows(orders), blocked=False)
    return [D.company_suffix_findings(links.rows, orders, links.known),
            D.company_fuzzy_findings(links.rows, orders, known=links.known, links=links)]


def first_state(sources: Mapping[str, DataFrame], as_of: date, earliest: date = EARLIEST_DATE) -> State:
    """Everything found from nothing."""
    vendors = stage(D.vendor_names(sources["procurement"]), "vendor-names")
    parts = [C.apply_rules(sources[k], d, C.standard_rules(k, as_of, earliest)) for k, d in DOMAINS.items()]
    parts += _person_rules(D.person_rows(sources["hr"])) + _vendor_rules(vendors)
    parts += [C.orphan_vendor_findings(sources["finance"], vendors), C.orphan_employee_findings(sources["expenses"], sources["hr"])]
    return State({k: _snapshot(df, k) for k, df in sources.items()}, vendors, _raw(parts))


def _block() -> Column:
    return F.substring("first", 1, D.BLOCK_LETTERS)


def next_state(before: State, sources: Mapping[str, DataFrame], as_of: date, earliest: date = EARLIEST_DATE) -> State:
    """The same findings as ``first_state`` gives, found again only where something changed.

    ``as_of`` and ``earliest`` must be those of the state before, as row rules depend on them.
    """
    rows = {k: _snapshot(df, k) for k, df in sources.items()}
    changed = {k: _changed(before.rows[k], rows[k], f"changed-{k}") for k in sources}
    old = before.findings.drop("finding_key")
    keep, parts = [], []
    rule = F.col("detection_rule")

    # rules over one row
    across = rule.isin(*_PERSON_RULES, *_VENDOR_RULES, "orphan_fk")
    for key, d in DOMAINS.items():
        own = old.filter((F.col("table_name") == d.table) & ~across)
        keep.append(_only(own, "row_identifier", changed[key], "left_anti"))
        fresh = _only(sources[key], d.row_id, changed[key])
        parts.append(C.apply_rules(fresh, d, C.standard_rules(key, as_of, earliest)))

    # persons, by block of names
    names_before, names = (D.person_rows(t["hr"], "id") for t in (before.rows, rows))
    touched = stage(
        _only(names_before, "id", changed["hr"]).select(_block().alias("block")).unionByName(
            _only(names, "id", changed["hr"]).select(_block().alias("block"))).distinct(), "touched-blocks")
    blocked = names.withColumn("__block", _block())
    again = blocked.join(touched.withColumnRenamed("block", "__block"), "__block", "left_semi")
    persons = old.filter((F.col("table_name") == DOMAINS["hr"].table) & rule.isin(*_PERSON_RULES))
    untouched = blocked.join(touched.withColumnRenamed("block", "__block"), "__block", "left_anti").select("id").distinct()
    keep.append(_only(persons, "row_identifier", untouched))
    parts += _person_rules(again.drop("__block"))

    # vendors, all or none
    vendors = stage(D.vendor_names(sources["procurement"]), "vendor-names")
    differ = before.vendors.exceptAll(vendors).limit(1).count() + vendors.exceptAll(before.vendors).limit(1).count()
    if differ:
        parts += _vendor_rules(vendors)
    else:
        keep.append(old.filter((F.col("table_name") == DOMAINS["procurement"].table) & rule.isin(*_VENDOR_RULES)))

    # references
    for key, column, master, find in (
            ("finance", "vendor_id", (before.vendors.select("vendor_id"), vendors.select("vendor_id")),
             lambda fact: C.orphan_vendor_findings(fact, vendors)),
            ("expenses", "employee_id", tuple(t["hr"].select(F.col("id").alias("employee_id")) for t in (before.rows, rows)),
             lambda fact: C.orphan_employee_findings(fact, sources["hr"]))):
        d = DOMAINS[key]
        was, now = (m.filter(F.col(column).isNotNull()).distinct() for m in master)
        moved = was.join(now, column, "left_anti").unionByName(now.join(was, column, "left_anti"))
        naming = rows[key].join(moved, column, "left_semi").select("id")
        affected = stage(naming.unionByName(changed[key]).distinct(), f"affected-{key}")
        own = old.filter((F.col("table_name") == d.table) & (rule == "orphan_fk"))
        keep.append(_only(own, "row_identifier", affected, "left_anti"))
        parts.append(find(_only(sources[key], d.row_id, affected)))
    return State(rows, vendors, _raw([*keep, *parts]))


def add_resolutions(earlier: DataFrame | None, more: DataFrame) -> DataFrame:
    """The resolutions of all runs; entries are only added, and applying them picks the best of a key."""
    columns = ["finding_key", "status", "note"]
    more = more.select(*columns)
    return more if earlier is None else earlier.select(*columns).unionByName(more.join(earlier.select(*columns), columns, "left_anti"))

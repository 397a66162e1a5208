"""Reconciliation of migrated tables with their sources."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ledgerlift.functions.values import EXACT, money_sum, row_hash
from ledgerlift.operators.mapping import map_table
from ledgerlift.schemas import DOMAINS, MONEY_TOLERANCE
from ledgerlift.sources.spec import DomainSpec
from ledgerlift.sources.stages import passes_for, stage


def row_counts(sources: Mapping[str, DataFrame], targets: Mapping[str, DataFrame], held: DataFrame) -> DataFrame:
    """Source, target and held rows per table with the verdict on their difference.

    A row held for several reasons counts once, and held rows are found by table name. Where
    an id is missing or repeats, every row that has it is held, and each of them counts.
    """
    n = F.count(F.lit(1)).cast("bigint")
    parts = []
    for key in sources:
        table = F.lit(DOMAINS[key].table).alias("table_name")
        zero = F.lit(0).cast("bigint")
        parts.append(sources[key].agg(n.alias("s")).select(table, "s", zero.alias("t"), zero.alias("h")))
        parts.append(targets[key].agg(n.alias("t")).select(table, zero.alias("s"), "t", zero.alias("h")))
        out = held_source_rows(sources[key], held, DOMAINS[key].table, DOMAINS[key].row_id)
        parts.append(out.agg(n.alias("h")).select(table, zero.alias("s"), zero.alias("t"), "h"))
    return row_count_verdicts(reduce(DataFrame.unionByName, parts).groupBy("table_name").agg(
        F.sum("s").alias("source_rows"), F.sum("t").alias("target_rows"), F.sum("h").alias("held_rows")))


def row_count_verdicts(totals: DataFrame) -> DataFrame:
    """The verdict on ``totals(table_name, source_rows, target_rows, held_rows)``, however they were counted."""
    delta = F.col("target_rows") - F.col("source_rows")
    return totals.select(
        "table_name", "source_rows", "target_rows", delta.alias("delta"),
        (-F.col("held_rows")).alias("expected_delta"),
        F.when((delta == 0) & (F.col("held_rows") == 0), "CLEAN")
        .when(delta == -F.col("held_rows"), "EXPECTED DELTA").otherwise("UNEXPECTED DELTA").alias("status"),
    )


def held_listing(held: DataFrame, table: str | None = None) -> DataFrame:
    out = held if table is None else held.filter(F.col("table_name") == table)
    return out.select("table_name", "row_identifier", "issue_id", "reason")


def _held_ids(held: DataFrame, table: str, key: str) -> DataFrame:
    return held.filter(F.col("table_name") == table).select(F.col("row_identifier").alias(key)).distinct()


def held_source_rows(source: DataFrame, held: DataFrame, table: str, row_id: str, how: str = "left_semi") -> DataFrame:
    """Source rows whose id is held, or with ``left_anti`` the others; a missing id is an id like any other."""
    ids = _held_ids(held, table, "_held")
    return source.join(ids, source[row_id].eqNullSafe(ids["_held"]), how)


def row_checksums(source: DataFrame, target: DataFrame, spec: DomainSpec, row_id: str, held: DataFrame) -> DataFrame:
    """(key, state) per row id: matched, drifted, held, missing or unexpected."""
    return _row_states(map_table(source, spec), target, spec, row_id, held).select("key", "state")


def _row_states(mapped: DataFrame, target: DataFrame, spec: DomainSpec, row_id: str, held: DataFrame) -> DataFrame:
    """(key, state, rows): both sides shrink to the key and 128 bits, and one aggregate by key replaces the join."""
    key = spec.target_of(row_id)
    lo, hi = row_hash([F.col(c) for c in spec.targets()])

    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select(F.col(key).alias("key"), F.lit(name).alias("side"), lo.alias("lo"), hi.alias("hi"))

    is_s, is_t, is_h = (F.col("side") == x for x in ("s", "t", "h"))
    zero = F.lit(0).cast("bigint")
    both = side(mapped, "s").unionByName(side(target, "t")).unionByName(
        _held_ids(held, spec.source_table, "key").select(
            "key", F.lit("h").alias("side"), zero.alias("lo"), zero.alias("hi")))

    # with one row per id the two xors are its hashes; extremes and sums tell repeated ids apart
    def facts(which: Column, prefix: str) -> list[Column]:
        low, high = F.when(which, F.col("lo")), F.when(which, F.col("hi"))
        return [F.count_if(which).alias(f"{prefix}_n"), F.min(low).alias(f"{prefix}_min"),
                F.max(low).alias(f"{prefix}_max"), F.bit_xor(low).alias(f"{prefix}_lo"),
                F.bit_xor(high).alias(f"{prefix}_hi"), F.sum(F.shiftright(low, 32)).alias(f"{prefix}_sum")]

    by_key = both.groupBy("key").agg(*facts(is_s, "s"), *facts(is_t, "t"), F.count_if(is_h).alias("h_n"))
    same = reduce(lambda a, b: a & b,
                  [F.col(f"s_{f}").eqNullSafe(F.col(f"t_{f}")) for f in ("n", "min", "max", "lo", "hi", "sum")])
    state = (
        F.when((F.col("s_n") == 0) & (F.col("t_n") == 0), F.lit(None).cast("string"))
        .when(F.col("s_n") == 0, "unexpected")
        .when(F.col("t_n") == 0, F.when(F.col("h_n") > 0, "held").otherwise("missing"))
        .when(same, "matched").otherwise("drifted")
    )
    return by_key.select("key", state.alias("state"), F.greatest("s_n", "t_n").alias("rows")).filter(
        F.col("state").isNotNull())


STATES = ("matched", "drifted", "held", "missing", "unexpected")


def checksum_summary(states: DataFrame, table: str) -> DataFrame:
    """Counts per state; the table is clean without drifted, missing or unexpected rows."""
    rows = F.col("rows") if "rows" in states.columns else F.lit(1)
    return states.agg(*[F.coalesce(F.sum(F.when(F.col("state") == k, rows)), F.lit(0)).cast("bigint").alias(k) for k in STATES]).select(
        F.lit(table).alias("table_name"), *STATES, _verdict())


def _verdict() -> Column:
    return F.when(F.col("drifted") + F.col("missing") + F.col("unexpected") == 0, "CLEAN").otherwise("DRIFT").alias("status")


# --- a tree of fingerprints: only ranges that differ are read row by row -----------

LEAF_BITS = 12
LEVEL_BITS = 4


def key_range(key: Column, bits: int = LEAF_BITS) -> Column:
    """The range of hashed keys that a row belongs to."""
    return F.shiftrightunsigned(F.xxhash64(key), 64 - bits).cast("int")


_PRINT = ("n", "lo", "hi", "sum")
_ID = ("h1", "h2")


def _hashed_id(key: Column) -> list[Column]:
    return [F.xxhash64(key).alias("h1"), F.hash(key).alias("h2")]


def _differs() -> Column:
    return ~reduce(lambda a, b: a & b, [F.col(f"s_{f}").eqNullSafe(F.col(f"t_{f}")) for f in _PRINT])


def fingerprint_tree(mapped: DataFrame, target: DataFrame, spec: DomainSpec, row_id: str, held: DataFrame) -> DataFrame:
    """(bits, node, s_n, s_lo, s_hi, s_sum, t_..., differs): order-free fingerprints of key ranges, from leaves to root.

    The source side leaves out held rows. Rows shrink to a range and 128 bits, and are
    added up in each task before anything moves: at most 4096 sums leave a task, whatever
    the size of the tables. A level above adds up 16 ranges.
    """
    key = spec.target_of(row_id)
    lo, hi = row_hash([F.col(c) for c in spec.targets()])
    kept = held_source_rows(mapped, held, spec.source_table, key, "left_anti")

    def side(df: DataFrame, is_source: bool) -> DataFrame:
        return df.select(key_range(F.col(key)).alias("node"), F.lit(is_source).alias("source"), lo.alias("lo"), hi.alias("hi"))

    facts = []
    for name, own in (("s", F.col("source")), ("t", ~F.col("source"))):
        low, high = F.when(own, F.col("lo")), F.when(own, F.col("hi"))
        facts += [F.count_if(own).alias(f"{name}_n"), F.bit_xor(low).alias(f"{name}_lo"), F.bit_xor(high).alias(f"{name}_hi"),
                  F.sum(F.shiftright(low, 32)).alias(f"{name}_sum")]
    leaves = stage(side(kept, True).unionByName(side(target, False)).groupBy("node").agg(*facts), "fingerprints")
    levels = [leaves.withColumn("bits", F.lit(LEAF_BITS))]
    for bits in range(LEAF_BITS - LEVEL_BITS, -1, -LEVEL_BITS):
        sums = [(F.bit_xor if f in ("lo", "hi") else F.sum)(f"{s}_{f}").alias(f"{s}_{f}") for s in "st" for f in _PRINT]
        levels.append(leaves.groupBy(F.shiftright("node", LEAF_BITS - bits).alias("node")).agg(*sums).withColumn("bits", F.lit(bits)))
    return reduce(DataFrame.unionByName, levels).withColumn("differs", _differs())


class TableComparison:
    """One table and its target, compared by ranges, then by hashed ids; rows are read only where ids differ.

    In a large table some row of every range differs sooner or later, so ranges alone would
    have all rows moved with all columns. In ranges that differ each row therefore moves as
    96 bits of its id and 128 bits of its values, and only ids whose sums differ are read.
    """

    def __init__(self, source: DataFrame, target: DataFrame, spec: DomainSpec, row_id: str, held: DataFrame):
        self.mapped, self.target, self.spec, self.row_id, self.held = map_table(source, spec), target, spec, row_id, held
        self.tree = fingerprint_tree(self.mapped, target, spec, row_id, held)
        self.leaves = self.tree.filter(F.col("bits") == LEAF_BITS)

    def _within(self, df: DataFrame, differs: bool, key: str | None = None, own: Column | None = None) -> DataFrame:
        """Rows whose range differs; for ``differs=False`` all others. The list of ranges is bounded by 4096.

        ``own`` takes only some of the ranges.
        """
        ranges = self.leaves.filter(F.col("differs") if own is None else F.col("differs") & own).select("node")
        return df.join(F.broadcast(ranges), key_range(F.col(key or self.spec.target_of(self.row_id))) == ranges["node"],
                       "left_semi" if differs else "left_anti")

    def _held_within(self, own: Column | None = None) -> DataFrame:
        return self._within(self.held.filter(F.col("table_name") == self.spec.source_table), True, "row_identifier", own)

    @cached_property
    def _ids(self) -> tuple[DataFrame, dict[str, int]]:
        """(h1, h2, state, rows) of the ids in differing ranges that differ, written; rows per state and ids compared alike.

        All rows of these ranges are exchanged by id, and none is like another, so large tables go a part of the ranges
        at a time: the ranges of a part hold all rows of their ids.
        """
        rows = self.leaves.filter("differs").agg(F.sum(F.col("s_n") + F.col("t_n"))).first()[0] or 0
        passes = passes_for(rows)
        parts = [self._ids_of(F.col("node") % passes == i if passes > 1 else None) for i in range(passes)]
        return (reduce(DataFrame.unionByName, [ids for ids, _ in parts]),
                {x: sum(counts[x] for _, counts in parts) for x in (*STATES, "alike")})

    def _ids_of(self, own: Column | None) -> tuple[DataFrame, dict[str, int]]:
        """``_ids`` of some ranges.

        The sums of a side are taken away from those of the other, so an id whose rows are
        the same on both sides, in any order, is left with zeros.
        """
        key = self.spec.target_of(self.row_id)
        lo, hi = row_hash([F.col(c) for c in self.spec.targets()])
        zero = F.lit(0).cast("bigint")

        def side(df: DataFrame, column: str, name: str, low: Column, high: Column) -> DataFrame:
            return df.select(*_hashed_id(F.col(column)), F.lit(name).alias("side"), low.alias("lo"), high.alias("hi"))

        both = side(self._within(self.mapped, True, own=own), key, "s", lo, hi).unionByName(
            side(self._within(self.target, True, own=own), key, "t", lo, hi)).unionByName(
            side(self._held_within(own), "row_identifier", "h", zero, zero))
        upper = F.shiftright("lo", 32)
        by_id = both.groupBy(*_ID).agg(
            *[F.count_if(F.col("side") == x).alias(f"{x}_n") for x in "sth"],
            F.bit_xor("lo").alias("lo"), F.bit_xor("hi").alias("hi"),
            F.sum(F.when(F.col("side") == "t", -upper).otherwise(upper)).alias("sum"))
        same = (F.col("s_n") == F.col("t_n")) & (F.col("lo") == 0) & (F.col("hi") == 0) & (F.col("sum") == 0)
        state = (
            F.when((F.col("s_n") == 0) & (F.col("t_n") == 0), F.lit(None).cast("string"))
            .when(F.col("s_n") == 0, "unexpected")
            .when(F.col("t_n") == 0, F.when(F.col("h_n") > 0, "held").otherwise("missing"))
            .when(same, "matched").otherwise("drifted"))
        states = by_id.select(*_ID, state.alias("state"), F.greatest("s_n", "t_n").alias("rows"))
        seen = Observation()
        rows = [F.coalesce(F.sum(F.when(F.col("state") == x, F.col("rows"))), F.lit(0)).alias(x) for x in STATES]
        states = states.observe(seen, *rows, F.count_if(F.col("state") == "matched").alias("alike"))
        ids = stage(states.filter(F.col("state").isin("drifted", "missing", "unexpected")), "differing-ids")
        return ids, {x: seen.get.get(x) or 0 for x in (*STATES, "alike")}

    def _of_ids(self, df: DataFrame, ids: DataFrame) -> DataFrame:
        """Rows of differing ranges with one of the ``ids``, and their ``state`` and ``rows``.

        Half of the hash goes ahead: a short list that is broadcast by its real size, so hardly a row of another id moves.
        """
        own = self._within(df, True).select("*", *_hashed_id(F.col(self.spec.target_of(self.row_id))))
        return own.join(ids.select("h2"), "h2", "left_semi").join(ids, list(_ID)).drop(*_ID)

    def differences(self) -> DataFrame:
        """(key, state, rows) of all row ids in differing ranges."""
        return _row_states(self._within(self.mapped, True), self._within(self.target, True), self.spec, self.row_id,
                           self._held_within())

    def changed(self) -> DataFrame:
        """(key, state, rows) of the row ids that drifted, are missing or unexpected."""
        key = self.spec.target_of(self.row_id)
        rows = self._of_ids(self.mapped.select(key).unionByName(self.target.select(key)), self._ids[0])
        return rows.select(F.col(key).alias("key"), "state", "rows").distinct()

    def summary(self) -> DataFrame:
        """Rows per state: clean ranges give their counts, differing ones those of their ids."""
        key, table = self.spec.target_of(self.row_id), self.spec.source_table
        clean = self.leaves.filter(~F.col("differs")).select(F.lit("matched").alias("state"), F.col("s_n").alias("rows"))
        out = held_source_rows(self._within(self.mapped.select(key), False), self.held, table, key).select(
            F.lit("held").alias("state"), F.lit(1).cast("bigint").alias("rows"))
        counts = self._ids[1]
        read = clean.sparkSession.createDataFrame([(x, counts[x]) for x in STATES], "state string, rows bigint")
        return checksum_summary(clean.unionByName(out).unionByName(read), table)

    def column_drift(self) -> DataFrame:
        """(table_name, column_name, compared, drifted): rows of clean ranges and ids that are alike count as compared unread."""
        clean = self.leaves.filter(~F.col("differs")).agg(F.coalesce(F.sum("s_n"), F.lit(0))).first()[0]
        ids, counts = self._ids
        drifted = ids.filter(F.col("state") == "drifted")
        read = _column_drift(self._of_ids(self.mapped, drifted), self._of_ids(self.target, drifted), self.spec, self.row_id)
        return read.select(F.lit(self.spec.source_table).alias("table_name"), "column_name",
                           (F.col("compared") + F.lit(clean + counts["alike"])).alias("compared"), "drifted")


def compare_all(sources: Mapping[str, DataFrame], targets: Mapping[str, DataFrame], specs: Mapping[str, DomainSpec],
                held: DataFrame) -> dict[str, TableComparison]:
    return {k: TableComparison(sources[k], targets[k], specs[k], DOMAINS[k].row_id, held) for k in sources}


def checksum_all(sources: Mapping[str, DataFrame], targets: Mapping[str, DataFrame], specs: Mapping[str, DomainSpec],
                 held: DataFrame) -> DataFrame:
    """The checksum summary of every table."""
    return reduce(DataFrame.unionByName, [c.summary() for c in compare_all(sources, targets, specs, held).values()])


def column_drift(source: DataFrame, target: DataFrame, spec: DomainSpec, row_id: str) -> DataFrame:
    """(column_name, compared, drifted): ids on both sides, and those whose values differ, per column.

    Where an id is missing or repeats, the values of all its rows are compared as a whole,
    whatever their order. One aggregate by id takes the place of a join.
    """
    return _column_drift(map_table(source, spec), target, spec, row_id)


def _column_drift(mapped: DataFrame, target: DataFrame, spec: DomainSpec, row_id: str) -> DataFrame:
    key = spec.target_of(row_id)
    columns = [c for c in spec.targets() if c != key]
    mapped = mapped.select(key, *columns, F.lit(True).alias("_source"))
    both = mapped.unionByName(target.select(key, *columns, F.lit(False).alias("_source")))
    hashed = both.select(key, "_source", *[
        F.xxhash64(F.col(c), F.col(c).isNull()).alias(f"h_{i}") for i, c in enumerate(columns)])
    facts = [F.count_if("_source").alias("s_n"), F.count_if(~F.col("_source")).alias("t_n")]
    for i in range(len(columns)):
        for side, own in (("s", F.col("_source")), ("t", ~F.col("_source"))):
            value = F.when(own, F.col(f"h_{i}"))
            # the upper halves add up without overflow and tell repeated values apart, which cancel in the xor
            facts += [F.bit_xor(value).alias(f"{side}_x_{i}"), F.sum(F.shiftright(value, 32)).alias(f"{side}_a_{i}")]
    by_id = hashed.groupBy(key).agg(*facts).filter((F.col("s_n") > 0) & (F.col("t_n") > 0))

    def same(i: int) -> Column:
        pairs = [F.col(f"s_{f}_{i}").eqNullSafe(F.col(f"t_{f}_{i}")) for f in "xa"]
        return (F.col("s_n") == F.col("t_n")) & pairs[0] & pairs[1]

    counts = by_id.agg(
        F.count(F.lit(1)).alias("compared"), *[F.count_if(~same(i)).alias(f"n_{i}") for i in range(len(columns))])
    return counts.select("compared", F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"n_{i}").alias("drifted")) for i, c in enumerate(columns)
    ]))).select("column_name", "compared", "drifted")


def compare_totals(source: DataFrame, target: DataFrame, measure: Column, held: DataFrame, table: str,
                   source_row_id: str, rule: str, group: Column | None = None,
                   tolerance: float = MONEY_TOLERANCE) -> DataFrame:
    """Business rule: a total over the source without held rows equals the target's.

    ``group`` compares per group instead of in total; it is evaluated on both sides, and a
    group on one side only counts as 0 on the other. Both sides are summed in exact
    decimals in one aggregate.
    """
    kept = held_source_rows(source, held, table, source_row_id, "left_anti")
    name = F.lit("all") if group is None else group.cast("string")

    def side(df: DataFrame, is_source: bool) -> DataFrame:
        value = measure.cast(EXACT)
        none = F.lit(None).cast(EXACT)
        return df.select(name.alias("group_value"),
                         (value if is_source else none).alias("s"), (none if is_source else value).alias("t"))

    sums = side(kept, True).unionByName(side(target, False)).groupBy("group_value").agg(
        money_sum(F.col("s")).alias("source_total"), money_sum(F.col("t")).alias("target_total"))
    gap = F.abs(F.col("source_total") - F.col("target_total"))
    return sums.select(
        F.lit(rule).alias("rule"), "group_value",
        F.col("source_total").cast("double").alias("source_total"),
        F.col("target_total").cast("double").alias("target_total"),
        F.when(gap < F.lit(tolerance).cast(EXACT), "PASS").otherwise("FAIL").alias("status"))


def inclusion_counts(target: DataFrame, held: DataFrame, table: str) -> DataFrame:
    """Rows that moved with a flag and rows held out, shown beside each business rule."""
    moved = target.agg(F.count_if(F.col("migration_status") == "migrated_with_flag").alias("flagged_in"))
    out = held.filter(F.col("table_name") == table).agg(F.count_distinct("row_identifier").alias("held_out"))
    # two single rows meet on a constant key
    return (
        moved.select(F.lit(table).alias("table_name"), "flagged_in")
        .join(F.broadcast(out.select(F.lit(table).alias("table_name"), "held_out")), "table_name")
    )


def target_deltas(counts: DataFrame) -> DataFrame:
    """Target size and its change, per table."""
    return counts.select("table_name", "target_rows", "delta")


def headline(counts: DataFrame, checksums: DataFrame, rules: DataFrame) -> DataFrame:
    """One row: checks made, checks failed, and the headline that follows from them."""
    passed = (
        counts.select((F.col("status") != "UNEXPECTED DELTA").alias("ok"))
        .unionByName(checksums.select((F.col("status") == "CLEAN").alias("ok")))
        .unionByName(rules.select((F.col("status") == "PASS").alias("ok")))
    )
    return passed.agg(
        F.count(F.lit(1)).alias("checks"), F.count_if(~F.col("ok")).alias("failed"),
        F.when(F.every("ok"), "Reconciles cleanly against migration policy")
        .otherwise("Does not reconcile with migration policy").alias("headline"))


def order_value() -> Column:
    """Quantity times unit price; the price keeps six decimals, and only totals are rounded."""
    return F.col("quantity").cast("decimal(18,2)") * F.col("unit_price").cast("decimal(18,6)")


def standard_rules(sources: Mapping[str, DataFrame], targets: Mapping[str, DataFrame], held: DataFrame,
                   names: Sequence[str] = ("expenses", "procurement", "finance")) -> DataFrame:
    """The three business totals."""
    measures = {
        "expenses": (F.col("amount"), "total expense amount"),
        "procurement": (order_value(), "total order value"),
        "finance": (F.col("amount"), "total finance amount"),
    }
    parts = []
    for key in names:
        measure, rule = measures[key]
        d = DOMAINS[key]
        parts.append(compare_totals(sources[key], targets[key], measure, held, d.table, d.row_id, rule))
    return reduce(DataFrame.unionByName, parts)

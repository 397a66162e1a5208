"""The jobs in order: discover, log, map and resolve, migrate, reconcile."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date
from functools import cached_property, reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ledgerlift.operators import checks as C
from ledgerlift.operators import clusters as K
from ledgerlift.operators import duplicates as D
from ledgerlift.operators import issues as I
from ledgerlift.operators import kpi as KP
from ledgerlift.operators import mapping as M
from ledgerlift.operators import policy as P
from ledgerlift.operators import reconcile as R
from ledgerlift.operators import score as S
from ledgerlift.schemas import DOMAINS, EARLIEST_DATE
from ledgerlift.sources.readers import require_inputs
from ledgerlift.sources.publish import publish
from ledgerlift.sources.spec import DomainSpec, default_spec
from ledgerlift.sources.stages import stage, stage_counted


def discover(sources: Mapping[str, DataFrame], as_of: date, fuzzy: bool = True,
             earliest: date = EARLIEST_DATE, persons: D.NameLinks | None = None,
             vendors: D.NameLinks | None = None, orders: DataFrame | None = None) -> DataFrame:
    """Numbered findings of all checks; ``persons``, ``vendors`` and ``orders`` are the names if already read."""
    require_inputs(sources, DOMAINS)
    orders = orders if orders is not None else stage(D.vendor_names(sources["procurement"]), "vendor-names")
    persons = persons or D.name_links(D.person_rows(sources["hr"]), fuzzy=fuzzy)
    vendors = vendors or D.name_links(D.company_rows(orders), blocked=False, fuzzy=fuzzy)
    parts = [C.apply_rules(sources[k], d, C.standard_rules(k, as_of, earliest)) for k, d in DOMAINS.items()]
    parts += [D.person_exact_findings(persons.rows, persons.known), D.person_abbreviation_findings(persons.rows, persons.known),
              D.company_suffix_findings(vendors.rows, orders, vendors.known)]
    if fuzzy:
        parts += [D.person_fuzzy_findings(persons.rows, known=persons.known, links=persons),
                  D.company_fuzzy_findings(vendors.rows, orders, known=vendors.known, links=vendors)]
    parts += [C.orphan_vendor_findings(sources["finance"], orders),
              C.orphan_employee_findings(sources["expenses"], sources["hr"])]
    return C.number_findings(C.collect_findings(parts))


def map_all(sources: Mapping[str, DataFrame], specs: Mapping[str, DomainSpec] | None = None,
            lenient: bool = False) -> dict[str, DataFrame]:
    specs = specs or default_spec()
    return {k: M.map_table(df, specs[k], lenient=lenient) for k, df in sources.items()}


def migrate_all(sources: Mapping[str, DataFrame], issue_rows: DataFrame,
                specs: Mapping[str, DomainSpec] | None = None) -> dict[str, DataFrame]:
    """Targets of all domains; the row actions are staged once and their size picks the join."""
    specs = specs or default_spec()
    actions = stage(P.row_actions(issue_rows), "row-actions")
    return {
        k: P.migrate(M.map_table(df, specs[k]), specs[k], DOMAINS[k].row_id, actions)
        for k, df in sources.items()
    }


class Migration:
    """One run of the job over four source tables.

    Every product is made when it is first asked for, written to shared storage and read
    from there by all that follows, so asking for one figure does no more than it needs
    and nothing is made twice. ``earlier`` holds resolutions of previous runs, which
    survive a rebuild of the log; ``manifest`` the planted defects, where they are known.
    """

    def __init__(self, sources: Mapping[str, DataFrame], as_of: date, specs: Mapping[str, DomainSpec] | None = None,
                 manifest: DataFrame | None = None, earlier: DataFrame | None = None, fuzzy: bool = True,
                 earliest: date = EARLIEST_DATE):
        self.sources, self.as_of, self.specs = dict(sources), as_of, specs or default_spec()
        self.manifest, self.earlier, self.fuzzy, self.earliest = manifest, earlier, fuzzy, earliest

    # --- names and findings

    @cached_property
    def person_names(self) -> D.NameLinks:
        return D.name_links(D.person_rows(self.sources["hr"]), fuzzy=self.fuzzy)

    @cached_property
    def vendor_orders(self) -> DataFrame:
        """Names, first orders and counts of the vendors: the one pass over the orders for their names."""
        return stage(D.vendor_orders(self.sources["procurement"]), "vendor-orders")

    @cached_property
    def vendor_names(self) -> D.NameLinks:
        return D.name_links(D.company_rows(self.vendor_orders), blocked=False, fuzzy=self.fuzzy)

    @cached_property
    def findings(self) -> DataFrame:
        return discover(
            self.sources, self.as_of, self.fuzzy, self.earliest, self.person_names, self.vendor_names, self.vendor_orders)

    @cached_property
    def person_clusters(self) -> DataFrame:
        return stage(K.person_clusters(self.sources["hr"], links=self.person_names), "person-clusters")

    @cached_property
    def vendor_clusters(self) -> DataFrame:
        return stage(K.vendor_clusters(
            self.sources["procurement"], links=self.vendor_names, orders=self.vendor_orders), "vendor-clusters")

    # --- the issue log

    @cached_property
    def log(self) -> DataFrame:
        """The log before this run resolves anything."""
        return I.log_of(self.logged_rows)

    @cached_property
    def logged_rows(self) -> DataFrame:
        return I.logged_rows(self.findings, self.earlier)

    @cached_property
    def person_review(self) -> DataFrame:
        return stage(K.person_review(
            self.sources["hr"], self.person_clusters, self.person_names,
            with_issue=I.open_person_duplicates(self.logged_rows)), "person-review")

    @cached_property
    def vendor_master(self) -> DataFrame:
        return stage(K.vendor_master(self.vendor_clusters), "vendor-master")

    @cached_property
    def person_master(self) -> DataFrame:
        return stage(K.person_master(self.sources["hr"], self.person_clusters), "person-master")

    @cached_property
    def resolutions(self) -> DataFrame:
        """Everything the mapping settles, as one table."""
        rows, manifest = self.logged_rows, self.manifest
        parts = [
            I.resolve_code_drift(rows, self.sources, manifest),
            I.resolve_status_contradiction(rows, self.specs["hr"], manifest),
            I.resolve_vendor_duplicates(
                rows, D.first_orders(self.vendor_orders), self.vendor_clusters, K.member_notes(self.vendor_clusters),
                self.vendor_master, manifest),
            I.resolve_persons(rows, self.person_review, manifest)]
        return stage(reduce(DataFrame.unionByName, parts), "resolutions")

    @cached_property
    def issues(self) -> DataFrame:
        return I.log_of(self.issue_rows)

    @cached_property
    def issue_rows(self) -> DataFrame:
        return stage(I.apply_resolutions(self.logged_rows, self.resolutions), "issue-rows")

    # --- migration

    @cached_property
    def held(self) -> DataFrame:
        return stage(P.held_rows(self.issue_rows), "held")

    @cached_property
    def actions(self) -> DataFrame:
        return stage(P.row_actions(self.issue_rows), "row-actions")

    def target(self, key: str) -> DataFrame:
        """The migrated table of one domain."""
        return self._moved(key)[0]

    def _moved(self, key: str) -> tuple[DataFrame, dict[str, int]]:
        """The target and the row counts seen while it was written."""
        made = self.__dict__.setdefault("_targets", {})
        if key not in made:
            spec, seen = self.specs[key], Observation()
            target, rows = stage_counted(
                P.migrate(M.map_table(self.sources[key], spec), spec, DOMAINS[key].row_id, self.actions, seen), f"target-{key}")
            counts = {name: seen.get.get(name, 0) for name in ("source_rows", "held_rows", "flagged_rows")}
            made[key] = target, {**counts, "target_rows": rows}
        return made[key]

    @property
    def targets(self) -> dict[str, DataFrame]:
        return {key: self.target(key) for key in self.sources}

    @cached_property
    def mapped(self) -> dict[str, DataFrame]:
        return map_all(self.sources, self.specs)

    # --- reconciliation and reports

    @cached_property
    def counts(self) -> DataFrame:
        """Source, target and held rows per table, counted while the targets were written."""
        counts = {key: self._moved(key)[1] for key in self.sources}
        spark = next(iter(self.sources.values())).sparkSession
        return R.row_count_verdicts(spark.createDataFrame(
            [(DOMAINS[k].table, c["source_rows"], c["target_rows"], c["held_rows"]) for k, c in counts.items()],
            "table_name string, source_rows bigint, target_rows bigint, held_rows bigint"))

    @cached_property
    def inclusions(self) -> DataFrame:
        """(table_name, flagged_in, held_out) from the same counts."""
        spark = next(iter(self.sources.values())).sparkSession
        return spark.createDataFrame(
            [(DOMAINS[k].table, c["flagged_rows"], c["held_rows"]) for k in self.sources for c in [self._moved(k)[1]]],
            "table_name string, flagged_in bigint, held_out bigint")

    @cached_property
    def checksums(self) -> DataFrame:
        return stage(R.checksum_all(self.sources, self.targets, self.specs, self.held), "checksums")

    @cached_property
    def rules(self) -> DataFrame:
        return stage(R.standard_rules(self.sources, self.targets, self.held), "rules")

    @cached_property
    def headline(self) -> DataFrame:
        return R.headline(self.counts, self.checksums, self.rules)

    @cached_property
    def validation(self) -> DataFrame:
        return stage(M.validation_report(
            self.mapped, self.sources, K.consolidation(self.vendor_clusters),
            M.orphan_vendors(self.mapped["finance"], self.vendor_master),
            M.orphan_employees(self.mapped["expenses"], self.mapped["hr"]), self.issues), "validation")

    @cached_property
    def figures(self) -> tuple[DataFrame, DataFrame]:
        """The grouped figure before and after, held rows left out of both."""
        d = DOMAINS["finance"]
        out = self.held.filter(F.col("table_name") == d.table).select(F.col("row_identifier").alias(d.row_id)).distinct()
        return (stage(KP.figures_before(self.sources["finance"], out), "figures-before"),
                stage(KP.figures_after(self.target("finance")), "figures-after"))

    @cached_property
    def impact(self) -> DataFrame:
        return stage(KP.impact_table(*self.figures), "impact")

    @cached_property
    def score(self) -> DataFrame | None:
        """Recall against the manifest, where one was given."""
        return None if self.manifest is None else stage(S.recall(self.manifest, self.findings), "score")

    def tables(self) -> dict[str, DataFrame]:
        """All products by name, in the order in which they come to be."""
        out = {
            "discovery_findings": self.findings, "issue_log": self.issues, "resolutions": self.resolutions,
            "person_clusters": self.person_clusters, "vendor_clusters": self.vendor_clusters,
            "target_vendor_master": self.vendor_master, "target_hr_master": self.person_master,
            "hr_duplicate_review": self.person_review, "held_rows": self.held}
        out |= {self.specs[key].target_table: self.target(key) for key in self.sources}
        out |= {
            "row_counts": self.counts, "checksums": self.checksums, "business_rules": self.rules, "headline": self.headline,
            "validation_report": self.validation, "kpi_impact": self.impact}
        return out | ({} if self.score is None else {"discovery_score": self.score})


def run(sources: Mapping[str, DataFrame], as_of: date, specs: Mapping[str, DomainSpec] | None = None,
        manifest: DataFrame | None = None, earlier: DataFrame | None = None, fuzzy: bool = True,
        earliest: date = EARLIEST_DATE, publish_to: str | None = None) -> Migration:
    """The whole job; every product is made before it returns.

    Raises RuntimeError when a table gained or lost rows beyond those held. With
    ``publish_to`` the products are left there as named tables of a new version, which
    readers see all at once (see ``sources.publish``).
    """
    job = Migration(sources, as_of, specs, manifest, earlier, fuzzy, earliest)
    tables = job.tables()
    lost = [r["table_name"] for r in job.counts.filter(F.col("status") == "UNEXPECTED DELTA").select("table_name").collect()]
    if lost:
        raise RuntimeError(f"rows gained or lost beyond the held ones in {', '.join(sorted(lost))}")
    if publish_to:
        publish(next(iter(sources.values())).sparkSession, publish_to, tables)
    return job

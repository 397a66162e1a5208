"""Queries for near-duplicates, clusters and master tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlift.functions.similarity import similarity
from ledgerlift.functions.text import name_tokens
from ledgerlift.operators import clusters as K
from ledgerlift.workloads.base import *  # noqa: F403
from ledgerlift.workloads.checks import NO_ORDER, _checked, _plain

# part names stand in for a list of persons with many copies
PARTS = "parts AS (SELECT 'P' || lpad(CAST(p_partkey AS VARCHAR), 8, '0') AS id0, p_name FROM part)"
PART_NAMES = "pn AS " + sql_names("parts", "id0", "p_name", PERSON_TITLES, "trim(name)")


def _parts(spark, sf):
    return table(spark, sf, "part").select(
        F.concat(F.lit("P"), F.lpad(F.col("p_partkey").cast("string"), 8, "0")).alias("employee_id"),
        F.col("p_name").alias("name"))


@query("D1_person_tokens", with_ctes("hr", PERSONS, select="SELECT id, norm, words FROM np"))
def person_tokens(spark, sf):
    return D.person_rows(view(spark, sf, "hr")).select("id", "norm", F.col("words").cast("bigint").alias("words"))


@query("D1_company_tokens", with_ctes("proc", COMPANIES, select="SELECT id, norm, words FROM nc"))
def company_tokens(spark, sf):
    return D.company_rows(view(spark, sf, "procurement")).select(
        "id", "norm", F.col("words").cast("bigint").alias("words"))


@query("D2_person_exact", _checked("hr", sql_person_exact(), more=(PERSONS,)))
def person_exact(spark, sf):
    return _plain(D.person_exact_findings(*D.staged_names(D.person_rows(view(spark, sf, "hr")))))


@query("D2_part_copies", f"WITH {PARTS}, {PART_NAMES} SELECT id, other_id FROM {sql_exact('pn')} x")
def part_copies(spark, sf):
    return D.exact_matches(D.person_rows(_parts(spark, sf))).select("id", "other_id")


@query("D3_person_abbreviation", _checked("hr", sql_person_abbreviation(), more=(PERSONS,)))
def person_abbreviation(spark, sf):
    return _plain(D.person_abbreviation_findings(*D.staged_names(D.person_rows(view(spark, sf, "hr")))))


def _fuzzy_findings(keys: str, *more: str, finding: str) -> str:
    return with_ctes(keys, *more, select=f"SELECT {NO_ORDER} FROM ({finding}) f", recursive=True)


@query("D4_person_fuzzy", _fuzzy_findings("hr", PERSONS, sql_fuzzy("np", True, True, 0.9, "ratio"),
                                          finding=sql_person_fuzzy()))
def person_fuzzy(spark, sf):
    rows, known = D.staged_names(D.person_rows(view(spark, sf, "hr")))
    return _plain(D.person_fuzzy_findings(rows, known=known))


def _fuzzy_parts(metric: str, threshold: float) -> str:
    return (f"WITH RECURSIVE {PARTS}, {PART_NAMES}, {sql_fuzzy('pn', True, True, threshold, metric)} "
            "SELECT id, other_id, score FROM fz")


@query("D4_fuzzy_ratio", _fuzzy_parts("ratio", 0.88))
def fuzzy_ratio(spark, sf):
    rows, known = D.staged_names(D.person_rows(_parts(spark, sf)))
    return D.fuzzy_matches(rows, 0.88, known=known).select("id", "other_id", "score")


@query("D4_fuzzy_levenshtein", _fuzzy_parts("levenshtein", 0.9))
def fuzzy_levenshtein(spark, sf):
    rows, known = D.staged_names(D.person_rows(_parts(spark, sf)))
    return D.fuzzy_matches(rows, 0.9, "levenshtein", known=known).select("id", "other_id", "score")


CUSTOMER_NAMES = ("cn AS (SELECT c_custkey AS id, lower(c_name) AS raw FROM customer)")


@query("D4_similar_customers", f"WITH {CUSTOMER_NAMES} SELECT a.raw AS early, b.raw AS late FROM cn a JOIN cn b "
       f"ON a.id < b.id AND {SIMILAR} >= 0.92")
def similar_customers(spark, sf):
    names = table(spark, sf, "customer").select("c_custkey", "c_name")
    keys = D.name_keys(*D.staged_names(D.person_rows(names, "c_custkey", "c_name")))
    return D.similar_names(keys, 0.92, "levenshtein").select(
        F.col("early.raw").alias("early"), F.col("late.raw").alias("late"))


@query("D5_company_suffix", _checked("proc", sql_company_suffix(), more=(COMPANIES,)))
def company_suffix(spark, sf):
    orders = view(spark, sf, "procurement")
    rows, known = D.staged_names(D.company_rows(orders))
    return _plain(D.company_suffix_findings(rows, orders, known))


@query("D6_company_fuzzy", _fuzzy_findings("proc", COMPANIES, sql_fuzzy("nc", False, False, 0.9, "ratio"),
                                           finding=sql_company_fuzzy()))
def company_fuzzy(spark, sf):
    orders = view(spark, sf, "procurement")
    rows, known = D.staged_names(D.company_rows(orders))
    return _plain(D.company_fuzzy_findings(rows, orders, known=known))


SUPPLIERS = "sup AS (SELECT s_suppkey AS id0, s_name || CASE WHEN s_suppkey % 10 = 7 THEN ' Ltd' ELSE '' END AS nm FROM supplier)"
SUPPLIER_NAMES = "sn AS " + sql_names("sup", "id0", "nm", COMPANY_SUFFIXES, "name")


def _fuzzy_suppliers(metric: str) -> str:
    return (f"WITH RECURSIVE {SUPPLIERS}, {SUPPLIER_NAMES}, {sql_fuzzy('sn', False, False, 0.92, metric)} "
            "SELECT id, other_id, score FROM fz")


def _supplier_matches(spark, sf, metric):
    rows = table(spark, sf, "supplier").select(
        "s_suppkey", F.concat("s_name", F.when(F.col("s_suppkey") % 10 == 7, " Ltd").otherwise("")).alias("nm"))
    names, known = D.staged_names(D.company_rows(rows, "s_suppkey", "nm"))
    return D.fuzzy_matches(names, 0.92, metric, blocked=False, abbreviations=False, known=known).select(
        "id", "other_id", "score")


@query("D6_fuzzy_ratio", _fuzzy_suppliers("ratio"))
def supplier_fuzzy_ratio(spark, sf):
    return _supplier_matches(spark, sf, "ratio")


@query("D6_fuzzy_levenshtein", _fuzzy_suppliers("levenshtein"))
def supplier_fuzzy(spark, sf):
    return _supplier_matches(spark, sf, "levenshtein")


@query("D7_rule_precedence", with_ctes("hr", PERSONS, f"e AS {sql_exact('np')}", f"b AS {sql_abbreviation('np')}",
                                       sql_fuzzy("np", True, True, 0.9), select=(
    "SELECT id, other_id, 1 AS rule_rank FROM e UNION ALL SELECT id, other_id, 2 FROM b UNION ALL "
    "SELECT id, other_id, 3 FROM fz")))
def rule_precedence(spark, sf):
    rows, known = D.staged_names(D.person_rows(view(spark, sf, "hr")))

    def ranked(df, rank):
        return df.select("id", "other_id", F.lit(rank).alias("rule_rank"))

    return ranked(D.exact_matches(rows, known), 1).unionByName(ranked(D.abbreviation_matches(rows, known), 2)).unionByName(
        ranked(D.fuzzy_matches(rows, 0.9, "levenshtein", known=known), 3))


@query("D8_first_order", with_ctes("proc", select="SELECT vendor_id, min(po_id) AS first_po FROM proc GROUP BY vendor_id"))
def first_order(spark, sf):
    return D.first_orders(view(spark, sf, "procurement"))


MANAGED = ("pairs AS (SELECT h.employee_id AS id, h.employee_id AS pid, trim(lower(h.name)) AS a, trim(lower(m.name)) AS b FROM hr h "
           "JOIN hr m ON m.employee_id = h.manager_id)")


def _managed(spark, sf):
    hr = view(spark, sf, "hr")
    m = hr.select(F.col("employee_id").alias("manager_id"), F.trim(F.lower("name")).alias("b"))
    return hr.join(m, "manager_id").select(F.col("employee_id").alias("id"), F.trim(F.lower("name")).alias("a"), "b")


@query("D9_similarity_ratio", with_ctes("hr", MANAGED, sql_ratio("pairs", "r"), recursive=True, select=(
    "SELECT p.id, p.a, p.b, r.score FROM pairs p JOIN r ON r.pid = p.pid")))
def similarity_ratio(spark, sf):
    return _managed(spark, sf).withColumn("score", similarity(F.col("a"), F.col("b")))


@query("D9_similarity_levenshtein", with_ctes("hr", MANAGED, select=(
    "SELECT id, a, b, 1 - 2.0 * levenshtein(a, b) / (len(a) + len(b)) AS score FROM pairs")))
def similarity_levenshtein(spark, sf):
    return _managed(spark, sf).withColumn("score", similarity(F.col("a"), F.col("b"), "levenshtein"))


def person_groups(spark, sf, hr=None):
    return stage(K.person_clusters(hr if hr is not None else view(spark, sf, "hr")), "person-clusters")


def vendor_groups(spark, sf):
    return stage(K.vendor_clusters(view(spark, sf, "procurement")), "vendor-clusters")


@query("D10_vendor_clusters", with_ctes("proc", COMPANIES, *with_similar(VENDOR_EDGES, "nc", False, "ve", "levenshtein"), recursive=True, select=(
    "SELECT DISTINCT p.vendor_id, p.vendor_name, o.orders, vc.cluster FROM proc p JOIN vc ON vc.vendor_id = p.vendor_id "
    "JOIN (SELECT vendor_id, count(*) AS orders FROM proc GROUP BY vendor_id) o ON o.vendor_id = p.vendor_id")))
def vendor_clusters(spark, sf):
    return K.vendor_clusters(view(spark, sf, "procurement"), metric="levenshtein")


@query("D10_vendor_clusters_ratio", with_ctes(
    "proc", COMPANIES, *with_similar(VENDOR_EDGES, "nc", False, "ve"), recursive=True, select=(
        "SELECT DISTINCT p.vendor_id, p.vendor_name, o.orders, vc.cluster FROM proc p JOIN vc ON vc.vendor_id = p.vendor_id "
        "JOIN (SELECT vendor_id, count(*) AS orders FROM proc GROUP BY vendor_id) o ON o.vendor_id = p.vendor_id")))
def vendor_clusters_ratio(spark, sf):
    return K.vendor_clusters(view(spark, sf, "procurement"))


@query("D11_person_clusters", with_ctes("hr", PERSONS, *with_similar(PERSON_EDGES, "np", True, "pe0", "levenshtein"), recursive=True, select="SELECT * FROM pc"))
def person_clusters(spark, sf):
    return K.person_clusters(view(spark, sf, "hr"), metric="levenshtein")


@query("D11_person_clusters_ratio", with_ctes(
    "hr", PERSONS, *with_similar(PERSON_EDGES, "np", True, "pe0"), recursive=True, select="SELECT * FROM pc"))
def person_clusters_ratio(spark, sf):
    return K.person_clusters(view(spark, sf, "hr"))


# every order is linked to the parts it holds; no SQL, as a recursive union over all links does not end in useful
# time; tests compare the operator with a plain union-find
@query("D12_connected_components")
def connected_components(spark, sf):
    links = table(spark, sf, "lineitem").select(
        F.concat(F.lit("O"), "l_orderkey").alias("a"), F.concat(F.lit("P"), "l_partkey").alias("b"))
    return K.connected_components(links)


@query("D12_order_halves", "SELECT node, CASE WHEN node % 2 = 0 THEN node ELSE node - 1 END AS component FROM ("
       "SELECT o_orderkey AS node FROM orders WHERE o_orderkey % 2 = 1 AND o_orderkey - 1 IN (SELECT o_orderkey FROM orders) "
       "UNION ALL SELECT o_orderkey FROM orders WHERE o_orderkey % 2 = 0 AND o_orderkey + 1 IN (SELECT o_orderkey FROM orders)) n")
def order_halves(spark, sf):
    """Orders linked to the order of the next key: each odd key to the even one before it."""
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("a"))
    links = orders.filter("a % 2 = 1").withColumn("b", F.col("a") - 1)
    return K.connected_components(links.join(orders.select(F.col("a").alias("b")), "b"))


@query("D13_canonical_names", with_ctes("proc", *VENDORS, recursive=True, select="SELECT * FROM canon"))
def canonical_names(spark, sf):
    return K.canonical_names(vendor_groups(spark, sf))


@query("D14_vendor_master", with_ctes("proc", *VENDORS, recursive=True, select="SELECT * FROM vmaster"))
def vendor_master(spark, sf):
    return K.vendor_master(vendor_groups(spark, sf))


@query("D14_consolidation", with_ctes("proc", *VENDORS, recursive=True, select=(
    "SELECT count(DISTINCT cluster) AS vendors, count(*) AS raw_variants FROM vcl")))
def consolidation(spark, sf):
    return K.consolidation(vendor_groups(spark, sf))


@query("D15_cluster_members", with_ctes("proc", *VENDORS, recursive=True, select=(
    "SELECT cluster, members, CAST(part AS INTEGER) AS part, string_agg(vendor_id, ', ' ORDER BY vendor_id) AS member_ids FROM ("
    "SELECT cluster, vendor_id, count(*) OVER (PARTITION BY cluster) AS members, "
    "(row_number() OVER (PARTITION BY cluster ORDER BY vendor_id) - 1) // 1000 AS part "
    "FROM (SELECT DISTINCT cluster, vendor_id FROM vcl) d) q WHERE members > 1 GROUP BY cluster, members, part")))
def cluster_members(spark, sf):
    return K.member_list(vendor_groups(spark, sf))


@query("D16_person_master", with_ctes("hr", *GROUPED_PERSONS, recursive=True, select=(
    "SELECT h.employee_id, h.name AS canonical_name, pc.cluster AS cluster_id FROM hr h LEFT JOIN pc ON pc.id = h.employee_id")))
def person_master(spark, sf):
    hr = view(spark, sf, "hr")
    return K.person_master(hr, person_groups(spark, sf, hr))


REVIEW_COLUMNS = ("employee_id, partner_id, partner_name, similarity_score, same_dept_code, same_cost_centre, "
                  "hire_date_delta_days, likely_rows")


def _review(spark, sf, metric="ratio"):
    hr = view(spark, sf, "hr")
    links = D.name_links(D.person_rows(hr), metric=metric)
    return K.person_review(hr, stage(K.person_clusters(hr, links=links), "person-clusters"), links, metric)


@query("D17_pair_review", with_ctes("hr", *reviewed("levenshtein"), recursive=True, select=f"SELECT {REVIEW_COLUMNS} FROM review"))
def pair_review(spark, sf):
    return _review(spark, sf, "levenshtein").select(*REVIEW_COLUMNS.split(", "))


@query("D17_pair_review_ratio", with_ctes("hr", *reviewed("ratio"), recursive=True, select=(
    f"SELECT {REVIEW_COLUMNS}, cluster, cluster_rows, name, recommendation, named_partner_id, named_score FROM review")))
def pair_review_ratio(spark, sf):
    return _review(spark, sf).drop("settle_gap")


@query("D17_review_partners", with_ctes("hr", *reviewed("ratio"), recursive=True, select=(
    "SELECT employee_id AS id, cluster, likely_rows, near_id AS partner_id FROM review")))
def review_partners(spark, sf):
    return _review(spark, sf).select(
        F.col("employee_id").alias("id"), "cluster", "likely_rows",
        F.when(F.col("likely_rows") > 0, F.col("partner_id")).alias("partner_id"))


@query("D18_recommendations", with_ctes("hr", *reviewed("levenshtein"), recursive=True, select=(
    "SELECT employee_id, partner_id, recommendation FROM review")))
def recommendations(spark, sf):
    return _review(spark, sf, "levenshtein").select("employee_id", "partner_id", "recommendation")


@query("D19_review_metrics", with_ctes("hr", *GROUPED_PERSONS, PERSON_ROWS, recursive=True, select=f"""
  SELECT count(DISTINCT a.cluster) AS clusters, count(*) AS pairs, count(*) FILTER ({LIKELY}) AS likely,
    count(*) - count(*) FILTER ({LIKELY}) AS review FROM ph a JOIN ph b ON a.cluster = b.cluster AND a.id < b.id"""))
def review_metrics(spark, sf):
    hr = view(spark, sf, "hr")
    return K.review_metrics(K.review_totals(hr, person_groups(spark, sf, hr)))

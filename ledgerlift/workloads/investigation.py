"""Queries for the analyst's questions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlift.operators import investigate as Q
from ledgerlift.workloads.base import *  # noqa: F403


@query("Q1_missing_cost_centre", with_ctes("exp", select=(
    "SELECT expense_id, employee_id, amount, submitted_date FROM exp WHERE coalesce(trim(cost_centre), '') = ''")))
def q1(spark, sf):
    return Q.missing_cost_centre(view(spark, sf, "expenses"))


@query("Q2_null_overview", with_ctes("proc", select=(
    "SELECT count(*) AS total_rows, count(*) FILTER (vendor_id IS NULL) AS missing_vendor_id, "
    "count(*) FILTER (material_code IS NULL) AS missing_material_code FROM proc")))
def q2(spark, sf):
    return Q.null_overview(view(spark, sf, "procurement"))


@query("Q3_missing_person_facts", with_ctes("hr", select=(
    "SELECT employee_id, job_title, employment_status FROM hr WHERE name IS NULL OR hire_date IS NULL")))
def q3(spark, sf):
    return Q.missing_person_facts(view(spark, sf, "hr"))


@query("Q4_negative_amounts", with_ctes("proc", select=(
    "SELECT po_id, material_code, quantity, unit_price FROM proc WHERE quantity < 0 OR unit_price < 0")))
def q4(spark, sf):
    return Q.negative_amounts(view(spark, sf, "procurement"))


@query("Q5_unknown_currencies", with_ctes("fin", select=(
    "SELECT gl_entry_id, amount, currency FROM fin WHERE currency NOT IN ('GBP', 'EUR', 'USD')")))
def q5(spark, sf):
    return Q.unknown_currencies(view(spark, sf, "finance"))


@query("Q6_ended_before_hired", with_ctes("hr", select=(
    "SELECT employee_id, hire_date, termination_date FROM hr WHERE termination_date < hire_date")))
def q6(spark, sf):
    return Q.ended_before_hired(view(spark, sf, "hr"))


@query("Q7_code_lengths", with_ctes("fin", select=(
    "SELECT len(cost_centre) AS cc_length, count(*) AS row_count FROM fin GROUP BY 1 ORDER BY row_count DESC")))
def q7(spark, sf):
    return Q.code_lengths(view(spark, sf, "finance"))


@query("Q8_unprefixed_codes", with_ctes("exp", select=(
    "SELECT expense_id, cost_centre FROM exp WHERE NOT starts_with(cost_centre, 'CC-')")))
def q8(spark, sf):
    return Q.unprefixed_codes(view(spark, sf, "expenses"))


@query("Q9_odd_currency_lengths", with_ctes("fin", select=(
    "SELECT currency, count(*) AS occurrences FROM fin WHERE len(currency) <> 3 GROUP BY currency")))
def q9(spark, sf):
    return Q.odd_currency_lengths(view(spark, sf, "finance"))


@query("Q9_odd_priority_lengths",
       "SELECT o_orderpriority AS currency, count(*) AS occurrences FROM orders WHERE len(o_orderpriority) <> 3 GROUP BY 1")
def q9_priorities(spark, sf):
    return Q.odd_currency_lengths(table(spark, sf, "orders").withColumnRenamed("o_orderpriority", "currency"))


def _listed(key: str, entry: str, order: str, source: str, name: str, out: str) -> str:
    return (f"SELECT {name}, duplicate_count, CAST(part AS INTEGER) AS part, string_agg(e, ', ' ORDER BY o, e) AS {out} FROM ("
            f"SELECT {key} AS {name}, {entry} AS e, {order} AS o, count(*) OVER (PARTITION BY {key}) AS duplicate_count, "
            f"(row_number() OVER (PARTITION BY {key} ORDER BY {order}, {entry}) - 1) // 1000 AS part FROM {source}) q "
            f"WHERE duplicate_count > 1 GROUP BY {name}, duplicate_count, part")


@query("Q10_orders_by_status", _listed("o_orderstatus", "o_orderkey", "o_orderkey", "orders", "name", "employee_ids"))
def q10_statuses(spark, sf):
    """Groups of thousands: every part of 1,000 entries in order."""
    return Q.same_names(table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("employee_id"), F.col("o_orderstatus").alias("name")))


@query("Q10_same_names", with_ctes("hr", select=_listed("name", "employee_id", "employee_id", "hr", "name", "employee_ids")))
def q10(spark, sf):
    return Q.same_names(view(spark, sf, "hr"))


@query("Q10_same_part_names",
       "WITH p AS (SELECT 'P' || lpad(CAST(p_partkey AS VARCHAR), 8, '0') AS employee_id, p_name AS name FROM part) "
       + _listed("name", "employee_id", "employee_id", "p", "name", "employee_ids"))
def q10_parts(spark, sf):
    return Q.same_names(table(spark, sf, "part").selectExpr(
        "concat('P', lpad(cast(p_partkey as string), 8, '0')) AS employee_id", "p_name AS name"))


@query("Q11_near_same_names", with_ctes("hr", select=_listed(
    "lower(replace(name, ' ', ''))", "employee_id || ' (' || name || ')'", "employee_id", "hr", "normalized_name", "employees")))
def q11(spark, sf):
    return Q.near_same_names(view(spark, sf, "hr"))


@query("Q12_near_same_vendors", with_ctes("proc", "v AS (SELECT DISTINCT vendor_id, vendor_name FROM proc)", select=_listed(
    "lower(replace(replace(vendor_name, ' Ltd', ''), ' PLC', ''))", "vendor_id || ' (' || vendor_name || ')'", "vendor_id",
    "v", "normalized_name", "vendors")))
def q12(spark, sf):
    return Q.near_same_vendors(view(spark, sf, "procurement"))


@query("Q13_orphaned_vendors", with_ctes("proc fin", select=(
    "SELECT gl_entry_id, vendor_id, amount FROM fin WHERE vendor_id NOT IN (SELECT vendor_id FROM proc)")))
def q13(spark, sf):
    return Q.orphaned_vendors(view(spark, sf, "finance"), view(spark, sf, "procurement"))


@query("Q14_orphaned_employees", with_ctes("hr exp", select=(
    "SELECT expense_id, employee_id, amount FROM exp WHERE employee_id IS NULL OR employee_id NOT IN (SELECT employee_id FROM hr)")))
def q14(spark, sf):
    return Q.orphaned_employees(view(spark, sf, "expenses"), view(spark, sf, "hr"))


@query("Q14_unlabelled_documents",
       "SELECT doc_id, lang, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def q14_documents(spark, sf):
    return C.orphans(table(spark, sf, "documents").select("doc_id", "lang", "source"), "doc_id",
                     table(spark, sf, "labels"), "doc_id", include_null=True).select("doc_id", "lang", "source")


@query("Q15_active_but_ended", with_ctes("hr", select=(
    "SELECT employee_id, name, employment_status, termination_date FROM hr WHERE employment_status = 'Active' AND "
    f"termination_date <= DATE '{AS_OF}'")))
def q15(spark, sf):
    return Q.active_but_ended(view(spark, sf, "hr"), AS_OF)

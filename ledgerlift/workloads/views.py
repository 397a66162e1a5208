"""Source-shaped tables derived from the test tables; the same text runs in Spark and DuckDB."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession

from ledgerlift.sources.readers import spread

AS_OF = date(2024, 12, 31)
# the test tables start in 1995; the first days of that year serve as out of range
EARLIEST = date(1995, 1, 10)

# domain key -> (base table, defining query)
VIEWS = {
    "hr": ("customer", """
SELECT concat('EMP-', lpad(CAST(k AS STRING), 8, '0')) AS employee_id,
 CASE WHEN k % 25 = 2 THEN 'Sam Hotname' WHEN k % 50 = 11 THEN concat(first, ' ', substr(last, 1, 7), 'q') WHEN k % 50 = 49 THEN concat(first, ' ', substr(last, 1, 1), '.') WHEN k % 50 = 37 THEN concat(first, ' ', last, ' ')
      WHEN k % 50 = 21 THEN concat('Dr ', first, ' ', last) ELSE concat(first, ' ', last) END AS name,
 CASE WHEN k % 25 = 2 THEN 'D2' ELSE concat('D', CAST(b % 8 AS STRING)) END AS dept_code, seg AS job_title,
 CASE WHEN k % 60 <> 17 THEN DATE '2015-01-01' + CAST(b % 3000 AS INT) END AS hire_date,
 CASE WHEN k % 20 = 3 THEN DATE '2015-01-01' + CAST(b % 3000 + 300 AS INT) WHEN k % 83 = 4 THEN DATE '2017-06-01' END AS termination_date,
 CASE WHEN k % 20 = 3 THEN 'Terminated' ELSE 'Active' END AS employment_status,
 CASE WHEN k % 75 = 2 THEN 'CC-002' WHEN k % 25 = 2 THEN 'CC-003' ELSE concat('CC-', lpad(CAST(b % 15 + 1 AS STRING), 3, '0')) END AS cost_centre,
 CASE WHEN k > 0 THEN concat('EMP-', lpad(CAST(k % 10 AS STRING), 8, '0')) END AS manager_id
FROM (SELECT *, translate(substr(md5(concat('f', CAST(b % 997 AS STRING))), 1, 6), '0123456789','ghijklmnop') AS first,
             translate(substr(md5(concat('l', CAST(b AS STRING))), 1, 8), '0123456789','ghijklmnop') AS last
      FROM (SELECT c_custkey AS k, c_mktsegment AS seg, CASE WHEN c_custkey % 50 IN (49, 37, 21, 11) THEN c_custkey - 1 ELSE c_custkey END AS b FROM customer) x) y
"""),
    "procurement": ("lineitem", """
SELECT concat('PO-', lpad(CAST(o AS STRING), 9, '0'), '-', CAST(ln AS STRING), '-', CAST(p AS STRING), '-', CAST(k AS STRING), '-', CAST(CAST(q AS INT) AS STRING), '-', CAST(d AS STRING)) AS po_id,
 concat('VEND-', lpad(CAST(k AS STRING), 6, '0')) AS vendor_id,
 concat(translate(substr(md5(concat('v', CAST(b AS STRING))), 1, CASE WHEN k % 10 = 4 THEN 11 ELSE 12 END), '0123456789','ghijklmnop'), CASE WHEN k % 10 = 7 THEN ' Ltd' WHEN k % 10 = 4 THEN 'q' ELSE '' END) AS vendor_name,
 concat('MAT-', CAST(p AS STRING)) AS material_code,
 CAST(CASE WHEN o % 89 = 8 AND ln = 1 THEN -q ELSE q END AS BIGINT) AS quantity,
 price AS unit_price, d AS po_date, st AS delivery_status, CASE WHEN o % 97 = 5 THEN substr(concat('CC-', lpad(CAST(o % 15 + 1 AS STRING), 3, '0')),4) WHEN o % 97 = 11 THEN concat('C', substr(concat('CC-', lpad(CAST(o % 15 + 1 AS STRING), 3, '0')),4)) WHEN o % 101 = 7 THEN '' ELSE concat('CC-', lpad(CAST(o % 15 + 1 AS STRING), 3, '0')) END AS cost_centre
FROM (SELECT l_orderkey AS o, l_linenumber AS ln, l_partkey AS p, l_suppkey AS k, l_quantity AS q, l_extendedprice AS price, CAST(l_shipdate AS DATE) AS d, l_linestatus AS st,
      CASE WHEN l_suppkey % 10 IN (7, 4) THEN l_suppkey - 1 ELSE l_suppkey END AS b FROM lineitem) x
"""),
    "finance": ("orders", """
SELECT concat('GL-', lpad(CAST(o_orderkey AS STRING), 9, '0')) AS gl_entry_id, CASE WHEN o_orderkey % 97 = 5 THEN substr(concat('CC-', lpad(CAST(o_orderkey % 15 + 1 AS STRING), 3, '0')),4) WHEN o_orderkey % 97 = 11 THEN concat('C', substr(concat('CC-', lpad(CAST(o_orderkey % 15 + 1 AS STRING), 3, '0')),4)) WHEN o_orderkey % 101 = 7 THEN '' ELSE concat('CC-', lpad(CAST(o_orderkey % 15 + 1 AS STRING), 3, '0')) END AS cost_centre,
 CAST(o_custkey % 5 * 100 + 400100 AS BIGINT) AS account_code, o_totalprice AS amount,
 CASE WHEN o_orderkey % 113 = 3 THEN 'GPB' WHEN o_orderkey % 10 = 0 THEN 'USD' WHEN o_orderkey % 10 = 1 THEN 'EUR' ELSE 'GBP' END AS currency,
 CAST(o_orderdate AS DATE) AS posting_date, o_orderstatus AS document_type,
 CASE WHEN o_orderkey % 211 = 9 THEN 'VEND-999999' ELSE concat('VEND-', lpad(CAST(o_custkey % 10 AS STRING), 6, '0')) END AS vendor_id
FROM orders
"""),
    "expenses": ("events", """
SELECT concat('EXP-', lpad(CAST(event_id AS STRING), 9, '0')) AS expense_id,
 CASE WHEN event_id % 251 = 6 THEN 'EMP-99999999' ELSE concat('EMP-', lpad(CAST(user_id AS STRING), 8, '0')) END AS employee_id,
 CASE WHEN event_id % 67 = 2 THEN '' ELSE concat('CC-', lpad(CAST(event_id % 15 + 1 AS STRING), 3, '0')) END AS cost_centre, event_type AS category, value AS amount,
 CAST(ts AS DATE) AS submitted_date,
 CASE event_id % 3 WHEN 0 THEN 'Approved' WHEN 1 THEN 'Pending' ELSE 'Rejected' END AS approval_status, 'GBP' AS currency
FROM events
"""),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def view(spark: SparkSession, sf_dir: str, key: str) -> DataFrame:
    base, query = VIEWS[key]
    return spark.sql(query.replace(f"FROM {base}", "FROM {base}"), base=table(spark, sf_dir, base))


def views(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {key: view(spark, sf_dir, key) for key in VIEWS}


# short names of the views in the checking SQL
SHORT = {"hr": "hr", "finance": "fin", "procurement": "proc", "expenses": "exp"}


def ctes(*keys: str, suffix: str = "") -> str:
    """The views as common table expressions."""
    return ",\n".join(f"{SHORT[k]}{suffix} AS ({VIEWS[k][1]})" for k in (keys or VIEWS))

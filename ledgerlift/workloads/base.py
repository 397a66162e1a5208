"""The query registry and the SQL fragments several checks share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlift.operators import checks as C
from ledgerlift.operators import duplicates as D
from ledgerlift.operators import issues as I
from ledgerlift.operators import policy as P
from ledgerlift.operators import wording as W
from ledgerlift.plans.pipeline import Migration, map_all
from ledgerlift.schemas import COMPANY_SUFFIXES, DOMAINS, ISSUE_TYPES, PERSON_TITLES
from ledgerlift.sources.spec import default_spec
from ledgerlift.sources.stages import stage
from ledgerlift.workloads.views import AS_OF, EARLIEST, SHORT, VIEWS, ctes, table, view, views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query and the SQL that must give the same rows."""
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return register


def with_ctes(keys: str, *more: str, select: str, recursive: bool = True) -> str:
    """WITH over the named views (space separated short names) and further expressions."""
    long = {v: k for k, v in SHORT.items()}
    parts = [ctes(long[k]) for k in keys.split()] + list(more)
    return f"WITH {'RECURSIVE ' if recursive else ''}" + ",\n".join(parts) + "\n" + select


# --- findings in SQL ------------------------------------------------------------

COLUMNS = ("check_order, domain, table_name, column_name, row_identifier, issue_type, description, "
           "confidence, detection_rule")


def _finding(key: str, column: str, issue_type: str, description: str, confidence: str, rule: str, where: str,
             source: str | None = None, row: str | None = None) -> str:
    d = DOMAINS[key]
    return (f"SELECT {C.ORDER[rule]} AS check_order, '{d.label}' AS domain, '{d.table}' AS table_name, "
            f"'{column}' AS column_name, {row or d.row_id} AS row_identifier, '{issue_type}' AS issue_type, "
            f"{description} AS description, '{confidence}' AS confidence, '{rule}' AS detection_rule "
            f"FROM {source or SHORT[key]} WHERE {where}")


def sql_blank(key: str) -> str:
    return " UNION ALL ".join(
        _finding(key, c, "completeness", f"'{c.replace('_', ' ')} is missing (blank) on this record.'", "high",
                 "null_check", f"({c} IS NULL OR trim(CAST({c} AS VARCHAR)) = '')")
        for c in DOMAINS[key].required)


SQL_NEGATIVE = _finding(
    "procurement", "quantity", "accuracy",
    "'Quantity is negative (' || CAST(quantity AS VARCHAR) || ') - not a valid PO quantity.'",
    "high", "negative_value", "quantity < 0")


def sql_currency(key: str) -> str:
    return _finding(
        key, "currency", "accuracy",
        "'Currency code ''' || currency || ''' is not a recognised code (expected one of "
        "[''EUR'', ''GBP'', ''USD'']) - likely a typo.'",
        "high", "invalid_currency", "currency IS NOT NULL AND currency NOT IN ('EUR', 'GBP', 'USD')")


def sql_dates(key: str, earliest: str = str(EARLIEST)) -> str:
    return " UNION ALL ".join(
        _finding(key, c, "accuracy",
                 f"'{c.replace('_', ' ')} (' || CAST({c} AS VARCHAR) || ') falls outside the plausible range "
                 f"({earliest} to today).'",
                 "medium", "date_out_of_bounds", f"{c} < DATE '{earliest}' OR {c} > DATE '{AS_OF}'")
        for c in DOMAINS[key].dates)


def sql_format(key: str) -> str:
    return _finding(
        key, "cost_centre", "consistency",
        "'cost_centre is stored as ''' || cost_centre || ''', which doesn''t match the standard ''CC-0NN'' format "
        "used elsewhere - likely the same cost centre recorded in a different format.'",
        "high", "cost_centre_format_drift",
        "cost_centre <> '' AND NOT regexp_full_match(cost_centre, 'CC-[0-9]{3}')")


SQL_CONTRADICTION = _finding(
    "hr", "employment_status", "consistency",
    "'Employee is marked ''Active'' but has a termination_date in the past (' || CAST(termination_date AS VARCHAR) "
    "|| ') - contradictory record.'",
    "high", "status_date_contradiction",
    f"employment_status = 'Active' AND termination_date < DATE '{AS_OF}'")

SQL_ORPHAN_VENDOR = _finding(
    "finance", "vendor_id", "obsolete_orphaned",
    "'References vendor_id ''' || vendor_id || ''', which does not exist anywhere in Procurement - orphaned reference.'",
    "high", "orphan_fk", "vendor_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM proc p WHERE p.vendor_id = fin.vendor_id)")

SQL_ORPHAN_EMPLOYEE = _finding(
    "expenses", "employee_id", "obsolete_orphaned",
    "'References employee_id ''' || employee_id || ''', which does not exist in HR - likely a leaver whose record was "
    "never deactivated or reassigned.'",
    "high", "orphan_fk", "employee_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM hr h WHERE h.employee_id = exp.employee_id)")


def sql_names(source: str, row: str, name: str, drop: tuple[str, ...], shown: str) -> str:
    """id, name, shown, raw, norm, first, last, words"""
    words = ", ".join(f"'{w}'" for w in drop)
    return f"""(SELECT id, name, shown, lower(shown) AS raw, array_to_string(toks, ' ') AS norm, toks[1] AS first,
      toks[-1] AS last, len(toks) AS words
    FROM (SELECT id, name, {shown} AS shown,
            list_filter(list_transform(string_split_regex(trim(name), '\\s+'), lambda x: lower(trim(x, '.,'))),
                        lambda x: x NOT IN ({words})) AS toks
          FROM (SELECT DISTINCT {row} AS id, {name} AS name FROM {source}) q0 WHERE name IS NOT NULL) q1
    WHERE trim(array_to_string(toks, ' ')) <> '')"""


PERSONS = "np AS " + sql_names("hr", "employee_id", "name", PERSON_TITLES, "trim(name)")
COMPANIES = "nc AS " + sql_names("proc", "vendor_id", "vendor_name", COMPANY_SUFFIXES, "name")


def sql_exact(names: str) -> str:
    return (f"(SELECT id, shown, other_id, other_name FROM (SELECT id, shown, min(id) OVER w AS other_id, "
            f"first_value(shown) OVER (PARTITION BY norm ORDER BY id) AS other_name FROM {names} "
            f"WINDOW w AS (PARTITION BY norm)) x WHERE id > other_id)")


ABBREVIATES = ("a.first = b.first AND a.words >= 2 AND b.words >= 2 AND a.last <> b.last AND "
               "((len(a.last) = 1 AND starts_with(b.last, a.last)) OR (len(b.last) = 1 AND starts_with(a.last, b.last)))")


def sql_abbreviation(names: str) -> str:
    return (f"(SELECT b.id, b.shown, min(a.id) AS other_id, arg_min(a.shown, a.id) AS other_name "
            f"FROM {names} a JOIN {names} b ON a.id < b.id AND {ABBREVIATES} GROUP BY b.id, b.shown)")


SIMILAR = "(1 - 2.0 * levenshtein(a.raw, b.raw) / (len(a.raw) + len(b.raw)))"


def sql_ratio(pairs: str, name: str) -> str:
    """<name>(pid, score) for ``pairs(pid, a, b)``: longest common block, then the same left and right of it.

    Of equally long blocks the first in a, then the first in b, is taken.
    """
    longest = ("list_max(flatten(list_transform(range(1, len(a) + 1), lambda i: list_transform(list_filter("
               "range(1, len(a) - i + 2), lambda k: instr(b, substr(a, i, k)) > 0), lambda k: k * 1000 + 999 - i))))")
    return f"""{name}_blocks AS (SELECT pid, a, b, CAST(0 AS BIGINT) AS k, 0 AS depth FROM {pairs}
  UNION ALL SELECT pid, x.a, x.b, x.k, depth + 1 FROM (SELECT pid, depth, unnest([
      {{'a': substr(a, 1, i - 1), 'b': substr(b, 1, j - 1), 'k': n}}, {{'a': substr(a, i + n), 'b': substr(b, j + n), 'k': 0}}]) AS x
    FROM (SELECT *, instr(b, substr(a, i, n)) AS j FROM (SELECT pid, a, b, depth, CAST(code // 1000 AS BIGINT) AS n,
        CAST(999 - code % 1000 AS BIGINT) AS i FROM (SELECT pid, a, b, depth, {longest} AS code FROM {name}_blocks
          WHERE a <> '' AND b <> '') q1 WHERE code IS NOT NULL) q2) q3) q4),
{name} AS (SELECT pid, CAST(2 AS DOUBLE) * sum(k) / max(CASE WHEN depth = 0 THEN len(a) + len(b) END) AS score
  FROM {name}_blocks GROUP BY pid)"""


def sql_pairs(names: str, blocked: bool, abbreviations: bool) -> str:
    """Earlier (a) and later (b) row of every pair no earlier rule has flagged."""
    block = "AND substr(a.first, 1, 3) = substr(b.first, 1, 3)" if blocked else ""
    short = f"AND NOT ({ABBREVIATES})" if abbreviations else ""
    return (f"(SELECT a.id AS aid, a.raw AS araw, a.shown AS ashown, b.id AS bid, b.raw AS braw, b.shown AS bshown "
            f"FROM {names} a JOIN {names} b ON a.id < b.id {block} AND NOT (a.norm = b.norm "
            f"AND a.id = (SELECT min(c.id) FROM {names} c WHERE c.norm = a.norm)) {short})")


def sql_fuzzy(names: str, blocked: bool, abbreviations: bool, threshold: float, metric: str = "levenshtein",
              out: str = "fz") -> str:
    """<out>(id, shown, other_id, other_name, score), by either metric."""
    pairs = f"{out}_pairs AS {sql_pairs(names, blocked, abbreviations)}"
    if metric == "levenshtein":
        scored = (f"{out}_scores AS (SELECT DISTINCT araw, braw, 1 - 2.0 * levenshtein(araw, braw) / (len(araw) + len(braw)) "
                  f"AS score FROM {out}_pairs)")
    else:
        scored = (f"{out}_dist AS (SELECT DISTINCT araw || chr(31) || braw AS pid, araw AS a, braw AS b FROM {out}_pairs),\n"
                  + sql_ratio(f"{out}_dist", f"{out}_r")
                  + f",\n{out}_scores AS (SELECT d.a AS araw, d.b AS braw, r.score FROM {out}_dist d JOIN {out}_r r ON r.pid = d.pid)")
    return (f"{pairs},\n{scored},\n{out} AS (SELECT p.bid AS id, p.bshown AS shown, min(p.aid) AS other_id, "
            f"arg_min(p.ashown, p.aid) AS other_name, arg_min(s.score, p.aid) AS score FROM {out}_pairs p JOIN {out}_scores s "
            f"ON s.araw = p.araw AND s.braw = p.braw WHERE s.score >= {threshold} GROUP BY p.bid, p.bshown)")


# --- clusters and the review in SQL -----------------------------------------------

# components over given edges: vendors and persons by the exact rules
VENDOR_EDGES = ("ve AS (SELECT a.id AS a, b.id AS b FROM nc a JOIN nc b ON a.norm = b.norm AND a.id <> b.id)",
                "vr AS (SELECT id AS node, id AS seen FROM nc UNION SELECT r.node, e.b FROM vr r JOIN ve e ON e.a = r.seen)",
                "vc AS (SELECT node AS vendor_id, min(seen) AS cluster FROM vr GROUP BY node)")
PERSON_EDGES = (f"pe0 AS (SELECT a.id AS a, b.id AS b FROM np a JOIN np b ON a.id <> b.id AND (a.norm = b.norm OR ({ABBREVIATES})))",
                "pr AS (SELECT id AS node, id AS seen FROM np UNION SELECT r.node, e.b FROM pr r JOIN pe0 e ON e.a = r.seen)",
                "pc0 AS (SELECT node AS id, min(seen) AS cluster FROM pr GROUP BY node)",
                "pc AS (SELECT id, cluster, cluster_rows FROM (SELECT id, cluster, count(*) OVER (PARTITION BY cluster) "
                "AS cluster_rows FROM pc0) q WHERE cluster_rows > 1)")


def with_similar(edges: tuple[str, ...], names: str, blocked: bool, edge: str, metric: str = "ratio") -> tuple[str, ...]:
    """Component expressions whose edges include similar names."""
    out = f"fz_{names}"
    fuzzy = sql_fuzzy(names, blocked, False, 0.9, metric, out)
    first = edges[0].replace(f"{edge} AS (", f"{edge}_exact AS (", 1)
    union = f"{edge} AS (SELECT a, b FROM {edge}_exact UNION SELECT aid, bid FROM {out}_all UNION SELECT bid, aid FROM {out}_all)"
    every = (f"{out}_all AS (SELECT p.aid, p.bid, p.araw, p.braw FROM {out}_pairs p JOIN {out}_scores s "
             "ON s.araw = p.araw AND s.braw = p.braw WHERE s.score >= 0.9)")
    return (first, fuzzy, every, union, *edges[1:])


GROUPED_PERSONS = (PERSONS, *with_similar(PERSON_EDGES, "np", True, "pe0"))
GROUPED_VENDORS = (COMPANIES, *with_similar(VENDOR_EDGES, "nc", False, "ve"))
VENDOR_TABLES = ("""vcl AS (SELECT DISTINCT p.vendor_id, p.vendor_name, o.orders, vc.cluster FROM proc p
  JOIN vc ON vc.vendor_id = p.vendor_id JOIN (SELECT vendor_id, count(*) AS orders FROM proc GROUP BY vendor_id) o
  ON o.vendor_id = p.vendor_id)""",
           """canon AS (SELECT cluster, vendor_name AS canonical_vendor_name, members FROM (SELECT cluster, vendor_name,
  row_number() OVER (PARTITION BY cluster ORDER BY orders DESC, len(vendor_name) DESC, vendor_name) AS rn,
  count(*) OVER (PARTITION BY cluster) AS members FROM vcl) q WHERE rn = 1)""",
           "vmaster AS (SELECT DISTINCT v.vendor_id, c.canonical_vendor_name FROM vcl v JOIN canon c ON c.cluster = v.cluster)")
VENDORS = (*GROUPED_VENDORS, *VENDOR_TABLES)
PERSON_ROWS = ("ph AS (SELECT h.employee_id AS id, h.name, lower(trim(h.name)) AS raw, h.dept_code, h.cost_centre, h.hire_date, "
               "pc.cluster, pc.cluster_rows FROM hr h JOIN pc ON pc.id = h.employee_id)")
LIKELY = ("a.dept_code IS NOT DISTINCT FROM b.dept_code AND a.cost_centre IS NOT DISTINCT FROM b.cost_centre AND "
          "coalesce(abs(date_diff('day', a.hire_date, b.hire_date)) <= 30, false)")


def _scores(pairs: str, name: str, metric: str) -> str:
    """<name>(a, b, score) for the distinct texts of ``pairs(a, b)``."""
    if metric == "levenshtein":
        return f"{name} AS (SELECT DISTINCT a, b, 1 - 2.0 * levenshtein(a, b) / (len(a) + len(b)) AS score FROM {pairs})"
    return (f"{name}_d AS (SELECT DISTINCT a || chr(31) || b AS pid, a, b FROM {pairs}), " + sql_ratio(f"{name}_d", f"{name}_r")
            + f", {name} AS (SELECT d.a, d.b, r.score FROM {name}_d d JOIN {name}_r r ON r.pid = d.pid)")


def reviewed(metric: str = "ratio", persons: bool = True, no_issue: str = "false") -> tuple[str, ...]:
    """review(...): one row per record of a cluster; ``no_issue`` tells of row b whether it has no issue."""
    similar = with_similar(PERSON_EDGES, "np", True, "pe0", metric)
    return (*((PERSONS, *similar) if persons else ()), PERSON_ROWS,
            # partners by name: of each rule the first row, then the best score
            f"""linked AS (
    SELECT a.id, min(b.id) AS pid FROM np a JOIN np b ON a.norm = b.norm AND a.id <> b.id GROUP BY a.id
    UNION SELECT a.id, min(b.id) FROM np a JOIN np b ON {ABBREVIATES} GROUP BY a.id
    UNION SELECT a.id, b.first_id FROM np a JOIN (
        SELECT araw AS x, braw AS y FROM fz_np_all f JOIN np p ON p.id = f.aid JOIN np q ON q.id = f.bid WHERE p.norm <> q.norm
        UNION SELECT braw, araw FROM fz_np_all f JOIN np p ON p.id = f.aid JOIN np q ON q.id = f.bid WHERE p.norm <> q.norm) s
      ON s.x = a.raw JOIN (SELECT raw, min(id) AS first_id FROM np GROUP BY raw) b ON b.raw = s.y)""",
            """named0 AS (SELECT p.id, l.pid, CASE WHEN p.id < l.pid THEN p.raw ELSE q.raw END AS a,
    CASE WHEN p.id < l.pid THEN q.raw ELSE p.raw END AS b FROM linked l JOIN np p ON p.id = l.id JOIN np q ON q.id = l.pid)""",
            _scores("named0", "nscore", metric),
            """named AS (
    SELECT p.id, coalesce(same.pid, o.pid) AS named_id, CASE WHEN same.pid IS NOT NULL THEN 1.0 ELSE o.score END AS named_score
    FROM np p LEFT JOIN (SELECT a.id, min(b.id) AS pid FROM np a JOIN np b ON a.raw = b.raw AND a.id <> b.id GROUP BY a.id) same
        ON same.id = p.id
      LEFT JOIN (SELECT n.id, n.pid, s.score, row_number() OVER (PARTITION BY n.id ORDER BY s.score DESC, n.pid) AS place
        FROM named0 n JOIN nscore s ON s.a = n.a AND s.b = n.b) o ON o.id = p.id AND o.place = 1)""",
            f"""hires AS (SELECT a.id, b.id AS pid, abs(date_diff('day', a.hire_date, b.hire_date)) AS gap, {no_issue} AS free
    FROM ph a JOIN ph b ON a.cluster = b.cluster AND a.id <> b.id AND {LIKELY})""",
            """near AS (SELECT id, any_value(likely_rows) AS likely_rows, min(gap) AS gap, min(settle) AS settle_gap,
      coalesce(min(pid) FILTER (pid < id AND gap = least), CASE WHEN any_value(least) = 0 THEN max(pid) FILTER (gap = least)
        ELSE min(pid) FILTER (gap = least) END) AS near_id
    FROM (SELECT *, count(*) OVER (PARTITION BY id) AS likely_rows, min(gap) OVER (PARTITION BY id) AS least,
        CASE WHEN pid > id OR free THEN gap END AS settle FROM hires) h GROUP BY id)""",
            """chosen AS (SELECT a.*, b.id AS pid, b.name AS pname, b.dept_code AS pdept, b.cost_centre AS pcentre, b.hire_date AS pdate,
      n.named_id, n.named_score, r.near_id, r.settle_gap, coalesce(r.likely_rows, 0) AS likely_rows,
      CASE WHEN a.id < b.id THEN a.raw ELSE lower(trim(b.name)) END AS left_raw,
      CASE WHEN a.id < b.id THEN lower(trim(b.name)) ELSE a.raw END AS right_raw
    FROM ph a JOIN named n ON n.id = a.id LEFT JOIN near r ON r.id = a.id JOIN hr h2 ON h2.employee_id = coalesce(r.near_id, n.named_id)
      JOIN (SELECT employee_id AS id, name, dept_code, cost_centre, hire_date FROM hr) b ON b.id = h2.employee_id)""",
            _scores("(SELECT left_raw AS a, right_raw AS b FROM chosen)", "cscore", metric),
            """review AS (SELECT c.id AS employee_id, cluster, cluster_rows, name, pid AS partner_id, pname AS partner_name,
      s.score AS similarity_score, dept_code IS NOT DISTINCT FROM pdept AS same_dept_code,
      cost_centre IS NOT DISTINCT FROM pcentre AS same_cost_centre, abs(date_diff('day', hire_date, pdate)) AS hire_date_delta_days,
      likely_rows, CASE WHEN dept_code IS NOT DISTINCT FROM pdept AND cost_centre IS NOT DISTINCT FROM pcentre
        AND abs(date_diff('day', hire_date, pdate)) <= 30 THEN 'likely_duplicate' ELSE 'needs_human_review' END AS recommendation,
      named_id AS named_partner_id, named_score, near_id, settle_gap
    FROM chosen c JOIN cscore s ON s.a = c.left_raw AND s.b = c.right_raw)""")



def sql_person_exact() -> str:
    return _finding("hr", "name", "duplication",
                    "'Name ''' || shown || ''' matches ' || other_id || ' (''' || other_name || ''') exactly once "
                    "whitespace/case differences are ignored - likely the same person entered twice.'",
                    "high", "exact_name_match", "true", sql_exact("np") + " x", "id")


def sql_person_abbreviation() -> str:
    return _finding("hr", "name", "duplication",
                    "'Name ''' || shown || ''' appears to abbreviate the surname on ' || other_id || ' (''' || other_name "
                    "|| ''') to an initial - likely the same person entered twice.'",
                    "medium", "name_abbreviation", "true", sql_abbreviation("np") + " x", "id")


PERCENT = "CAST(CAST(round_even(score * 100, 0) AS INTEGER) AS VARCHAR) || '%'"


def sql_person_fuzzy(source: str = "fz") -> str:
    return _finding("hr", "name", "duplication",
                    f"'Name ''' || shown || ''' is a ' || {PERCENT} || ' textual match to ' || other_id || ' (''' || "
                    "other_name || ''') - possible duplicate entry.'",
                    "medium", "fuzzy_name_match", "true", source, "id")


def sql_company_fuzzy(source: str = "fz") -> str:
    return _finding("procurement", "vendor_name", "duplication",
                    f"'Vendor ''' || shown || ''' (' || id || ') is a ' || {PERCENT} || ' textual match to ''' || other_name "
                    "|| ''' (' || other_id || ') - possible duplicate vendor master record.'",
                    "medium", "fuzzy_name_match", "true",
                    source + " x JOIN (SELECT vendor_id, min(po_id) AS first_po FROM proc GROUP BY vendor_id) f "
                    "ON f.vendor_id = x.id", "first_po")


def sql_company_suffix() -> str:
    return _finding("procurement", "vendor_name", "duplication",
                    "'Vendor ''' || shown || ''' (' || id || ') matches ''' || other_name || ''' (' || other_id || ') once "
                    "common company suffixes (Ltd/PLC/Inc/etc.) are ignored - likely the same vendor entered as two "
                    "master records.'",
                    "high", "company_suffix_match", "true",
                    sql_exact("nc") + " x JOIN (SELECT vendor_id, min(po_id) AS first_po FROM proc GROUP BY vendor_id) f "
                    "ON f.vendor_id = x.id", "first_po")


def sql_all_findings() -> str:
    keys = ("hr", "finance", "procurement", "expenses")
    parts = [sql_blank(k) for k in keys] + [SQL_NEGATIVE, sql_currency("finance"), sql_currency("expenses")]
    parts += [sql_dates(k) for k in keys] + [sql_format(k) for k in keys]
    parts += [SQL_CONTRADICTION, sql_person_exact(), sql_person_abbreviation(), sql_company_suffix(),
              sql_person_fuzzy("fzp"), sql_company_fuzzy("fzc"), SQL_ORPHAN_VENDOR, SQL_ORPHAN_EMPLOYEE]
    return "raw_findings AS (" + " UNION ALL ".join(parts) + ")"


def _fuzzy_of(names: str, out: str, more: str = "") -> str:
    """The earliest similar row of each row, from the pairs that the clusters use."""
    return (f"{out} AS (SELECT p.bid AS id, p.bshown AS shown, min(p.aid) AS other_id, arg_min(p.ashown, p.aid) AS other_name, "
            f"arg_min(s.score, p.aid) AS score FROM fz_{names}_pairs p JOIN fz_{names}_scores s ON s.araw = p.araw "
            f"AND s.braw = p.braw JOIN {names} a ON a.id = p.aid AND a.raw = p.araw JOIN {names} b ON b.id = p.bid "
            f"AND b.raw = p.braw WHERE s.score >= 0.9 {more} GROUP BY p.bid, p.bshown)")


FINDINGS = ",\n".join([
    *GROUPED_PERSONS, *GROUPED_VENDORS, _fuzzy_of("np", "fzp", f"AND NOT ({ABBREVIATES})"), _fuzzy_of("nc", "fzc"),
    sql_all_findings(),
    "findings AS (SELECT row_number() OVER (ORDER BY check_order, table_name, column_name, row_identifier, description) "
    "AS finding_id, * FROM raw_findings)",
])
# the log before anything is resolved
ISSUES = (
    "issue_open AS (SELECT finding_id, printf('ISSUE-%03d', finding_id) AS issue_id, domain, table_name, column_name, "
    "row_identifier, issue_type, detection_rule, description AS finding, '[' || row_identifier || '] ' || description "
    "AS description, 'Open' AS status, 'Pending' AS resolution FROM findings)"
)
CODE = """CASE WHEN cost_centre IS NULL OR trim(cost_centre) = '' THEN NULL
    WHEN regexp_full_match(cost_centre, '[0-9]{3}') THEN 'CC-' || cost_centre
    WHEN regexp_full_match(cost_centre, 'C[0-9]{3}') THEN 'CC-' || substr(cost_centre, 2) ELSE cost_centre END"""
KEYS = ("hr", "finance", "procurement", "expenses")
# old codes of open drift issues
DRIFT = ("drift AS (SELECT i.issue_id, i.finding_id, i.row_identifier, o.cost_centre AS old, o.code AS new FROM issue_open i JOIN ("
         + " UNION ALL ".join(f"SELECT '{DOMAINS[k].table}' AS table_name, {DOMAINS[k].row_id} AS row_identifier, "
                              f"cost_centre, {CODE} AS code FROM {SHORT[k]}" for k in KEYS)
         + ") o ON o.table_name = i.table_name AND o.row_identifier = i.row_identifier "
           "WHERE i.issue_type = 'consistency' AND i.column_name = 'cost_centre' "
           "AND NOT regexp_full_match(o.cost_centre, 'CC-[0-9]{3}') AND regexp_full_match(o.code, 'CC-[0-9]{3}'))")
DRIFT_NOTE = "'cost_centre normalised via canonical mapping in Stage 5: ''' || old || ''' -> ''' || new || '''.'"
CONTRADICTIONS = ("SELECT issue_id, 'Resolved' AS status, '" + W.STATUS_DROPPED_NOTE.replace("'", "''")
                  + "' AS note FROM issue_open WHERE detection_rule = 'status_date_contradiction'")
VENDOR_NOTES = ("""members AS (SELECT cluster, min(vendor_id) || ' to ' || max(vendor_id) || ' (' || count(DISTINCT vendor_id)
    || ' vendors)' AS ids FROM vcl GROUP BY cluster HAVING count(DISTINCT vendor_id) > 1)""",
                """vendor_notes AS (SELECT i.issue_id, 'Resolved' AS status, 'Vendor name duplication resolved via target_vendor_master: ' ||
    m.ids || ' consolidated to canonical name ''' || vm.canonical_vendor_name || ''' (Stage 5).' AS note
  FROM issue_open i JOIN (SELECT vendor_id, min(po_id) AS po_id FROM proc GROUP BY vendor_id) p ON p.po_id = i.row_identifier
    JOIN (SELECT DISTINCT vendor_id, cluster FROM vcl) v ON v.vendor_id = p.vendor_id JOIN members m ON m.cluster = v.cluster
    JOIN vmaster vm ON vm.vendor_id = p.vendor_id WHERE i.column_name = 'vendor_name' AND i.issue_type = 'duplication')""")
OPEN_PERSONS = ("SELECT row_identifier, finding_id, issue_id FROM issue_open WHERE domain = 'HR' "
                "AND issue_type = 'duplication' AND status = 'Open'")
PERSON_NOTES = (f"open_p AS ({OPEN_PERSONS})",
                *reviewed("ratio", persons=False, no_issue="b.id NOT IN (SELECT row_identifier FROM open_p)"),
                """person_notes AS (SELECT o.issue_id, CASE WHEN settle_gap IS NULL THEN 'Open' ELSE 'Resolved' END AS status,
    CASE WHEN settle_gap IS NULL THEN 'Flagged as a possible near-duplicate of ' || named_partner_id || ' (similarity ' ||
      CAST(CAST(round_even(named_score * 100, 0) AS INTEGER) AS VARCHAR) || '%) - see hr_duplicate_review table. dept_code/' ||
      'cost_centre/hire_date do not all align, so this needs HR business review; not auto-resolved.'
    ELSE 'Flagged as probable data-entry duplicate: same dept/cost_centre, hire dates ' || settle_gap ||
      ' days apart. Consolidation requires HR sign-off, not auto-merged.' END AS note
  FROM open_p o JOIN review r ON r.employee_id = o.row_identifier)""")
# the log after everything the mapping settles
RESOLVED = (DRIFT, *VENDOR_TABLES, *VENDOR_NOTES, *PERSON_NOTES,
            f"settled AS (SELECT issue_id, 'Resolved' AS status, {DRIFT_NOTE} AS note FROM drift UNION ALL {CONTRADICTIONS} "
            "UNION ALL SELECT * FROM vendor_notes UNION ALL SELECT * FROM person_notes)",
            "issue_rows AS (SELECT i.* REPLACE (coalesce(s.status, i.status) AS status, coalesce(s.note, i.resolution) AS resolution) "
            "FROM issue_open i LEFT JOIN settled s ON s.issue_id = i.issue_id)")
def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def text_case(rules, by_type, default: str) -> str:
    whens = [f"WHEN detection_rule = '{r}' AND column_name = '{c}' THEN {quoted(t)}" for r, c, t in rules if c]
    whens += [f"WHEN detection_rule = '{r}' THEN {quoted(t)}" for r, c, t in rules if not c]
    whens += [f"WHEN issue_type = '{i}' THEN {quoted(t)}" for i, t in by_type]
    return f"CASE {' '.join(whens)} ELSE {quoted(default)} END"


CAUSE = text_case(W.ROOT_CAUSES, W.ROOT_CAUSE_BY_TYPE, W.ROOT_CAUSE_DEFAULT)
IMPACT_TEXT = text_case(W.BUSINESS_IMPACTS, W.IMPACT_BY_TYPE, W.IMPACT_DEFAULT)
HELD = (
    "held AS (SELECT domain, table_name, row_identifier, issue_id, finding_id, issue_type || ': ' || finding AS reason "
    "FROM issue_rows WHERE status = 'Open' AND issue_type IN ('obsolete_orphaned', 'accuracy'))"
)
FLAGS = (
    "flags AS (SELECT table_name, row_identifier, min(finding_id) AS finding_id, arg_min(issue_id, finding_id) AS issue_id "
    "FROM issue_rows WHERE status = 'Open' AND issue_type IN ('completeness', 'duplication') "
    "GROUP BY table_name, row_identifier)"
)


def sql_target(key: str, held: bool = True) -> str:
    """target_<key>: mapped columns with status; ``held`` takes the held rows out."""
    spec, d = default_spec()[key], DOMAINS[key]
    columns = ", ".join(
        (f"{CODE} AS cost_centre" if c.source == "cost_centre" else f"CAST({c.source} AS {c.sql_type}) AS {c.target}")
        for c in spec.columns)
    if not held:
        return f"mapped_{SHORT[key]} AS (SELECT {columns} FROM {SHORT[key]})"
    return (f"target_{SHORT[key]} AS (SELECT m.*, CASE WHEN f.issue_id IS NOT NULL THEN 'migrated_with_flag' ELSE 'clean' "
            f"END AS migration_status, f.issue_id FROM (SELECT {columns} FROM {SHORT[key]}) m LEFT JOIN flags f "
            f"ON f.table_name = '{d.table}' AND f.row_identifier = m.{d.row_id} WHERE NOT EXISTS (SELECT 1 FROM held h "
            f"WHERE h.table_name = '{d.table}' AND h.row_identifier = m.{d.row_id}))")


ALL = "hr fin proc exp"
CHAIN = (FINDINGS, ISSUES, *RESOLVED, HELD, FLAGS)
TARGETS = tuple(sql_target(k) for k in KEYS)


# --- the same chain in Spark -------------------------------------------------------


def sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    v = views(spark, sf_dir)
    return {k: v[k] for k in KEYS}


def staged_sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The source tables written once, as a load does, for jobs that read them many times."""
    return {k: stage(df, k) for k, df in sources(spark, sf_dir).items()}


_jobs: dict[tuple[str, str], Migration] = {}


def job(spark: SparkSession, sf_dir: str) -> Migration:
    """The whole job over the domain views; queries of a session share its written products."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _jobs:
        _jobs[key] = Migration(staged_sources(spark, sf_dir), AS_OF, earliest=EARLIEST)
    return _jobs[key]


# the number in a row id, in SQL and in Spark
NUMBER = {"hr": "CAST(substr(employee_id, 5) AS BIGINT)", "finance": "CAST(substr(gl_entry_id, 4) AS BIGINT)",
          "procurement": "CAST(split_part(substr(po_id, 4), '-', 1) AS BIGINT)",
          "expenses": "CAST(substr(expense_id, 5) AS BIGINT)"}


def number_of(key: str) -> Column:
    return F.expr(NUMBER[key])


def money(expression: str) -> str:
    return f"CAST(CAST(COALESCE(SUM(CAST({expression} AS DECIMAL(28,8))), 0) AS DECIMAL(28,2)) AS DOUBLE)"

"""Compare registered queries with their SQL: ``python tests/oracle.py [sf dir] [name ...]``."""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _value(v):
    if isinstance(v, float):
        return None if math.isnan(v) else v
    return v


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_value(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(out, key=lambda r: tuple((x is not None, str(type(x)), x) for x in r))


def spark_rows(df):
    return canonical(df.columns, [tuple(r) for r in df.collect()])


def sql_rows(con, sql):
    cur = con.execute(sql)
    return canonical([d[0] for d in cur.description], cur.fetchall())


def difference(got, want) -> str | None:
    if got[0] != want[0]:
        return f"columns {got[0]} against {want[0]}"
    if got[1] != want[1]:
        extra = [r for r in got[1] if r not in set(want[1])][:2]
        lacking = [r for r in want[1] if r not in set(got[1])][:2]
        return f"rows {len(got[1])} against {len(want[1])}; extra {extra}; lacking {lacking}"
    return None


def main() -> int:
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    args = sys.argv[1:]
    sf_dir = args[0] if args and "/" in args[0] else "/root/testdata/sf0.01"
    names = [a for a in args if "/" not in a] or list(entry.queries())
    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
             .config("spark.driver.memory", "12g").config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name in names:
        started = time.time()
        try:
            got = spark_rows(entry.queries()[name](spark, sf_dir))
            took = time.time() - started
            sql = entry.oracle_sql().get(name)
            note = "rows only" if sql is None else (difference(got, sql_rows(con, sql)) or "ok")
        except Exception as e:  # noqa: BLE001
            took, got, note = time.time() - started, ([], []), f"ERROR {type(e).__name__}: {str(e)[:600]}"
        bad += note not in ("ok", "rows only")
        print(f"{name:34s} {took:6.2f}s {len(got[1]):7d} {note}", flush=True)
    print(f"{bad} of {len(names)} differ")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)

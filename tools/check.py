"""Run queries in Spark and their statements in DuckDB on the same tables and compare all rows.

usage: python tools/check.py SF_DIR [query or inventory id, or -id to leave out ...]
"""

import datetime
import decimal
import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from docfleet.plans.runtime import build_session  # noqa: E402
from docfleet.plans.views import TABLES  # noqa: E402
from docfleet.queries import load_all  # noqa: E402


def plain(x):
    if isinstance(x, decimal.Decimal):
        x = float(x)
    if isinstance(x, float):
        return "nan" if math.isnan(x) else float(f"{x:.12g}")
    if isinstance(x, (datetime.datetime, datetime.date)):
        return x.isoformat()
    return x


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def duck(sf_dir):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    return con


def compare(q, spark, con, sf_dir):
    start = time.time()
    df = q.run(spark, sf_dir)
    got = rows_of(df.columns, df.collect())
    took = time.time() - start
    if q.sql is None:
        return "ROWS" if got else "EMPTY", f"{len(got)} rows {took:.1f}s"
    start = time.time()
    cur = con.execute(q.sql)
    names = [d[0] for d in cur.description]
    kinds = {d[0]: str(d[1]) for d in cur.description}
    want = rows_of(names, cur.fetchall())
    note = f"{len(got)} rows {took:.1f}s (duck {time.time() - start:.1f}s)"
    if sorted(names) != sorted(df.columns):
        return "COLUMNS", f"{sorted(df.columns)} against {sorted(names)}"
    if got != want:
        extra = [r for r in got if r not in set(want)][:2]
        missing = [r for r in want if r not in set(got)][:2]
        return "DIFF", f"{note}, want {len(want)}\n   spark only {str(extra)[:600]}\n   duck only  {str(missing)[:600]}"
    same = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}
    types = ", ".join(f"TYPE {n}:{t}/{kinds[n]}" for n, t in df.dtypes if same.get(t) != kinds[n])
    return ("OK" if got else "EMPTY"), f"{note} {types}"


def main():
    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark = build_session(cpus="8", **{"spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    bad = 0
    for name, q in load_all().items():
        if "-" + q.item in names:
            continue
        if [n for n in names if n[0] != "-"] and not any(n == name or n == q.item for n in names):
            continue
        try:
            state, note = compare(q, spark, con, sf_dir)
        except Exception as e:  # show which query failed and go on
            state, note = "ERROR", str(e)[:1500]
        bad += state in ("ERROR", "DIFF", "COLUMNS")
        print(f"{state:8}{q.item:10}{name:32}{note}", flush=True)
    print("failures:", bad)


if __name__ == "__main__":
    main()

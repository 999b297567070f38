"""Run registered queries next to their reference SQL and compare every value.

    python tests/oracle_check.py [sf_dir] [name-prefix ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from plantlens.workbook.fixtures import BASE_TABLES  # noqa: E402


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in BASE_TABLES:
        con.sql(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def canonical(v):
    if v is None or isinstance(v, (bool, str)):
        return v
    if isinstance(v, float):
        return None if math.isnan(v) else v + 0.0
    if isinstance(v, (int, decimal.Decimal)):
        return float(v)
    if isinstance(v, dt.datetime):
        return v.isoformat()
    return str(v)


def rows_of(columns, rows) -> tuple[list[str], Counter]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(canonical(r[i]) for i in order) for r in rows)


def compare(spark_df, con, sql) -> str:
    """Empty text when equal, else what differs."""
    got_cols, got = rows_of(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    rel = con.sql(sql)
    want_cols, want = rows_of(rel.columns, rel.fetchall())
    if got_cols != want_cols:
        return f"columns {set(got_cols) ^ set(want_cols)}"
    if got != want:
        extra, missing = list((got - want).items())[:2], list((want - got).items())[:2]
        return (f"rows {sum(got.values())} vs {sum(want.values())}, {sum((got - want).values())} differ\n"
                f"   cols {got_cols}\n   spark {extra}\n   sql   {missing}")
    return "" if got else "both empty"


def main(argv: list[str]) -> int:
    from plantlens.session import build_session
    import __spark_entry__ as entry

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    prefixes = tuple(argv[1:]) or ("",)
    spark = build_session(master="local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, failed, total = connect(sf_dir), entry.oracle_sql(), [], 0
    for name, fn in entry.queries().items():
        if not name.startswith(prefixes):
            continue
        total += 1
        start = time.time()
        try:
            df = fn(spark, sf_dir)
            problem = compare(df, con, sql[name]) if name in sql else ("" if df.count() else "empty")
        except Exception as e:  # report and go on with the next query
            problem = f"{type(e).__name__}: {str(e)[:1500]}"
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - start:.1f}s {'' if name in sql else '(rows only)'}"
              + (f"\n   {problem}" if problem else ""), flush=True)
        if problem:
            failed.append(name)
    print(f"{total - len(failed)}/{total} equal; failed: {failed}")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))

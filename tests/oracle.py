"""Run registered queries next to their SQL and compare every value.

    python tests/oracle.py [folder] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import threading
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SQL_SECONDS = 60
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def _cell(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    return v


def _kind(t: str) -> str:
    t = t.lower()
    if t in ("bigint", "int", "integer", "smallint", "tinyint", "hugeint", "int32", "int64"):
        return "int"
    return {"varchar": "string", "float": "double"}.get(t, "decimal" if t.startswith("decimal") else t)


def compare(spark, con, folder: str, name: str, run, sql: str) -> str | None:
    """None if equal, otherwise what differs."""
    df = run(spark, folder)
    names = sorted(df.columns)
    mine = [tuple(_cell(r[n]) for n in names) for r in df.collect()]
    guard = threading.Timer(SQL_SECONDS, con.interrupt)
    guard.start()
    try:
        result = con.execute(sql)
    finally:
        guard.cancel()
    theirs_names = [d[0] for d in result.description]
    if sorted(theirs_names) != names:
        return f"columns {names} != {sorted(theirs_names)}"
    kinds = {n: _kind(str(k)) for n, k in zip(theirs_names, [d[1] for d in result.description])}
    wrong = {f.name: (f.dataType.simpleString(), kinds[f.name]) for f in df.schema if _kind(f.dataType.simpleString()) != kinds[f.name] and kinds[f.name] != "null"}
    place = [theirs_names.index(n) for n in names]
    theirs = [tuple(_cell(r[i]) for i in place) for r in result.fetchall()]
    mine.sort(key=repr)
    theirs.sort(key=repr)
    if len(mine) != len(theirs):
        return f"{len(mine)} rows != {len(theirs)}"
    bad = [(a, b) for a, b in zip(mine, theirs) if a != b]
    if bad:
        return f"{len(bad)} of {len(mine)} rows differ, first {names}: {bad[0][0]} != {bad[0][1]}"
    return f"types {wrong}" if wrong else None


def main(folder: str, wanted: list[str]) -> int:
    from __spark_entry__ import oracle_sql, queries
    from tabloom.session import build_session

    spark = build_session(master="local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
                          spark__driver__memory="8g", spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, failed = connect(folder), oracle_sql(), 0
    for name, run in queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            if name in sql:
                problem = compare(spark, con, folder, name, run, sql[name])
            else:
                problem = None if run(spark, folder).count() else "no rows"
        except Exception as e:  # report and go on with the next query
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name:28} {time.time() - start:6.2f}s {'' if name in sql else '(rows only)'} {problem or ''}", flush=True)
    print(f"{failed} failed")
    spark.stop()
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01", sys.argv[2:]) else 0)

"""Run registered queries and their SQL side by side and compare the rows."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parents[1]
if str(ROOT) not in sys.path:
    sys.path.insert(0, str(ROOT))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def database(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if value is None or isinstance(value, (bool, str)):
        return repr(value)
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(plain(r[i]) for i in order) for r in rows)


def compare(spark, con, folder, name, run, sql):
    """(problem or None, number of rows, seconds)."""
    begun = time.time()
    df = run(spark, folder)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    spent = time.time() - begun
    if sql is None:
        return None, len(got[1]), spent
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    want = rows_of(names, result.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}", len(got[1]), spent
    if got[1] != want[1]:
        extra = [r for r in got[1] if r not in set(want[1])][:2]
        lost = [r for r in want[1] if r not in set(got[1])][:2]
        return f"{len(got[1])} rows, want {len(want[1])}; extra {extra}; lost {lost}"[:1500], len(got[1]), spent
    return None, len(got[1]), spent


def main():
    import __spark_entry__ as contract

    from placeseek.session import local_session

    folder = f"/root/testdata/{sys.argv[1]}"
    wanted = sys.argv[2:]
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con = database(folder)
    sqls = contract.oracle_sql()
    bad = 0
    for name, run in contract.queries().items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        try:
            problem, n, spent = compare(spark, con, folder, name, run, sqls.get(name))
        except Exception as error:  # report and go on to the next query
            problem, n, spent = f"{type(error).__name__}: {str(error)[:700]}", -1, 0.0
        bad += problem is not None
        kind = "sql" if name in sqls else "rows"
        print(f"{'BAD' if problem else 'ok '} {name} {kind} rows={n} {spent:.1f}s {problem or ''}", flush=True)
    print("failed:", bad)


if __name__ == "__main__":
    main()

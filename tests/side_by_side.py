"""Run a registered query and its SQL twin, and compare the rows.

As a script: ``python tests/side_by_side.py <sf_dir> [name ...]`` prints one line per query.
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        if Path(f"{sf_dir}/{t}.parquet").exists():
            con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def _plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else (0.0 if v == 0 else v)
    return v


def _sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_plain(r[i]) for i in order) for r in rows]
    return sorted(columns), sorted(out, key=lambda r: tuple((x is not None, str(type(x)), str(x)) for x in r))


def compare(spark, con, name, fn, sql, sf_dir):
    """(problem or None, spark rows, spark seconds)."""
    began = time.perf_counter()
    df = fn(spark, sf_dir)
    got = df.collect()
    took = time.perf_counter() - began
    columns, rows = _sorted_rows(df.columns, [tuple(r) for r in got])
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    want_columns, want = _sorted_rows(names, cursor.fetchall())
    if columns != want_columns:
        return f"columns {set(columns) ^ set(want_columns)}", len(rows), took
    if len(rows) != len(want):
        return f"{len(rows)} rows for {len(want)}", len(rows), took
    bad = [(a, b) for a, b in zip(rows, want, strict=True) if a != b]
    if bad:
        a, b = bad[0]
        diff = {c: (x, y) for c, x, y in zip(columns, a, b, strict=True) if x != y}
        return f"{len(bad)} rows differ, first: {diff}", len(rows), took
    return None, len(rows), took


def main() -> int:
    import __spark_entry__ as entry
    from curbline.session import build_session

    sf_dir, *names = sys.argv[1:]
    spark = build_session("side-by-side", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "12g",
        "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    failed = 0
    sqls = entry.oracle_sql()
    for name, fn in entry.queries().items():
        if names and name not in names:
            continue
        try:
            problem, rows, took = compare(spark, con, name, fn, sqls[name], sf_dir)
        except Exception as e:  # noqa: BLE001
            problem, rows, took = f"{type(e).__name__}: {str(e)[:700]}", 0, 0.0
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name:28s} rows={rows:<7d} {took:6.2f}s {problem or ''}",
              flush=True)
    print(f"{failed} failed")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())

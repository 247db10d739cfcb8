"""Compare registered queries with their SQL on one scale factor.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return con


def _cell(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return ""
    if isinstance(value, float):
        return repr(value + 0.0)
    return f"{type(value).__name__}:{value}"


def compare(con, spark, sf: str, fn, sql: str) -> tuple[bool, str]:
    df = fn(spark, sf)
    names = sorted(df.columns)
    got = [tuple(_cell(r[c]) for c in names) for r in df.collect()]
    rel = con.sql(sql)
    at = [rel.columns.index(c) for c in names] if sorted(rel.columns) == names else None
    if at is None:
        return False, f"columns {names} vs {sorted(rel.columns)}"
    want = [tuple(_cell(row[i]) for i in at) for row in rel.fetchall()]
    if sorted(got) == sorted(want):
        return True, f"{len(got)} rows"
    only_got, only_want = set(got) - set(want), set(want) - set(got)
    return False, (
        f"{len(got)} vs {len(want)} rows; only Spark {len(only_got)} {sorted(only_got)[:2]}; "
        f"only SQL {len(only_want)} {sorted(only_want)[:2]}"
    )


def main() -> int:
    import __spark_entry__ as registry
    from clickloom.session import get_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = get_session(
        "oracle-check",
        "local[8]",
        {"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
         "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, bad = connect(sf), registry.oracle_sql(), 0
    for name, fn in registry.queries().items():
        if wanted and name not in wanted:
            continue
        begin = time.time()
        try:
            if name in sqls:
                ok, note = compare(con, spark, sf, fn, sqls[name])
            else:
                rows = fn(spark, sf).collect()
                ok, note = bool(rows), f"{len(rows)} rows, no SQL; first {rows[:1]}"
        except Exception as error:  # noqa: BLE001
            ok, note = False, f"{type(error).__name__}: {str(error)[:600]}"
        bad += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name} {time.time() - begin:.1f}s {note}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main())

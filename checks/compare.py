"""Run registered queries next to their SQL: ``python -m checks.compare SF_DIR [name ...]``."""

from __future__ import annotations

import math
import sys
import time
import traceback

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf}/{t}.parquet')")
    return con


def _cell(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 9))
    return "<null>" if v is None else str(v)


def rows_of(names: list[str], rows) -> list[tuple[str, ...]]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(spark, con, sf: str, name: str, fn, sql: str | None) -> str:
    """Empty when both sides agree, else what differs."""
    df = fn(spark, sf)
    mine = rows_of(df.columns, df.collect())
    if sql is None:
        return ""
    res = con.execute(sql)
    names = [d[0] for d in res.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} / {sorted(names)}"
    theirs = rows_of(names, res.fetchall())
    if mine == theirs:
        return ""
    a, b = [r for r in mine if r not in set(theirs)][:2], [r for r in theirs if r not in set(mine)][:2]
    return f"{len(mine)} / {len(theirs)} rows; only Spark {a}; only SQL {b}"


def main() -> int:
    from checks.oracle import ORACLE
    from checks.queries import QUERIES
    from sitegrain.session import local_session

    sf, wanted = sys.argv[1], sys.argv[2:]
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(sf), 0
    for name, fn in QUERIES.items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            problem = compare(spark, con, sf, name, fn, ORACLE.get(name))
        except Exception as e:
            problem = f"{type(e).__name__}: {str(e)[:600]}"
            if wanted:
                traceback.print_exc()
        bad += bool(problem)
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - start:.1f}s {problem}", flush=True)
    print(f"{bad} failing")
    return bad


if __name__ == "__main__":
    raise SystemExit(main())

"""Runs registered queries beside their SQL and compares all rows.

``python tests/compare.py [sf_dir] [name ...]``
"""

from __future__ import annotations

import datetime
import sys
import time
from pathlib import Path

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES.split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _value(v):
    if isinstance(v, float):
        return ("nan",) if v != v else round(v, 9) + 0.0
    if isinstance(v, datetime.datetime):
        return v.isoformat(sep=" ", timespec="microseconds")
    if isinstance(v, (list, tuple)):
        return tuple(_value(x) for x in v)
    return v


def _sorted(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_value(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(out, key=repr)


def difference(df, con, sql: str) -> str | None:
    got = _sorted(df.columns, df.collect())
    cur = con.execute(sql)
    want = _sorted([d[0] for d in cur.description], cur.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    if got[1] == want[1]:
        return None
    only_got = [r for r in got[1] if r not in want[1]][:3]
    only_want = [r for r in want[1] if r not in got[1]][:3]
    return f"{len(got[1])} rows, expected {len(want[1])}\n  {got[0]}\n  got  {only_got}\n  want {only_want}"


def main() -> int:
    sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
    import __spark_entry__ as contract
    from tidegrid import build_session

    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and "/" in args[0] else "/root/testdata/sf0.01"
    spark = build_session(
        master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries, sqls = contract.queries(), contract.oracle_sql()
    con = connect(sf_dir)
    bad = 0
    for name in args or queries:
        start = time.time()
        try:
            df = queries[name](spark, sf_dir)
            if name in sqls:
                problem = difference(df, con, sqls[name])
                n = con.execute(f"SELECT count(*) FROM ({sqls[name]})").fetchone()[0]
            else:
                problem, n = None, df.count()
        except Exception as e:  # report and go on with the next query
            problem, n = f"{type(e).__name__}: {str(e)[:1500]}", "?"
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {name} rows={n} {time.time() - start:.1f}s {'' if name in sqls else '(no sql)'} {problem or ''}", flush=True)
    print(f"{bad} bad")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())

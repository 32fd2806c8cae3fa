"""Run registered queries against their SQL in DuckDB (a development tool).

    python -m graphweft.plans.check [--sf DIR] [name prefix …]
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path


def _cell(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    if isinstance(v, (list, tuple)):
        return str([_cell(x) for x in v])
    return str(v)


# Spark type → DuckDB type of the same column.
SAME_TYPE = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN", "float": "FLOAT", "timestamp_ntz": "TIMESTAMP"}


def type_differences(df, con, sql: str) -> list[str]:
    """Columns whose types differ between the two sides."""
    want = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    return [f"{n}: {t} and {want.get(n)}" for n, t in df.dtypes if SAME_TYPE.get(t, t) != want.get(n)]


def rows_of_spark(df):
    names = sorted(df.columns)
    return names, Counter(tuple(_cell(r[n]) for n in names) for r in df.select(*names).collect())


def connect(sf: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for f in Path(sf).glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM read_parquet('{f}')")
    return con


def rows_of_duck(con, sql: str):
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in order], Counter(tuple(_cell(r[i]) for i in order) for r in cur.fetchall())


def compare(spark, con, name: str, sf: str) -> str:
    from . import ORACLE, QUERIES

    started = time.time()
    df = QUERIES[name](spark, sf)
    names, got = rows_of_spark(df)
    took = time.time() - started
    n = sum(got.values())
    if name not in ORACLE:
        return f"rows  {name} {n} rows {took:.1f}s"
    started = time.time()
    want_names, want = rows_of_duck(con, ORACLE[name])
    duck = time.time() - started
    if names != want_names:
        return f"FAIL  {name} columns {names} != {want_names}"
    if got != want:
        extra, missing = list((got - want).items())[:3], list((want - got).items())[:3]
        return f"FAIL  {name} {n} vs {sum(want.values())} rows\n   spark only {extra}\n   duck only  {missing}"
    types = type_differences(df, con, ORACLE[name])
    if types:
        return f"FAIL  {name} types {types}"
    return f"{'ok   ' if n else 'EMPTY'} {name} {n} rows spark {took:.1f}s duck {duck:.1f}s"


def main(argv: list[str]) -> int:
    from ..session import build_session
    from . import QUERIES

    sf = "/root/testdata/sf0.01"
    if argv[:1] == ["--sf"]:
        sf, argv = argv[1], argv[2:]
    spark = build_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    bad = 0
    for name in QUERIES:
        if argv and not any(name.startswith(p) for p in argv):
            continue
        try:
            line = compare(spark, con, name, sf)
        except Exception as e:  # report and go on to the next query
            line = f"FAIL  {name} {type(e).__name__}: {str(e)[:700]}"
        bad += not line.startswith(("ok", "rows"))
        print(line, flush=True)
    print("failures:", bad)
    return bad


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))

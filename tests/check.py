"""Run registered queries and compare them with their SQL on the same tables.

    python tests/check.py [sf folder] [name or prefix ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from flowvec.sources.tables import TABLES  # noqa: E402


def cell(value):
    """A value in a form both engines share."""
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "null"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, float):
        return repr(value + 0.0)
    return str(value)


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(cell(r[i]) for i in order) for r in rows)


def connect(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    return con


def compare(spark, con, folder: str, build, sql: str | None):
    """``(ok, message)`` of one query."""
    df = build(spark, folder)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin"):
        if bad in plan:
            return False, f"the plan has a {bad}"
    mine = table(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return True, f"rows only: {len(mine[1])}"
    cursor = con.execute(sql)
    theirs = table([d[0] for d in cursor.description], cursor.fetchall())
    if mine == theirs:
        return True, f"{len(mine[1])} rows"
    if mine[0] != theirs[0]:
        return False, f"columns {mine[0]} != {theirs[0]}"
    only_mine = sorted(set(mine[1]) - set(theirs[1]))[:2]
    only_theirs = sorted(set(theirs[1]) - set(mine[1]))[:2]
    return False, f"rows {len(mine[1])} != {len(theirs[1])}\n  spark {only_mine}\n  sql   {only_theirs}"


def main(argv: list[str]) -> int:
    from conftest import session

    from flowvec import plans

    folder = "/root/testdata/sf0.01"
    if argv and "/" in argv[0]:
        folder, argv = argv[0], argv[1:]
    spark, con = session(), connect(folder)
    failed = []
    for name, build in plans.queries().items():
        if argv and not any(name.startswith(a) for a in argv):
            continue
        start = time.time()
        try:
            ok, message = compare(spark, con, folder, build, plans.oracle_sql().get(name))
        except Exception as error:
            ok, message = False, f"{type(error).__name__}: {str(error)[:600]}"
        if not ok:
            failed.append(name)
        print(f"{'ok  ' if ok else 'FAIL'} {name:28s} {time.time() - start:6.2f}s {message[:900]}", flush=True)
    print("failed:", failed)
    return bool(failed)


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))

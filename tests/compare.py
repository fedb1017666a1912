"""Run registered queries in both engines and compare. ``python tests/compare.py [sf_dir] [names..]``"""

from __future__ import annotations

import math
import sys
import tempfile
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def cell(value):
    if value is None:
        return None
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.9g}")
    if hasattr(value, "is_integer") or isinstance(value, bool):
        return value if isinstance(value, bool) else int(value)
    if type(value).__name__ == "Decimal":
        return int(value) if value == int(value) else float(value)
    return str(value)


def table(names: list[str], rows) -> tuple[list[str], list[str]]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    shown = [repr(tuple(cell(row[i]) for i in order)) for row in rows]
    return [names[i] for i in order], sorted(shown)


#: What no plan should hold: all pairs of two tables, or rows handed to Python one by one.
UNWANTED = ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas")


def compare(spark, con, sf_dir: str, name: str, fn, sql: str | None) -> tuple[bool, str]:
    start = time.time()
    df = fn(spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    if any(word in plan for word in UNWANTED):
        return False, f"plan holds one of {UNWANTED}"
    got = table(df.columns, [tuple(r) for r in df.collect()])
    took = time.time() - start
    if sql is None:
        return True, f"{len(got[1])} rows, no SQL, {took:.1f}s"
    result = con.execute(sql)
    want = table([d[0] for d in result.description], result.fetchall())
    if got[0] != want[0]:
        return False, f"columns {got[0]} != {want[0]}"
    if got[1] != want[1]:
        a, b = set(got[1]) - set(want[1]), set(want[1]) - set(got[1])
        show = lambda s: [x[:300] for x in sorted(s)[:2]]
        return False, f"rows {len(got[1])} / {len(want[1])}; only Spark {len(a)} {show(a)}; only SQL {len(b)} {show(b)}"
    return True, f"{len(got[1])} rows, {took:.1f}s"


def main() -> int:
    import __spark_entry__ as entry
    from kessan.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    chosen = sys.argv[2:]
    spark = build_session(
        master="local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="12g",
        spark__ui__showConsoleProgress="false", spark__checkpoint__dir=tempfile.mkdtemp(prefix="kessan-compare-"),
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, bad = duck(sf_dir), entry.oracle_sql(), 0
    for name, fn in entry.queries().items():
        if chosen and name not in chosen and getattr(fn, "__module_name__", "") not in chosen:
            continue
        try:
            ok, note = compare(spark, con, sf_dir, name, fn, sql.get(name))
        except Exception as error:  # noqa: BLE001
            ok, note = False, f"{type(error).__name__}: {str(error)[:700]}"
        bad += not ok
        print("ok  " if ok else "FAIL", name, note, flush=True)
    print("failed:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(bool(main()))

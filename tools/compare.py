"""Run registered queries against their SQL in DuckDB.

usage: python tools/compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import os
import sys
import time
import traceback

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from read_parquet('{sf_dir}/{table}.parquet')")
    return con


def cell(value):
    if value is None or value != value:
        return "~"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, float):
        return f"{value:.9g}" if value else "0"
    if isinstance(value, (list, tuple)):
        return str([cell(v) for v in value])
    return str(value)


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(cell(r[i]) for i in order) for r in rows)


def kind_of(name: str) -> str:
    name = name.lower()
    if any(t in name for t in ("int", "long", "short", "byte")):
        return "int"
    if any(t in name for t in ("double", "float", "decimal")):
        return "float:" + name if "decimal" in name else "float"
    return {"string": "text", "varchar": "text"}.get(name, name)


def compare(spark, con, name, query, sql, sf_dir) -> tuple[bool, str]:
    began = time.perf_counter()
    frame = query(spark, sf_dir)
    rows = [tuple(r) for r in frame.collect()]
    took = time.perf_counter() - began
    if sql is None:
        return True, f"{took:6.2f}s rows={len(rows)} (rows only)"
    answer = con.execute(sql)
    columns = [d[0] for d in answer.description]
    kinds = {d[0]: kind_of(str(d[1])) for d in answer.description}
    ours = {f.name: kind_of(f.dataType.simpleString()) for f in frame.schema.fields}
    left, right = normal(frame.columns, rows), normal(columns, answer.fetchall())
    if left[0] != right[0]:
        return False, f"columns {left[0]} != {right[0]}"
    differ = {c: (ours[c], kinds[c]) for c in columns if ours[c] != kinds[c] and "timestamp" not in ours[c]}
    note = f" TYPES {differ}" if differ else ""
    if left[1] != right[1]:
        a, b = set(left[1]), set(right[1])
        only_a, only_b = sorted(a - b)[:3], sorted(b - a)[:3]
        return False, f"rows {len(left[1])} vs {len(right[1])}, differing {len(a - b)}/{len(b - a)}\n   cols  {left[0]}\n   spark {only_a}\n   sql   {only_b}{note}"
    return not differ, f"{took:6.2f}s rows={len(rows)}{note}"


def main() -> int:
    from serieskit.catalog import ORACLES, QUERIES
    from serieskit.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = build_session("compare")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name in names:
        try:
            fine, text = compare(spark, con, name, QUERIES[name], ORACLES.get(name), sf_dir)
        except Exception:
            fine, text = False, traceback.format_exc(limit=3)[-1800:]
        bad += not fine
        print(("ok   " if fine else "FAIL ") + name, text, flush=True)
    print(f"{len(names) - bad} of {len(names)} fine")
    return bad


if __name__ == "__main__":
    sys.exit(main())

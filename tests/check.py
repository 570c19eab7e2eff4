"""Run catalogue queries in Spark and DuckDB and compare rows.

python tests/check.py [-d folder] [name-prefix ...]
"""

from __future__ import annotations

import math
import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def kind(value) -> str:
    if isinstance(value, bool):
        return "bool"
    if isinstance(value, int):
        return "int"
    if isinstance(value, float):
        return "float"
    return type(value).__name__


def normal(value):
    if isinstance(value, float):
        if math.isnan(value):
            return None
        return 0.0 if value == 0 else value
    return value


def compare(spark_df, con, sql: str) -> str:
    """Empty when equal, else what differs."""
    names = sorted(spark_df.columns)
    spark_start = time.time()
    spark_rows = spark_df.collect()
    compare.spark_s = time.time() - spark_start
    cur = con.execute(sql)
    sql_names = [d[0] for d in cur.description]
    if sorted(sql_names) != names:
        return f"columns {names} vs {sorted(sql_names)}"
    theirs = [tuple(normal(r[sql_names.index(n)]) for n in names) for r in cur.fetchall()]
    ours = [tuple(normal(r[n]) for n in names) for r in spark_rows]
    if len(ours) != len(theirs):
        return f"rows {len(ours)} vs {len(theirs)}"
    for i, n in enumerate(names):
        a = {kind(r[i]) for r in ours if r[i] is not None}
        b = {kind(r[i]) for r in theirs if r[i] is not None}
        if a != b:
            return f"type of {n}: {a} vs {b}"
    order = lambda r: tuple((v is None, str(v)) for v in r)
    ours.sort(key=order)
    theirs.sort(key=order)
    bad = [(a, b) for a, b in zip(ours, theirs) if a != b]
    if bad:
        return f"{len(bad)} of {len(ours)} rows differ ({names}): {bad[:3]}"
    return ""


def main() -> None:
    from sparkaudit import plans
    from sparkaudit.session import local_session

    args = sys.argv[1:]
    folder = "/root/testdata/sf0.01"
    if args and args[0] == "-d":
        folder, args = args[1], args[2:]
    spark = local_session()
    con = connect(folder)
    sqls = plans.oracle_sql()
    failed = 0
    for name, fn in plans.queries().items():
        if args and not any(name.startswith(a) for a in args):
            continue
        start = time.time()
        try:
            df = fn(spark, folder)
            if name in sqls:
                diff = compare(df, con, sqls[name])
                note = "ok" if not diff else f"DIFF {diff}"
            else:
                note = f"rows {df.count()} (no sql)"
        except Exception as e:
            note = "ERROR " + str(e)[:1500]
            if os.environ.get("TRACE"):
                traceback.print_exc()
        failed += note.startswith(("DIFF", "ERROR"))
        built = time.time() - start
        print(f"{built:6.2f}s {name}: {note} [{getattr(compare, 'spark_s', 0):.2f}s spark]", flush=True)
    print("failed:", failed)


if __name__ == "__main__":
    main()

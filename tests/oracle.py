"""Run registered queries next to their SQL: python -m tests.oracle [sf_dir] [name part ...]"""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def kind(value) -> str:
    if isinstance(value, bool):
        return "bool"
    if isinstance(value, int):
        return "int"
    if isinstance(value, (float, decimal.Decimal)):
        return "float"
    if isinstance(value, datetime.datetime):
        return "ts"
    if isinstance(value, datetime.date):
        return "date"
    return type(value).__name__


def norm(value):
    if isinstance(value, (float, decimal.Decimal)):
        value = float(value)
        if math.isnan(value):
            return "NaN"
        return repr(value + 0.0)
    return repr(value)


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    kinds = {}
    for i in order:
        seen = {kind(r[i]) for r in rows if r[i] is not None}
        kinds[columns[i]] = "/".join(sorted(seen))
    data = sorted(tuple(norm(r[i]) for i in order) for r in rows)
    return [columns[i] for i in order], kinds, data


def compare(spark, con, name, fn, sql, sf_dir):
    df = fn(spark, sf_dir)
    a_cols, a_kinds, a = canonical(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return len(a), "no sql"
    cur = con.execute(sql)
    b_cols, b_kinds, b = canonical([d[0] for d in cur.description], cur.fetchall())
    if a_cols != b_cols:
        return len(a), f"columns {a_cols} / {b_cols}"
    for c in a_cols:
        if a_kinds[c] and b_kinds[c] and a_kinds[c] != b_kinds[c]:
            return len(a), f"type of {c}: {a_kinds[c]} / {b_kinds[c]}"
    if len(a) != len(b):
        return len(a), f"rows {len(a)} / {len(b)}"
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        return len(a), f"{len(bad)} rows differ, e.g. {bad[0][0]} / {bad[0][1]}"
    return len(a), "ok"


def main() -> None:
    from __spark_entry__ import oracle_sql, queries
    from marshlight.session import local_session

    args = sys.argv[1:]
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    parts = args[1:]
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, bad = duck(sf_dir), oracle_sql(), 0
    for name, fn in queries().items():
        if parts and not any(p in name for p in parts):
            continue
        t = time.time()
        try:
            n, result = compare(spark, con, name, fn, sqls.get(name), sf_dir)
        except Exception as err:  # a broken query must not hide the others
            n, result = -1, f"{type(err).__name__}: {str(err)[:700]}"
        if result not in ("ok", "no sql"):
            bad += 1
        if n == 0:
            result += " (empty)"
        print(f"{name:45s} {n:8d} {time.time() - t:6.2f}s {result}", flush=True)
    print("failures:", bad)


if __name__ == "__main__":
    main()

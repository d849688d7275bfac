"""Run a registered query and its SQL check side by side and compare them as the driver does."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def duck(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return con


def _cell(v):
    if v is None:
        return (0, "")
    if isinstance(v, bool):
        return (1, str(v))
    if isinstance(v, float):
        return (2, "nan" if math.isnan(v) else repr(v + 0.0))
    if isinstance(v, (list, tuple)):
        return (4, repr([_cell(x) for x in v]))
    return (3, str(v))


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows), [columns[i] for i in order]


def compare(spark, con, sf, name, fn, sql):
    t0 = time.time()
    df = fn(spark, sf)
    got = df.collect()
    took = time.time() - t0
    if sql is None:
        return len(got), took, None
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    want = cur.fetchall()
    a, ca = rows_of(df.columns, got)
    b, cb = rows_of(cols, want)
    if ca != cb:
        return len(got), took, f"columns {ca} != {cb}"
    types = dict(zip(cols, [str(d[1]) for d in cur.description]))
    kinds = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
    bad = {c: (t, types[c]) for c, t in df.dtypes if kinds.get(t, t) != types[c]}
    if bad:
        return len(got), took, f"types {bad}"
    if len(a) != len(b):
        return len(got), took, f"rows {len(a)} != {len(b)}; only here {[x for x in a if x not in set(b)][:2]}; only there {[x for x in b if x not in set(a)][:2]}"
    diff = [(x, y) for x, y in zip(a, b) if x != y]
    return len(got), took, f"{len(diff)} of {len(a)} differ, columns {ca}, e.g. {diff[0]}" if diff else None


def main():
    from roadlake.session import build_session
    from __spark_entry__ import oracle_sql, queries

    sf = f"/root/testdata/sf{sys.argv[1]}"
    wanted = sys.argv[2:]
    spark = build_session("compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
                                                    "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("FATAL")
    con, checks, failed = duck(sf), oracle_sql(), []
    for name, fn in queries().items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        try:
            n, took, problem = compare(spark, con, sf, name, fn, checks.get(name))
        except Exception as exc:  # keep going, report at the end
            n, took, problem = -1, 0.0, f"{type(exc).__name__}: {str(exc)[:700]}"
        if problem:
            failed.append(name)
        print(f"{name:32s} rows={n:7d} {took:6.2f}s {'ok' if problem is None else 'FAIL ' + problem}"
              f"{'' if checks.get(name) else ' (rows only)'}", flush=True)
    print("FAILED:", failed)


if __name__ == "__main__":
    main()

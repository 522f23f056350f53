"""Compare every registered Spark query with its DuckDB oracle (like the driver).

usage: python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import collections
import datetime as dt
import decimal
import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, float):
        return None if math.isnan(v) else repr(float(v))
    if isinstance(v, decimal.Decimal):
        return repr(float(v))
    if isinstance(v, int):
        return v
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return str(v)


def duck_type(t: str) -> str:
    t = t.upper()
    return {"BIGINT": "long", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string",
            "DATE": "date", "BOOLEAN": "boolean", "HUGEINT": "hugeint"}.get(t, t)


def spark_type(t: str) -> str:
    return {"bigint": "long", "int": "int", "double": "double", "string": "string",
            "date": "date", "boolean": "boolean"}.get(t, t)


def connect(sf_dir):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare(spark, con, name, query, sql, sf_dir):
    sdf = query(spark, sf_dir)
    s_cols = sdf.columns
    s_types = {f.name: spark_type(f.dataType.simpleString()) for f in sdf.schema.fields}
    s_rows = sdf.collect()
    cur = con.execute(sql)
    d_cols = [d[0] for d in cur.description]
    d_types = {d[0]: duck_type(str(d[1])) for d in cur.description}
    d_rows = cur.fetchall()
    problems = []
    if sorted(s_cols) != sorted(d_cols):
        problems.append(f"columns differ: spark-only {sorted(set(s_cols) - set(d_cols))} "
                        f"oracle-only {sorted(set(d_cols) - set(s_cols))}")
        return problems, len(s_rows), len(d_rows)
    for c in s_cols:
        if s_types[c] != d_types[c]:
            problems.append(f"type {c}: spark {s_types[c]} oracle {d_types[c]}")
    if len(s_rows) != len(d_rows):
        problems.append(f"row count spark {len(s_rows)} oracle {len(d_rows)}")
    cols = sorted(s_cols)
    s_idx = [s_cols.index(c) for c in cols]
    d_idx = [d_cols.index(c) for c in cols]
    sc = collections.Counter(tuple(norm(r[i]) for i in s_idx) for r in s_rows)
    dc = collections.Counter(tuple(norm(r[i]) for i in d_idx) for r in d_rows)
    if sc != dc:
        only_s = list((sc - dc).elements())[:3]
        only_d = list((dc - sc).elements())[:3]
        problems.append(f"values differ ({sum((sc - dc).values())} spark-only rows)\n"
                        f"   cols   {cols}\n   spark  {only_s}\n   oracle {only_d}")
    return problems, len(s_rows), len(d_rows)


if __name__ == "__main__":
    SF = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    import __spark_entry__ as E
    from kpiloom.session import local_session
    spark = local_session()
    con = connect(SF)
    qs, sqls = E.queries(), E.oracle_sql()
    names = sys.argv[2:] or list(qs)
    bad = 0
    for n in names:
        t = time.time()
        if n not in sqls:
            print(f"{n:30s} NO ORACLE")
            continue
        try:
            problems, ns, nd = compare(spark, con, n, qs[n], sqls[n], SF)
        except Exception as e:  # report and continue
            problems, ns, nd = [f"{type(e).__name__}: {str(e)[:800]}"], -1, -1
        status = "OK " if not problems else "BAD"
        bad += bool(problems)
        print(f"{status} {n:30s} rows={ns} oracle={nd} {time.time() - t:5.1f}s", flush=True)
        for p in problems:
            print("    " + p, flush=True)
    print(f"{len(names) - bad}/{len(names)} match")

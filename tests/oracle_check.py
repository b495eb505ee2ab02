"""Run registered queries in Spark and their oracle SQL in DuckDB and
compare row count, column names and order-insensitive values.

    python tests/oracle_check.py [sf_dir] [name ...]
"""
from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 4)
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    return v


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, name, fn, sql, sf_dir):
    t = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    ts = time.time() - t
    if sql is None:
        return dict(name=name, status="no-oracle", rows=len(s_rows), spark_s=round(ts, 2))
    t = time.time()
    res = con.sql(sql)
    d_cols = res.columns
    d_rows = res.fetchall()
    td = time.time() - t
    out = dict(name=name, rows=len(s_rows), oracle_rows=len(d_rows), spark_s=round(ts, 2), duck_s=round(td, 2))
    if sorted(s_cols) != sorted(d_cols):
        out["status"] = f"COLUMNS {sorted(s_cols)} vs {sorted(d_cols)}"
        return out
    a, b = rows_of(s_cols, s_rows), rows_of(d_cols, d_rows)
    if a == b:
        out["status"] = "ok"
    else:
        diff = [x for x in a if x not in set(b)][:3]
        diff2 = [x for x in b if x not in set(a)][:3]
        out["status"] = f"VALUES spark-only={diff} duck-only={diff2}"
    return out


def main():
    import duckdb
    from __spark_entry__ import oracle_sql, queries
    from catalog_engine.session import local_session
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = local_session(8)
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    qs, sq = queries(), oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if names and name not in names:
            continue
        try:
            r = compare(spark, con, name, fn, sq.get(name), sf_dir)
        except Exception as e:  # report and continue
            r = dict(name=name, status=f"ERROR {type(e).__name__}: {str(e)[:400]}")
        if r["status"] not in ("ok", "no-oracle"):
            bad += 1
        print(r, flush=True)
    print("BAD", bad)


if __name__ == "__main__":
    main()

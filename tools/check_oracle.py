"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

Usage: python tools/check_oracle.py [sf_dir] [name ...]
Comparison: row count, column names, and the sorted multiset of rows.
"""

from __future__ import annotations

import math
import sys
import time

import duckdb

sys.path.insert(0, ".")
from papertriage.plans.registry import all_queries  # noqa: E402
from papertriage.session import build_session  # noqa: E402
from papertriage.sources.tables import TABLES, table_path  # noqa: E402


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return repr(v)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return repr(v)


def compare(spark, con, sf_dir, q):
    t0 = time.time()
    sdf = q.fn(spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    scols = sdf.columns
    if q.sql is None:
        return dict(name=q.name, rows=len(srows), oracle=None, secs=round(t1 - t0, 2))
    res = con.sql(q.sql)
    dcols = res.columns
    drows = res.fetchall()
    ok_cols = sorted(scols) == sorted(dcols)
    out = dict(name=q.name, rows=len(srows), oracle_rows=len(drows), cols_ok=ok_cols, secs=round(t1 - t0, 2))
    if ok_cols:
        idx = [dcols.index(c) for c in scols]
        d2 = sorted(tuple(_norm(r[i]) for i in idx) for r in drows)
        s2 = sorted(tuple(_norm(x) for x in r) for r in srows)
        out["values_ok"] = d2 == s2
        if not out["values_ok"]:
            diff = [(a, b) for a, b in zip(s2, d2) if a != b][:3]
            out["first_diff"] = diff
    else:
        out["spark_cols"], out["oracle_cols"] = scols, dcols
    out["spark_types"] = [f.dataType.simpleString() for f in sdf.schema.fields]
    out["oracle_types"] = [str(t) for t in res.types]
    return out


def main():
    args = sys.argv[1:]
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    names = args[1:]
    spark = build_session("local[8]", shuffle_partitions=8)
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(sf_dir, t)}')")
    qs = all_queries()
    bad = 0
    for name, q in qs.items():
        if names and name not in names:
            continue
        try:
            r = compare(spark, con, sf_dir, q)
        except Exception as e:  # report and continue
            r = dict(name=name, error=repr(e)[:2000])
        good = r.get("values_ok", q.sql is None and "error" not in r)
        bad += not good
        print(("OK  " if good else "BAD ") + str(r), flush=True)
    print("failures:", bad)


if __name__ == "__main__":
    main()

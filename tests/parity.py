"""Spark-vs-DuckDB parity check for registered queries (used by tests and by hand).

    python -m tests.parity [sf_dir] [name ...]
"""

from __future__ import annotations

import collections
import datetime as dt
import decimal
import os
import sys
import time

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return v.normalize() if v == v else v
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    return v


def _family(t: str) -> str:
    t = t.lower()
    for k, fam in (("decimal", "decimal"), ("bigint", "int64"), ("int64", "int64"), ("long", "int64"),
                   ("hugeint", "int128"), ("smallint", "int16"), ("tinyint", "int8"),
                   ("integer", "int32"), ("int", "int32"), ("double", "float"), ("float", "float"),
                   ("varchar", "string"), ("string", "string"), ("bool", "bool"),
                   ("timestamp", "timestamp"), ("date", "date")):
        if k in t:
            if fam == "decimal":
                return t.replace(" ", "")
            return fam
    return t


def compare(spark, con, name: str, builder, sql: str, sf_dir: str) -> dict:
    t0 = time.time()
    sdf = builder(spark, sf_dir)
    s_cols = sdf.columns
    s_types = dict(sdf.dtypes)
    s_rows = sdf.collect()
    t1 = time.time()
    cur = con.execute(sql)
    d_cols = [c[0] for c in cur.description]
    d_types = {c[0]: str(c[1]) for c in cur.description}
    d_rows = cur.fetchall()
    t2 = time.time()
    res = {"name": name, "spark_rows": len(s_rows), "duck_rows": len(d_rows),
           "spark_s": round(t1 - t0, 2), "duck_s": round(t2 - t1, 2)}
    if sorted(s_cols) != sorted(d_cols):
        res["error"] = f"columns differ: spark-only {set(s_cols) - set(d_cols)}, duck-only {set(d_cols) - set(s_cols)}"
        return res
    cols = sorted(s_cols)
    type_diff = {c: (s_types[c], d_types[c]) for c in cols
                 if _family(s_types[c]) != _family(d_types[c])}
    if type_diff:
        res["type_diff"] = type_diff
    si = [s_cols.index(c) for c in cols]
    di = [d_cols.index(c) for c in cols]
    sc = collections.Counter(tuple(_norm(r[i]) for i in si) for r in s_rows)
    dc = collections.Counter(tuple(_norm(r[i]) for i in di) for r in d_rows)
    if sc != dc:
        only_s = list((sc - dc).elements())[:3]
        only_d = list((dc - sc).elements())[:3]
        res["error"] = "values differ"
        res["cols"] = cols
        res["spark_only"] = only_s
        res["duck_only"] = only_d
    return res


def main(argv):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as E
    from quillmart.session import get_session
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    spark = get_session(extra={"spark.ui.showConsoleProgress": "false"})
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for n in (names or list(qs)):
        if n not in sqls:
            df = qs[n](spark, sf_dir)
            print(f"{n}: rows-only {df.count()}")
            continue
        try:
            r = compare(spark, con, n, qs[n], sqls[n], sf_dir)
        except Exception as e:  # noqa: BLE001
            r = {"name": n, "error": f"{type(e).__name__}: {str(e)[:600]}"}
        ok = "error" not in r
        bad += not ok
        print(("OK  " if ok else "FAIL") + f" {r}", flush=True)
    print(f"{bad} failing")


if __name__ == "__main__":
    main(sys.argv)

"""Spark result vs DuckDB oracle, the way the driver compares them:
row count, column names, order-insensitive values (doubles at 6 decimals).

Run: python tests/oracle_check.py [sf_dir] [name-substring ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6) + 0.0
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6) + 0.0
    if isinstance(v, dt.datetime):
        return v.isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(norm(r[i]) for i in order) for r in rows]
    return [cols[i] for i in order], sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


def compare(spark, con, spec, sf_dir):
    t0 = time.time()
    sdf = spec.build(spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    scols = sdf.columns
    t1 = time.time()
    if spec.sql is None:
        return {"name": spec.name, "status": "no-oracle", "rows": len(srows), "spark_s": round(t1 - t0, 2)}
    cur = con.execute(spec.sql)
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    c1, r1 = canon(scols, srows)
    c2, r2 = canon(dcols, drows)
    res = {"name": spec.name, "rows": len(srows), "oracle_rows": len(drows), "spark_s": round(t1 - t0, 2)}
    if c1 != c2:
        res.update(status="SCHEMA", spark_cols=c1, oracle_cols=c2)
    elif len(r1) != len(r2):
        res.update(status="ROWS")
    elif r1 != r2:
        bad = [(a, b) for a, b in zip(r1, r2) if a != b][:2]
        res.update(status="VALUES", cols=c1, diff=bad)
    else:
        res.update(status="OK")
    return res


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    pats = sys.argv[2:]
    from riskbeacon.plans.catalog import load_all
    from riskbeacon.session import get_session
    spark = get_session("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    specs = load_all()
    bad = 0
    from riskbeacon.plans import ml, pipeline
    for i, (name, spec) in enumerate(specs.items()):
        if pats and not any(p in name for p in pats):
            continue
        if i % 10 == 0:
            pipeline.clear_cache()
            ml.clear_cache()
        try:
            r = compare(spark, con, spec, sf_dir)
        except Exception as e:  # report and continue
            r = {"name": name, "status": "ERROR", "error": str(e)[:800]}
        if r["status"] not in ("OK", "no-oracle"):
            bad += 1
        print(r, flush=True)
    print("FAILED", bad)


if __name__ == "__main__":
    main()

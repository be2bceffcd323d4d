"""Run registered queries on Spark and their DuckDB twins; compare exactly.

Usage: python tests/oracle_compare.py [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return float(v)
    if hasattr(v, "isoformat"):
        return str(v)[:26].replace("T", " ")
    if hasattr(v, "item"):
        return v.item()
    return v


def rows_of(records, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in records]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


_SPARK = {"int": "int32", "bigint": "int64", "smallint": "int16", "tinyint": "int8", "double": "float64",
          "float": "float32", "string": "string", "date": "date", "timestamp": "timestamp",
          "timestamp_ntz": "timestamp", "boolean": "bool"}
_DUCK = {"INTEGER": "int32", "BIGINT": "int64", "SMALLINT": "int16", "TINYINT": "int8", "DOUBLE": "float64",
         "FLOAT": "float32", "VARCHAR": "string", "DATE": "date", "TIMESTAMP": "timestamp", "BOOLEAN": "bool",
         "HUGEINT": "int128"}


def spark_family(t: str) -> str:
    return "decimal" if t.startswith("decimal") else _SPARK.get(t, t)


def duck_family(t: str) -> str:
    t = str(t)
    return "decimal" if t.startswith("DECIMAL") else _DUCK.get(t, t)


def compare(spark, name, fn, sql, sf_dir, con):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    scols = sdf.columns
    srows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    info = {"name": name, "spark_rows": len(srows), "oracle_rows": len(drows), "sec": round(t1 - t0, 2)}
    if sorted(scols) != sorted(dcols):
        info["error"] = f"columns differ: {sorted(scols)} vs {sorted(dcols)}"
        return info
    st = {c: spark_family(t) for c, t in sdf.dtypes}
    dt = {d[0]: duck_family(d[1]) for d in res.description}
    bad_types = {c: (st[c], dt[c]) for c in scols if st[c] != dt[c]}
    if bad_types:
        info["error"] = f"types differ: {bad_types}"
        return info
    a, b = rows_of(srows, scols), rows_of(drows, dcols)
    if a != b:
        diffs = [(x, y) for x, y in zip(a, b) if x != y][:3]
        info["error"] = f"values differ: {diffs}" if len(a) == len(b) else "row count differs"
    return info


def main(argv):
    sys.path.insert(0, ".")
    from __spark_entry__ import oracle_sql, queries
    from regiostat.session import get_session
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:] or list(queries())
    spark = get_session("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    q, o = queries(), oracle_sql()
    bad = 0
    for n in names:
        if n not in o:
            print(f"{n}: no oracle")
            continue
        try:
            info = compare(spark, n, q[n], o[n], sf_dir, con)
        except Exception as e:  # report and continue
            info = {"name": n, "error": f"{type(e).__name__}: {str(e)[:400]}"}
        bad += "error" in info
        print(info, flush=True)
    print(f"mismatches: {bad}")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)

"""Compare registered Spark queries with their DuckDB oracles.

Mirrors the driver's gate: same row count, same column names, and the
same multiset of rows (columns sorted by name, values normalised).
Usage: ``python tests/oracle.py [--plain] [sf_dir] [name ...]`` (``--plain``: a
session configured like the driver's instead of ours).
"""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(round(v, 6))
    if isinstance(v, decimal.Decimal):
        return repr(round(float(v), 6))
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, int):
        return str(v)
    if isinstance(v, dt.datetime):
        return v.isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return repr([norm(x) for x in v])
    if isinstance(v, dict):
        return repr(sorted((k, norm(x)) for k, x in v.items()))
    return str(v)


def digest(cols: list[str], rows: list[tuple]) -> tuple[int, str]:
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted(repr([norm(r[i]) for i in order]) for r in rows)
    return len(lines), hashlib.sha256("\n".join(lines).encode()).hexdigest()


def compare(spark, sf_dir: str, names: list[str] | None = None, verbose: bool = True) -> dict[str, dict]:
    import __spark_entry__ as E

    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    out = {}
    for name in names or list(qs):
        rec = {"has_oracle": name in sqls}
        t = time.time()
        try:
            df = qs[name](spark, sf_dir)
            cols = df.columns
            rows = [tuple(r) for r in df.collect()]
            rec["spark_rows"] = len(rows)
            rec["spark_sec"] = round(time.time() - t, 2)
            if name in sqls:
                res = con.execute(sqls[name])
                dcols = [c[0] for c in res.description]
                drows = res.fetchall()
                rec["oracle_rows"] = len(drows)
                rec["cols_match"] = sorted(cols) == sorted(dcols)
                if not rec["cols_match"]:
                    rec["cols"] = (sorted(cols), sorted(dcols))
                n1, h1 = digest(cols, rows)
                n2, h2 = digest(dcols, drows)
                rec["match"] = rec["cols_match"] and n1 == n2 and h1 == h2
                if not rec["match"] and rec["cols_match"]:
                    o1 = sorted(cols, key=str)
                    i1 = [cols.index(c) for c in o1]
                    i2 = [dcols.index(c) for c in o1]
                    s1 = {repr([norm(r[i]) for i in i1]) for r in rows}
                    s2 = {repr([norm(r[i]) for i in i2]) for r in drows}
                    rec["only_spark"] = sorted(s1 - s2)[:3]
                    rec["only_oracle"] = sorted(s2 - s1)[:3]
        except Exception as e:  # noqa: BLE001
            rec["error"] = f"{type(e).__name__}: {str(e)[:400]}"
        out[name] = rec
        if verbose:
            print(name, rec, flush=True)
    return out


if __name__ == "__main__":
    args = sys.argv[1:]
    plain = "--plain" in args
    args = [a for a in args if a != "--plain"]
    sf = args[0] if args else "/root/testdata/sf0.01"
    names = args[1:] or None
    if plain:  # a session configured like the driver's, not ours
        from pyspark.sql import SparkSession

        spark = SparkSession.builder.master("local[*]").config("spark.sql.shuffle.partitions", "8").getOrCreate()
    else:
        from civiclake.session import build_session

        spark = build_session("local[8]")
    res = compare(spark, sf, names)
    bad = [k for k, v in res.items() if not v.get("match", not v.get("has_oracle")) or "error" in v]
    print("MISMATCH/ERROR:", bad)
    print(f"{len(res) - len(bad)}/{len(res)} ok")

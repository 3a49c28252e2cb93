"""Compare registered Spark queries with their DuckDB oracle SQL.

Usage: python tests/oracle_check.py [--plain] [sf_dir] [name ...]
Prints one line per query and exits non-zero on any mismatch.
"""

from __future__ import annotations

import collections
import datetime as dt
import decimal
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def _norm(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def rows_of_spark(df) -> tuple[list[str], collections.Counter]:
    cols = df.columns
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    data = collections.Counter(tuple(_norm(r[i]) for i in order) for r in df.collect())
    return [cols[i] for i in order], data


def rows_of_duckdb(con, sql: str) -> tuple[list[str], collections.Counter]:
    res = con.execute(sql)
    cols = [d[0] for d in res.description]
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    data = collections.Counter(tuple(_norm(r[i]) for i in order) for r in res.fetchall())
    return [cols[i] for i in order], data


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare(spark, sf_dir: str, names: list[str] | None = None, verbose: bool = True) -> dict[str, dict]:
    import __spark_entry__ as se

    qs, sqls = se.queries(), se.oracle_sql()
    con = duck(sf_dir)
    out = {}
    for name in names or list(qs):
        rec: dict = {"name": name}
        t0 = time.time()
        s_cols, s_rows = rows_of_spark(qs[name](spark, sf_dir))
        rec["spark_sec"] = round(time.time() - t0, 2)
        rec["rows"] = sum(s_rows.values())
        if name in sqls:
            o_cols, o_rows = rows_of_duckdb(con, sqls[name])
            rec["oracle_rows"] = sum(o_rows.values())
            rec["cols_ok"] = s_cols == o_cols
            rec["values_ok"] = s_rows == o_rows
            if not rec["values_ok"] and rec["cols_ok"]:
                only_s = list((s_rows - o_rows).items())[:3]
                only_o = list((o_rows - s_rows).items())[:3]
                rec["diff"] = {"spark_only": only_s, "oracle_only": only_o}
            elif not rec["cols_ok"]:
                rec["diff"] = {"spark_cols": s_cols, "oracle_cols": o_cols}
        else:
            rec["cols_ok"] = rec["values_ok"] = None
        out[name] = rec
        if verbose:
            print(rec, flush=True)
    return out


if __name__ == "__main__":
    from wreckline.session import build_session

    # --plain: a bare session with Spark's defaults, as an outside caller would build it
    plain = "--plain" in sys.argv
    args = [a for a in sys.argv[1:] if a != "--plain"]
    sf = args[0] if args else "/root/testdata/sf0.01"
    names = args[1:] or None
    if plain:
        from pyspark.sql import SparkSession

        spark = SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false").getOrCreate()
    else:
        spark = build_session("oracle-check", master="local[8]", shuffle_partitions=8)
    res = compare(spark, sf, names)
    bad = [n for n, r in res.items() if r["values_ok"] is False or r["cols_ok"] is False]
    print("MISMATCH:", bad if bad else "none")
    sys.exit(1 if bad else 0)

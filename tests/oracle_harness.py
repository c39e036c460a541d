"""Run registered queries on Spark and their SQL twins on DuckDB, and compare.

Usage: python tests/oracle_harness.py [sf_dir] [name ...]
Prints one line per query: rows on both sides, column match, value match.
"""

from __future__ import annotations

import datetime
import math
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, ".")

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None or v is pd.NaT or v is pd.NA:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if isinstance(v, pd.Timestamp):
        v = v.to_pydatetime().replace(tzinfo=None)
    if isinstance(v, datetime.datetime):
        return v.date().isoformat() if v.time() == datetime.time(0) else v.isoformat()
    if isinstance(v, datetime.date):
        return v.isoformat()
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        try:
            return _norm(v.item())
        except Exception:
            return v
    return v


def rows_of(pdf: pd.DataFrame) -> list[tuple]:
    cols = sorted(pdf.columns)
    out = []
    for rec in pdf[cols].itertuples(index=False, name=None):
        out.append(tuple(_norm(v) for v in rec))
    out.sort(key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))
    return out


def compare(spark, con, sf_dir: str, name: str, fn, sql: str | None) -> dict:
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    spdf = sdf.toPandas()
    t1 = time.time()
    res = {"name": name, "spark_rows": len(spdf), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        res["oracle"] = "none"
        return res
    dpdf = con.execute(sql).fetchdf()
    res["oracle_rows"] = len(dpdf)
    res["cols_match"] = sorted(spdf.columns) == sorted(dpdf.columns)
    if not res["cols_match"]:
        res["spark_cols"] = sorted(spdf.columns)
        res["oracle_cols"] = sorted(dpdf.columns)
        return res
    a, b = rows_of(spdf), rows_of(dpdf)
    res["values_match"] = a == b
    if not res["values_match"]:
        sa, sb = set(a), set(b)
        diff_a = [r for r in a if r not in sb][:3]
        diff_b = [r for r in b if r not in sa][:3]
        res["cols"] = sorted(spdf.columns)
        res["spark_only"] = diff_a
        res["oracle_only"] = diff_b
    return res


def main(argv: list[str]) -> int:
    from etalage.session import build_session
    import __spark_entry__ as E

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:]
    spark = build_session("local[8]", shuffle_partitions=8, conf={"spark.driver.memory": "8g"})
    con = duck(sf_dir)
    qs, oracles = E.queries(), E.oracle_sql()
    bad = 0
    for name in names or sorted(qs):
        try:
            res = compare(spark, con, sf_dir, name, qs[name], oracles.get(name))
        except Exception as exc:  # report and go on
            res = {"name": name, "error": repr(exc)[:600]}
        ok = res.get("values_match") or res.get("oracle") == "none"
        bad += 0 if ok else 1
        print(("OK  " if ok else "BAD ") + str(res), flush=True)
    print(f"{len(names or qs) - bad} ok, {bad} bad")
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))

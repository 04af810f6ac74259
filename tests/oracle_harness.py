"""Compare a registered Spark query with its DuckDB oracle, like the driver.

Columns are sorted by name, rows compared as a multiset of normalised tuples.
Run as ``python -m tests.oracle_harness [sf_dir] [name ...]``.
"""

from __future__ import annotations

import datetime as dt
import math
import sys
from collections import Counter

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
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
        return repr(v + 0.0)
    if hasattr(v, "to_pydatetime"):
        v = v.to_pydatetime()
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, bool):
        return str(int(v))
    return str(v)


def rows_of(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [tuple(_norm(r[i]) for i in order) for r in records]


def compare(spark, name: str, sf_dir: str, con=None, fn=None, sql=None) -> dict:
    import __spark_entry__ as se
    fn = fn or se.queries()[name]
    sql = sql or se.oracle_sql().get(name)
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = rows_of(s_cols, [tuple(r) for r in sdf.collect()])
    out = {"name": name, "spark_rows": len(s_rows)}
    if sql is None:
        out["status"] = "rows-only"
        return out
    con = con or duck(sf_dir)
    res = con.execute(sql)
    d_cols = [c[0] for c in res.description]
    d_rows = rows_of(d_cols, res.fetchall())
    out["oracle_rows"] = len(d_rows)
    out["columns_match"] = sorted(s_cols) == sorted(d_cols)
    cs, cd = Counter(s_rows), Counter(d_rows)
    out["values_match"] = cs == cd
    out["status"] = "ok" if out["columns_match"] and out["values_match"] else "MISMATCH"
    if out["status"] != "ok":
        out["spark_cols"] = sorted(s_cols)
        out["oracle_cols"] = sorted(d_cols)
        out["only_spark"] = list((cs - cd).elements())[:3]
        out["only_oracle"] = list((cd - cs).elements())[:3]
    return out


def main(argv):
    sys.path.insert(0, ".")
    from tirepulse.session import local_session
    import __spark_entry__ as se
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or list(se.queries())
    spark = local_session(8)
    con = duck(sf_dir)
    bad = 0
    for n in names:
        try:
            r = compare(spark, n, sf_dir, con)
        except Exception as exc:  # report and continue
            r = {"name": n, "status": "ERROR", "error": str(exc)[:2000]}
        bad += r["status"] not in ("ok", "rows-only")
        print(r, flush=True)
    print(f"{len(names) - bad}/{len(names)} ok")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)

"""Run registered queries in Spark and their oracle SQL in DuckDB and compare
(row count, column names, order-insensitive values).  Usable from pytest and
from the command line:  python -m tests.oracle_harness [sf_dir] [name ...]"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6) + 0.0
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6) + 0.0
    if isinstance(v, (dt.datetime, dt.date)):
        return str(v)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return _norm(v.asDict())
    if hasattr(v, "toArray"):
        return tuple(_norm(float(x)) for x in v.toArray())
    return v


def rows_key(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def compare(spark, sf_dir: str, name: str, q, sql: str | None, con=None):
    t0 = time.time()
    sdf = q(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t_spark = time.time() - t0
    res = {"name": name, "rows": len(s_rows), "spark_s": round(t_spark, 2)}
    if sql is None:
        res["status"] = "rows-only"
        return res
    con = con or duck(sf_dir)
    cur = con.execute(sql)
    d_cols = [d[0] for d in cur.description]
    d_rows = cur.fetchall()
    if sorted(s_cols) != sorted(d_cols):
        res.update(status="COLS", spark_cols=sorted(s_cols), duck_cols=sorted(d_cols))
        return res
    if len(s_rows) != len(d_rows):
        res.update(status="COUNT", duck_rows=len(d_rows))
        return res
    a, b = rows_key(s_cols, s_rows), rows_key(d_cols, d_rows)
    if a != b:
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        res.update(status="VALUES", cols=sorted(s_cols), diff=diff)
        return res
    res["status"] = "ok"
    return res


def main(argv):
    sys.path.insert(0, ".")
    from rarecast.session import get_session
    import __spark_entry__ as E
    sf = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    spark = get_session()
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf)
    bad = 0
    for name in (names or list(qs)):
        try:
            r = compare(spark, sf, name, qs[name], sqls.get(name), con)
        except Exception as e:  # noqa: BLE001
            r = {"name": name, "status": "ERROR", "err": str(e)[:600]}
        if r["status"] not in ("ok", "rows-only"):
            bad += 1
        print(r, flush=True)
    print(f"{len(names or qs) - bad} passed, {bad} failed")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))

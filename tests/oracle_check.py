"""Compare every ``queries()`` key with its ``oracle_sql()`` statement on DuckDB.

Usage: ``python tests/oracle_check.py [sf_dir] [key ...]``.  Prints one line
per key: row counts, column names, and an order-insensitive value match.
"""

from __future__ import annotations

import datetime as dt
import decimal
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


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
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, decimal.Decimal):
        return str(v.normalize()) if v == v.to_integral_value() else format(v.normalize(), "f")
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), str(x)) for x in t))


SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR", "date": "DATE",
                 "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN", "double": "DOUBLE", "smallint": "SMALLINT"}


def duck_type(spark_type: str) -> str:
    if spark_type.startswith("decimal"):
        return spark_type.upper().replace(" ", "")
    return SPARK_TO_DUCK.get(spark_type, spark_type.upper())


def type_diffs(df, con, sql):
    got = dict(df.dtypes)
    want = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    return {c: (duck_type(t), want.get(c)) for c, t in got.items() if duck_type(t) != want.get(c)}


def compare(spark, con, sf_dir, key, fn, sql):
    t = time.time()
    df = fn(spark, sf_dir)
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    ts = time.time() - t
    if sql is None:
        return f"{key:30s} spark_rows={len(s_rows):7d} (no oracle) {ts:5.1f}s"
    res = con.execute(sql)
    d_cols = [c[0] for c in res.description]
    d_rows = res.fetchall()
    ok_cols = sorted(s_cols) == sorted(d_cols)
    ok_n = len(s_rows) == len(d_rows)
    ok_v = ok_cols and ok_n and rows_of(s_cols, s_rows) == rows_of(d_cols, d_rows)
    types = type_diffs(df, con, sql)
    status = "OK " if ok_v and not types else "BAD"
    msg = f"{status} {key:30s} rows spark={len(s_rows)} duck={len(d_rows)} cols={'ok' if ok_cols else 'DIFF'} {ts:5.1f}s"
    if types:
        msg += f"\n     type differences (spark, duck): {types}"
    if not ok_cols:
        msg += f"\n     spark={sorted(s_cols)}\n     duck ={sorted(d_cols)}"
    elif not ok_v:
        a, b = rows_of(s_cols, s_rows), rows_of(d_cols, d_rows)
        sa, sb = set(a), set(b)
        only_s = [r for r in a if r not in sb][:3]
        only_d = [r for r in b if r not in sa][:3]
        names = sorted(s_cols)
        msg += f"\n     cols={names}\n     spark-only={only_s}\n     duck-only ={only_d}"
    return msg


def main(argv):
    sf_dir = argv[0] if argv and argv[0].startswith("/") else "/root/testdata/sf0.01"
    keys = [a for a in argv if not a.startswith("/")]
    import __spark_entry__ as E
    from emporia.session import get_session

    spark = get_session("local[8]")
    spark.sparkContext.setLogLevel("ERROR")
    qs, oracle = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for k in keys or list(qs):
        try:
            line = compare(spark, con, sf_dir, k, qs[k], oracle.get(k))
        except Exception as e:  # noqa: BLE001
            line = f"ERR {k:30s} {type(e).__name__}: {str(e)[:500]}"
        bad += line.startswith(("BAD", "ERR"))
        print(line, flush=True)
    print(f"done: {bad} failing of {len(keys or qs)}")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)

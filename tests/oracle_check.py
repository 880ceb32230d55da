"""Run every registered query beside its DuckDB oracle and compare.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
Prints one line per query: rows, column names and an order-insensitive hash
of the values must agree.
"""

from __future__ import annotations

import hashlib
import math
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def _norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(round(v, 9))
    if isinstance(v, (bytes, bytearray)):
        return v.hex()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    return str(v)


def frame_digest(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("\x1f".join(_norm(r[i]) for i in order) for r in rows)
    h = hashlib.sha256("\n".join(lines).encode()).hexdigest()[:16]
    return [columns[i] for i in order], len(rows), h


def oracle(con, sql):
    res = con.sql(sql)
    return list(res.columns), res.fetchall()


def duck(sf_dir):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare(spark, sf_dir, names=None, verbose=True):
    import __spark_entry__ as e
    qs, sqls = e.queries(), e.oracle_sql()
    con = duck(sf_dir)
    results = {}
    for name, fn in qs.items():
        if names and name not in names:
            continue
        t0 = time.time()
        try:
            df = fn(spark, sf_dir)
            rows = [tuple(r) for r in df.collect()]
            s_cols, s_n, s_h = frame_digest(df.columns, rows)
        except Exception as exc:  # report and go on
            results[name] = ("ERROR", repr(exc)[:300])
            if verbose:
                print(f"{name:24s} SPARK ERROR {exc!r}"[:400], flush=True)
            continue
        dt = time.time() - t0
        if name not in sqls:
            results[name] = ("ROWS_ONLY", s_n)
            if verbose:
                print(f"{name:24s} rows-only {s_n} rows  {dt:.1f}s", flush=True)
            continue
        o_cols, o_rows = oracle(con, sqls[name])
        o_cols, o_n, o_h = frame_digest(o_cols, o_rows)
        ok = (s_cols == o_cols, s_n == o_n, s_h == o_h)
        results[name] = ("OK" if all(ok) else "MISMATCH", ok)
        if verbose:
            status = "OK" if all(ok) else f"MISMATCH cols={ok[0]} rows={ok[1]} hash={ok[2]}"
            print(f"{name:24s} {status}  spark={s_n} oracle={o_n}  {dt:.1f}s", flush=True)
            if not ok[0]:
                print("   spark cols ", s_cols, "\n   oracle cols", o_cols)
    return results


def main():
    from quayside.session import get_session
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = set(sys.argv[2:]) or None
    spark = get_session("local[8]", shuffle_partitions=8,
                        extra={"spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="qs-ckpt-", dir="/tmp"))
    res = compare(spark, sf_dir, names)
    bad = [k for k, v in res.items() if v[0] not in ("OK", "ROWS_ONLY")]
    print("FAILED:", bad if bad else "none")


if __name__ == "__main__":
    main()

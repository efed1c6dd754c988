"""Runs every registered query next to its SQL twin and compares values."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _key(v):
    if isinstance(v, bool):
        return ("b", v)
    if isinstance(v, (int, float)):
        return ("n", "nan") if isinstance(v, float) and math.isnan(v) else ("n", repr(float(v)))
    return ("s", str(v))


def normalised(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_key(r[i]) for i in order) for r in rows)


def compare(spark, con, name, fn, sql, sf_dir):
    """None when equal, else a description of the difference."""
    df = fn(spark, sf_dir)
    got_cols, got = normalised(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return None if got else "no rows"
    cur = con.execute(sql)
    want_cols, want = normalised([c[0] for c in cur.description], cur.fetchall())
    if got_cols != want_cols:
        return f"columns {got_cols} vs {want_cols}"
    if len(got) != len(want):
        return f"{len(got)} rows vs {len(want)}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    if bad:
        return f"{len(bad)} of {len(got)} rows differ, first {bad[0]}"
    kinds = [str(t) for t in cur.description]
    return None


def main():
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from pyspark.sql import SparkSession
    import __spark_entry__ as entry
    sf = os.environ.get("SF", "0.01")
    sf_dir = f"/root/testdata/sf{sf}"
    wanted = sys.argv[1:]
    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC")
             .config("spark.driver.memory", "8g").config("spark.ui.showConsoleProgress", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    failed, slow = 0, []
    for name, fn in queries.items():
        if wanted and not any(name == w or name.startswith(w + "_") or (w.endswith("*") and name.startswith(w[:-1])) for w in wanted):
            continue
        t = time.time()
        try:
            problem = compare(spark, con, name, fn, oracles.get(name), sf_dir)
        except Exception as e:  # report and go on
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        took = time.time() - t
        slow.append((took, name))
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name:32s} {took:6.2f}s {'' if name in oracles else '(rows only)'} {problem or ''}", flush=True)
    print("failed", failed, "of", len(slow), "total", round(sum(t for t, _ in slow), 1), "slowest", sorted(slow)[-5:])
    spark.stop()


if __name__ == "__main__":
    main()

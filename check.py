"""Run registered queries on Spark and their SQL on DuckDB and compare the rows.

    python check.py [--sf 0.01] [--only name,name] [--part text]
"""

from __future__ import annotations

import argparse
import math
import tempfile
import time
from decimal import Decimal

import duckdb
from pyspark.sql import SparkSession

from kinweave.catalog import QUERIES

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def session(cpus: int = 8) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="kinweave-")).config("spark.ui.enabled", "false").config("spark.driver.memory", "10g")
        .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, (int, float, Decimal)):
        f = float(value)
        return None if math.isnan(f) else float(f"{f:.10g}")
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr), [columns[i] for i in order]


def main() -> None:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="0.01")
    parser.add_argument("--only", default="")
    parser.add_argument("--part", default="")
    args = parser.parse_args()
    folder = f"/root/testdata/sf{args.sf}"
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{folder}/{t}.parquet'")
    spark = session()
    wanted = [n for n in QUERIES if (not args.only or n in args.only.split(",")) and args.part in QUERIES[n].run.__self__.build.__module__]
    bad = []
    for name in wanted:
        q = QUERIES[name]
        start = time.time()
        try:
            df = q.run(spark, folder)
            got, got_cols = rows_of(df.columns, df.collect())
        except Exception as e:
            bad.append(name)
            print(f"{name:34s} SPARK FAILED {str(e)[:700]}", flush=True)
            continue
        took = time.time() - start
        if q.sql is None:
            print(f"{name:34s} rows only {len(got):7d} {took:6.2f}s", flush=True)
            continue
        try:
            rel = con.execute(q.sql)
            cols = [d[0] for d in rel.description]
            want, want_cols = rows_of(cols, rel.fetchall())
        except Exception as e:
            bad.append(name)
            print(f"{name:34s} SQL FAILED {str(e)[:700]}", flush=True)
            continue
        ok = got == want and got_cols == want_cols
        print(f"{name:34s} {'ok' if ok else 'DIFFERS':8s} {len(got):7d} {len(want):7d} {took:6.2f}s", flush=True)
        if not ok:
            bad.append(name)
            if got_cols != want_cols:
                print("   columns", got_cols, want_cols)
            a, b = set(map(repr, got)), set(map(repr, want))
            for label, d in (("spark", a - b), ("sql", b - a)):
                for r in sorted(d)[:2]:
                    print("  ", label, r[:400])
    print("bad:", bad, "of", len(wanted))


if __name__ == "__main__":
    main()

"""Run registered queries in Spark and in DuckDB and compare them as bags of rows."""

from __future__ import annotations

import datetime as dt
import os
import sys
import time
from collections import Counter
from decimal import Decimal

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (dt.date, Decimal)):
        return str(v)
    return v


def bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple((type(plain(r[i])).__name__, plain(r[i])) for i in order) for r in rows)


def compare(name, df, con, sql):
    """None if equal, else a description of the difference."""
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    want = cur.fetchall()
    got = df.collect()
    if sorted(cols) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(cols)}"
    a, b = bag(df.columns, got), bag(cols, want)
    if a == b:
        return None
    return (f"{len(got)} rows != {len(want)}; only Spark {list((a - b).items())[:2]}; "
            f"only SQL {list((b - a).items())[:2]}")


def main():
    import __spark_entry__ as entry
    from pyspark.sql import SparkSession

    sf_dir = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", "8").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    wanted = sys.argv[1:]
    oracle, bad = entry.oracle_sql(), 0
    for name, fn in entry.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            diff = compare(name, fn(spark, sf_dir), con, oracle[name]) if name in oracle else \
                f"(no SQL) {fn(spark, sf_dir).count()} rows"
        except Exception as ex:  # report and go on with the next query
            diff = f"{type(ex).__name__}: {str(ex)[:600]}"
        bad += diff is not None
        print(f"{'ok  ' if diff is None else 'BAD '} {name} {time.time() - start:.1f}s "
              f"{diff or ''}", flush=True)
    print(f"{bad} bad")


if __name__ == "__main__":
    main()

"""Run registered queries and their SQL on the same tables; compare as multisets."""

import math
import os
import sys
import time
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def check_connection(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _plain(v):
    if isinstance(v, float):
        return int(v) if v == math.floor(v) else round(v, 9)
    if isinstance(v, bool):
        return v
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def compare(spark, con, name, job, text, sf_dir):
    df = job(spark, sf_dir)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if text is None:
        return sum(got.values()), None
    cur = con.execute(text)
    columns = [d[0] for d in cur.description]
    assert sorted(columns) == sorted(df.columns), (name, sorted(columns), sorted(df.columns))
    want = rows_of(columns, cur.fetchall())
    extra, missing = got - want, want - got
    return sum(got.values()), (list(extra.items())[:3], list(missing.items())[:3]) if extra or missing else None


if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf = sys.argv[1]
    wanted = sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    con = check_connection(sf)
    sql = entry.oracle_sql()
    for name, job in entry.queries().items():
        if wanted and name not in wanted:
            continue
        began = time.time()
        try:
            n, diff = compare(spark, con, name, job, sql.get(name), sf)
            verdict = "ok" if diff is None else f"DIFF {diff}"
        except Exception as e:  # noqa: BLE001
            n, verdict = -1, f"FAIL {type(e).__name__} {str(e)[:1500]}"
        print(f"{name:22s} {n:8d} {time.time() - began:6.2f}s {verdict}", flush=True)

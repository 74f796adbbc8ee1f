"""Runs registered queries and their SQL on the same tables and compares the rows."""

from __future__ import annotations

import datetime
import decimal
import math
import os
import sys
import time
from collections import Counter

import duckdb
from pyspark.sql import SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings"
    " pages benchmark labels conversations"
).split()


def connect(folder):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, bool) or value is None or isinstance(value, str):
        return value
    if isinstance(value, (float, decimal.Decimal, int)):
        number = float(value)
        return "nan" if math.isnan(number) else (int(number) if number == int(number) else number)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return str(value)


def counted(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in rows)


def difference(spark, con, run, text, folder):
    """None when rows agree, else a short description; and both row counts and times."""
    start = time.time()
    df = run(spark, folder)
    ours = counted([tuple(r) for r in df.collect()], df.columns)
    ours_time = time.time() - start
    start = time.time()
    cursor = con.execute(text)
    columns = [c[0] for c in cursor.description]
    theirs = counted(cursor.fetchall(), columns)
    info = (sum(ours.values()), sum(theirs.values()), ours_time, time.time() - start)
    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(df.columns)} vs {sorted(columns)}", info
    if ours == theirs:
        return None, info
    extra, missing = list((ours - theirs).items())[:2], list((theirs - ours).items())[:2]
    return f"\n  only ours {extra}\n  only SQL {missing}", info


def main(folder, names):
    sys.path.insert(0, __file__.rsplit("/", 2)[0])
    import __spark_entry__ as entry
    from evalflow.session import build_session

    if os.environ.get("PLAIN_SESSION"):
        # a session without any of the settings the jobs would choose
        spark = (
            SparkSession.builder.master("local[*]")
            .config("spark.sql.shuffle.partitions", "8")
            .config("spark.ui.enabled", "false")
            .config("spark.sql.session.timeZone", os.environ["PLAIN_SESSION"])
            .getOrCreate()
        )
    else:
        spark = build_session(master="local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    queries, sql = entry.queries(), entry.oracle_sql()
    for name in names or queries:
        try:
            if name not in sql:
                print("norows", name, len(queries[name](spark, folder).collect()))
                continue
            bad, info = difference(spark, con, queries[name], sql[name], folder)
            print("BAD " if bad else "ok  ", name, "rows %d/%d  %.2fs / %.3fs" % info, (bad or "")[:1500], flush=True)
        except Exception as error:  # noqa: BLE001
            print("FAIL", name, type(error).__name__, str(error)[:1200], flush=True)


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])

"""Run registered queries against their check SQL."""

from __future__ import annotations

import math
import os
import sys

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def _plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, (int, float)) or type(value).__name__ == "Decimal":
        return round(float(value), 9) + 0.0
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_plain(r[i]) for i in order) for r in rows]
    return sorted(columns), sorted(out, key=repr)


def differences(spark_df, con, sql: str) -> str | None:
    """None when both results are the same, else what differs."""
    got_cols, got = rows_of(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    cur = con.execute(sql)
    want_cols, want = rows_of([d[0] for d in cur.description], cur.fetchall())
    if got_cols != want_cols:
        return f"columns {got_cols} / {want_cols}"
    if got != want:
        in_got, in_want = set(got), set(want)
        only_got = [r for r in got if r not in in_want][:3]
        only_want = [r for r in want if r not in in_got][:3]
        return f"{len(got)} / {len(want)} rows; only spark {str(only_got)[:900]}; only sql {str(only_want)[:900]}"
    return None


if __name__ == "__main__":
    import time

    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    folder = sys.argv[1]
    names = sys.argv[2:] or list(entry.queries())
    spark = (
        SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "8g").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    bad = 0
    for name in names:
        start = time.time()
        try:
            df = entry.queries()[name](spark, folder)
            if name not in entry.oracle_sql():
                message = f"no SQL, {df.count()} rows"
            else:
                message = differences(df, con, entry.oracle_sql()[name])
        except Exception as error:  # noqa: BLE001
            message = f"{type(error).__name__}: {str(error)[:700]}"
        bad += message is not None
        print(f"{name:28s} {time.time() - start:6.2f}s {message or 'ok'}", flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")

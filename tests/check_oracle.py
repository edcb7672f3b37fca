"""Runs queries and their SQL side by side; also usable as a script: check_oracle.py SF [name ...]."""

from __future__ import annotations

import datetime as dt
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _cell(v) -> str:
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        return repr(v)
    return repr(v)


def _rows(columns: list[str], rows) -> list[tuple[str, ...]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(spark, con, sf_dir: str, query, sql: str) -> str | None:
    """None if equal, else a short account of the difference."""
    df = query(spark, sf_dir)
    mine = _rows(df.columns, df.collect())
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    theirs = _rows(columns, cursor.fetchall())
    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(df.columns)} / {sorted(columns)}"
    if len(mine) != len(theirs):
        return f"rows {len(mine)} / {len(theirs)}"
    bad = [(a, b) for a, b in zip(mine, theirs, strict=True) if a != b]
    return f"{len(bad)} of {len(mine)} rows differ, first: {bad[0]}" if bad else None


if __name__ == "__main__":
    sys.path.insert(0, __file__.rsplit("/tests/", 1)[0])
    from pyspark.sql import SparkSession

    import __spark_entry__ as e

    spark = (
        SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g").config("spark.sql.shuffle.partitions", "8").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    sf = f"/root/testdata/{sys.argv[1]}"
    con = connect(sf)
    names = sys.argv[2:] or list(e.queries())
    for name in names:
        start = time.time()
        try:
            if name in e.oracle_sql():
                out = compare(spark, con, sf, e.queries()[name], e.oracle_sql()[name]) or "equal"
            else:
                out = f"rows only: {len(e.queries()[name](spark, sf).collect())}"
        except Exception as error:  # report and go on with the next query
            out = f"ERROR {str(error)[:600]}"
        print(f"@@ {name:28s} {time.time() - start:6.2f}s {out}", flush=True)

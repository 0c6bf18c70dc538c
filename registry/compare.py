"""Run queries next to their SQL and report differences: python -m registry.compare <sf_dir> [name part ...]"""

from __future__ import annotations

import sys
import time

import duckdb
import pandas as pd
from pyspark.sql import SparkSession

from registry import ORACLES, QUERIES

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def _canonical(df: pd.DataFrame) -> list[tuple]:
    columns = sorted(df.columns)

    def cell(v):
        if v is None or v is pd.NA or (isinstance(v, float) and v != v) or v is pd.NaT:
            return "~"
        if isinstance(v, bool):
            return str(v)
        if isinstance(v, (int, float)):
            return repr(float(v) + 0.0)
        return str(v)

    return sorted(tuple(cell(v) for v in row) for row in df[columns].astype(object).itertuples(index=False, name=None))


def differences(spark: SparkSession, con, sf: str, name: str) -> tuple[str, int]:
    got = QUERIES[name](spark, sf).toPandas()
    if name not in ORACLES:
        return ("" if len(got.columns) else "no columns"), len(got)
    want = con.execute(ORACLES[name]).df()
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} vs {sorted(want.columns)}", len(got)
    if len(got) != len(want):
        return f"rows {len(got)} vs {len(want)}", len(got)
    a, b = _canonical(got), _canonical(want)
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    return (f"{len(bad)} differing rows, e.g. {sorted(got.columns)}\n   {bad[0][0]}\n   {bad[0][1]}" if bad else ""), len(got)


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "16g").config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main() -> None:
    sf, parts = sys.argv[1], sys.argv[2:]
    spark, con = session(), connect(sf)
    failed = 0
    for name in QUERIES:
        if parts and not any(name.startswith(p) for p in parts):
            continue
        t = time.time()
        try:
            diff, n = differences(spark, con, sf, name)
        except Exception as e:  # report and go on with the next query
            diff, n = f"{type(e).__name__}: {str(e)[:1500]}", -1
        failed += bool(diff)
        kind = "sql " if name in ORACLES else "rows"
        print(f"{'FAIL' if diff else 'ok  '} {kind} {name:40s} {n:8d} rows {time.time() - t:6.1f}s {diff}", flush=True)
    print(f"failed: {failed}")


if __name__ == "__main__":
    main()

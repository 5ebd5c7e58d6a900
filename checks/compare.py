"""Run queries beside their oracle and compare values: `python -m checks.compare [sf] [names...]`."""

from __future__ import annotations

import os
import sys
import time

import duckdb
import pandas as pd
from pyspark.sql import SparkSession

from .oracle import oracle_sql
from .queries import queries

DATA = os.environ.get("TESTDATA_DIR", "/root/testdata")


def local_session(cpus: str = "8", partitions: int = 8) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("stormledger-checks")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(os.listdir(sf_dir)):
        con.execute(f"create view {file.removesuffix('.parquet')} as select * from '{sf_dir}/{file}'")
    return con


def normal(df: pd.DataFrame) -> list[tuple]:
    """Rows as plain tuples in a fixed order, with columns sorted by name."""
    df = df[sorted(df.columns)]
    columns = []
    for name in df.columns:
        values = df[name]
        if pd.api.types.is_datetime64_any_dtype(values):
            values = values.astype("datetime64[us]").astype(str)
        columns.append([None if v is None or v is pd.NA or v != v else v for v in values.tolist()])
    key = lambda row: tuple((v is None, str(type(v)), v if v is not None else 0) for v in row)
    return sorted(zip(*columns), key=key) if columns else []


def difference(got: pd.DataFrame, want: pd.DataFrame) -> str | None:
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} != {sorted(want.columns)}"
    if len(got) != len(want):
        return f"{len(got)} rows, expected {len(want)}"
    for a, b in zip(normal(got), normal(want)):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            return f"{sorted(got.columns)}\n   got {a}\n  want {b}"
    return None


def main(args: list[str]) -> int:
    sf = args[0] if args else "0.01"
    sf_dir = f"{DATA}/sf{sf}"
    spark, con = local_session(), oracle_connection(sf_dir)
    wanted, sql, bad = args[1:] or list(queries()), oracle_sql(), 0
    for name in wanted:
        start = time.time()
        got = queries()[name](spark, sf_dir).toPandas()
        took = time.time() - start
        if name not in sql:
            verdict = f"rows only: {len(got)}"
        else:
            problem = difference(got, con.execute(sql[name]).df())
            verdict = f"ok ({len(got)} rows)" if problem is None else f"DIFFERS {problem}"
            bad += problem is not None
        print(f"{name:28s} {took:6.1f}s  {verdict}", flush=True)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))

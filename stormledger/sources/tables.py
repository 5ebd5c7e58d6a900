"""Partitioned and plain table writers shared by all sources and steps."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def ensure_namespace(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`")


def replace_with(spark: SparkSession, path: str, write: Callable[[str], None]) -> None:
    """Replace a stored table by what `write` puts into a fresh folder beside it.

    The old table stays readable until the new one is whole, and for good if building it fails. So a
    table may also be built from itself.
    """
    files = spark.sparkContext._jvm.org.apache.hadoop.fs
    target, fresh = files.Path(path), files.Path(f"{path.rstrip('/')}.new-{uuid.uuid4().hex[:12]}")
    disk = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    try:
        write(fresh.toString())
        disk.delete(target, True)
        if not disk.rename(fresh, target):
            raise OSError(f"{fresh} could not be moved to {path}")
    finally:
        disk.delete(fresh, True)


def write_clustered(
    df: DataFrame, path: str, partition: str, cluster: list[str], mode: str = "overwrite"
) -> None:
    """Write one folder per partition value, sorted inside by the cluster columns.

    The rebalance hint lets adaptive execution split a day that holds far more rows than others
    into several files and merge small ones; the sort gives row groups narrow min/max ranges.
    """
    sorted_rows = df.hint("rebalance", F.col(partition)).sortWithinPartitions(partition, *cluster)
    _write(df.sparkSession, lambda at, how: sorted_rows.write.mode(how).partitionBy(partition).parquet(at), path, mode)


def write_table(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    _write(df.sparkSession, lambda at, how: df.write.mode(how).parquet(at), path, mode)


def _write(spark: SparkSession, write: Callable[[str, str], None], path: str, mode: str) -> None:
    if mode == "overwrite":
        replace_with(spark, path, lambda fresh: write(fresh, "errorifexists"))
    else:
        write(path, mode)

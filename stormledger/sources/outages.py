"""County outage readings: CSV in, typed and partitioned Parquet out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from ..config import Config
from ..functions.scores import safe_ratio
from ..functions.times import date_in_window, to_ts
from ..schemas import OUTAGE_COLUMNS, OUTAGE_RAW
from ..storage import stored
from .tables import write_clustered, write_table


def load_outage_csv(spark: SparkSession, path: str) -> DataFrame:
    """Read comma-separated readings with one header row, under a declared schema.

    The header must name the declared columns, and every line must have them all, readable as their
    types or empty: other files fail instead of filling wrong columns or leaving values out.
    """
    return spark.read.schema(OUTAGE_RAW).options(header=True, enforceSchema=False, mode="FAILFAST").csv(path)


def read_outage_lines(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(readings, quarantined): the lines that can be read, and the others as (line, file), for a load that must not stop.

    Lines with missing or further fields, or with values unreadable as their types, are quarantined
    whole. The header must still name the declared columns. Both are stored, so the files are read once.
    """
    lines = (
        spark.read.schema(f"{OUTAGE_RAW}, bad_line string")
        .options(header=True, enforceSchema=False, mode="PERMISSIVE", columnNameOfCorruptRecord="bad_line")
        .csv(path)
        .withColumn("file", F.input_file_name())
    )
    read = stored(lines, "outage_lines")
    good = read.where("bad_line is null").drop("bad_line", "file")
    return good, read.where("bad_line is not null").select(F.col("bad_line").alias("line"), "file")


def upsert_outage_raw(readings: DataFrame, path: str) -> None:
    """Merge readings into the stored ones: one row per county and time, that of the latest load.

    Loading the same readings again changes nothing. Of readings of one load that share county and
    time the one with most customers out stays, then the one with most customers. Readings without
    county or time have no key and are left out. Old and new rows meet in one aggregate, which
    combines before its shuffle.
    """
    spark, key = readings.sparkSession, ["fips_code", "run_start_time"]
    rows = readings.withColumn("load", F.lit(1))
    try:
        rows = rows.unionByName(spark.read.parquet(path).withColumn("load", F.lit(0)))
    except AnalysisException:
        pass  # nothing is stored yet
    rest = [c for c in readings.columns if c not in key]
    order = F.struct("load", F.coalesce("customers_out", F.lit(-1)), F.coalesce("total_customers", F.lit(-1)), *[F.col(c).alias(f"last_{c}") for c in rest])
    latest = rows.where("fips_code is not null and run_start_time is not null").groupBy(*key).agg(F.max(order).alias("r"))
    write_table(latest.select(*[F.col(c) if c in key else F.col(f"r.last_{c}").alias(c) for c in readings.columns]), path)


def save_outage_raw(readings: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Store raw readings. Overwrites, so a repeated load adds nothing; `append` is opt-in."""
    write_table(readings, path, mode)


def outage_part(raw: DataFrame) -> DataFrame:
    """Five-digit county code, ratio of customers out, and reading time."""
    return raw.select(
        F.lpad(F.col("fips_code").cast("string"), 5, "0").alias("county_fips"),
        "county",
        "state",
        "customers_out",
        "total_customers",
        safe_ratio(F.col("customers_out"), F.col("total_customers")).alias("outage_ratio"),
        to_ts(F.col("run_start_time")).alias("ts"),
    )


def save_outage_part(readings: DataFrame, path: str) -> None:
    by_day = readings.withColumn("ts_date", F.to_date("ts"))
    write_clustered(by_day, path, "ts_date", ["county_fips", "ts"])


def read_outage_part(spark: SparkSession, path: str, cfg: Config | None = None) -> DataFrame:
    """Typed readings; with settings, only the day folders of the window are listed and read."""
    readings = spark.read.parquet(path)
    if cfg is not None:
        readings = readings.where(date_in_window(F.col("ts_date"), cfg))
    return readings.select(*OUTAGE_COLUMNS)

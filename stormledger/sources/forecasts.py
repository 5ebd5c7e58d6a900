"""Nested gridded forecasts: one row per grid cell and model run, holding an array of steps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Config
from ..functions.times import in_window, ntz, trunc_hour
from ..schemas import BANDS, FORECAST


def in_init_times(cfg: Config) -> Column:
    """Whether a forecast is from one of the configured runs: their days are consecutive, so a
    range and the hour of day say it, however long the window."""
    times, t = cfg.init_times(), F.col("init_time")
    return t.between(ntz(min(times)), ntz(max(times))) & F.hour(t).isin(*cfg.init_hours) & (trunc_hour(t) == t)


def forecast_scan(spark: SparkSession, path: str, cfg: Config) -> DataFrame:
    """Forecasts of the configured runs.

    Only the day folders of those runs are read, and of each step only the declared bands.
    """
    days = [t.date() for t in cfg.init_times()]
    return (
        spark.read.schema(FORECAST)
        .parquet(path)
        .where(F.col("init_date").between(F.lit(min(days)), F.lit(max(days))))
        .where(in_init_times(cfg))
        .drop("init_date")
    )


def save_forecasts(forecasts: DataFrame, path: str, cfg: Config) -> None:
    """Store forecasts by run day, near cells together so that a region reads few row groups."""
    placed = forecasts.withColumn("init_date", F.to_date("init_time"))
    tile = [F.floor(F.col(c) / cfg.tile_deg) for c in ("lat", "lon")]
    (
        placed.hint("rebalance", F.col("init_date"))
        .sortWithinPartitions("init_date", *tile, "cell_id", "init_time")
        .write.mode("overwrite")
        .partitionBy("init_date")
        .parquet(path)
    )


def explode_forecast(forecasts: DataFrame, cfg: Config, *keep: str) -> DataFrame:
    """One row per wanted step: configured leads, valid inside the window.

    Opening the array, filtering and projecting fuse into one generated loop, in which unwanted
    steps never become rows. That is faster than filtering the array with a lambda, which Spark
    interprets. `keep` names further columns to carry along.
    """
    bands = [F.col(f"`{name}`").alias(short) for short, name in BANDS.items()]
    # Naming the fields keeps other bands of a wide table from being read.
    fields = ["time", "hours", *BANDS.values()]
    steps = F.arrays_zip(*[F.col("forecast").getField(name).alias(name) for name in fields])
    return (
        forecasts.select("cell_id", "init_time", *keep, F.inline(steps))
        .where(F.col("hours").isin(*cfg.lead_hours) & in_window(F.col("time"), cfg))
        .select(
            "cell_id",
            "init_time",
            *keep,
            F.col("time").alias("valid_time"),
            F.col("hours").alias("lead_hours"),
            *bands,
        )
    )

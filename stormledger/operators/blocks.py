"""Six-hour outage blocks and the county-by-time scaffold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Config
from ..functions.times import BLOCK_HOURS, block_end_6h, in_window, ntz
from ..sources.counties import in_counties, target_counties


def in_scope(readings: DataFrame, cfg: Config) -> DataFrame:
    """Readings of the target counties inside the window."""
    return readings.where(in_counties("county_fips", cfg) & in_window(F.col("ts"), cfg))


def outage_6h_qc(readings: DataFrame, cfg: Config) -> DataFrame:
    """Peak and mean outage per block, and how many readings it rests on (also unusable ones)."""
    return (
        in_scope(readings, cfg)
        .groupBy("county_fips", block_end_6h(F.col("ts")).alias("block_end_ts"))
        .agg(
            F.max("outage_ratio").alias("outage_ratio_6h_max"),
            F.avg("outage_ratio").alias("outage_ratio_6h_mean"),
            F.max("customers_out").alias("customers_out_6h_max"),
            F.count(F.lit(1)).alias("samples_in_block"),
        )
    )


def six_hour_grid(counties: DataFrame, cfg: Config) -> DataFrame:
    """Every county at every block time from start to end, both included."""
    step = F.make_dt_interval(F.lit(0), F.lit(BLOCK_HOURS))
    return target_counties(counties, cfg).select(
        F.col("county_fips_code").alias("county_fips"),
        F.explode(F.sequence(ntz(cfg.start), ntz(cfg.end), step)).alias("valid_ts"),
    )

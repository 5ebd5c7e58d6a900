"""Weather and outages side by side on the scaffold; the base of all later analysis."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Config
from ..functions.flags import as_int, hail_flag
from ..functions.times import in_window

WEATHER = [
    "ws10_max_mps", "ws925_max_mps", "shear_0_6km_max_mps", "updraft700_pos_max_pas",
    "t700_c_min", "t700_c_mean", "t850_c_mean", "tp6_mm_mean", "tp6_mm_max",
]


def outage_vs_weather(grid: DataFrame, features: DataFrame, blocks: DataFrame, cfg: Config) -> DataFrame:
    """Both joins are left joins on the same two keys, so periods lacking weather or readings
    stay, and one partitioning of the scaffold serves both."""
    weather = features.where(in_window(F.col("hour_ts"), cfg)).select(
        "county_fips", F.col("hour_ts").alias("valid_ts"), "lead_hours", *WEATHER
    )
    outages = blocks.withColumnRenamed("block_end_ts", "valid_ts")
    keys = ["county_fips", "valid_ts"]
    return (
        grid.join(weather, keys, "left")
        .join(outages, keys, "left")
        .select(
            *keys,
            "lead_hours",
            *WEATHER,
            as_int(hail_flag(cfg)).alias("hail_flag"),
            "outage_ratio_6h_max",
            "outage_ratio_6h_mean",
            "samples_in_block",
            "customers_out_6h_max",
        )
    )

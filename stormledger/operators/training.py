"""Model inputs from the joined table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import Config
from ..functions.flags import as_int

SPLIT_PARTS = 5


def hash_split(county: Column, ts: Column) -> Column:
    """TEST for about one county-day in five, TRAIN otherwise; all blocks of a day stay together.

    Uses the first 32 bits of an md5 digest, so the choice depends on nothing but county and day.
    """
    digest = F.md5(F.concat(county, F.to_date(ts).cast("string")).cast("binary"))
    bucket = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % SPLIT_PARTS
    return F.when(bucket == 0, "TEST").otherwise("TRAIN")


def label_event(ratio: Column, cfg: Config) -> Column:
    """1 for an outage; a block without a usable ratio counts as none."""
    return as_int(ratio >= F.lit(cfg.outage_threshold))


def training_data(master: DataFrame, cfg: Config) -> DataFrame:
    """Features, both labels and the split for blocks with enough readings and weather."""
    c = F.col
    ws10, shear = c("ws10_max_mps"), c("shear_0_6km_max_mps")
    return master.where(
        (c("samples_in_block") >= cfg.min_samples_per_block) & ws10.isNotNull()
    ).select(
        "county_fips",
        "valid_ts",
        ws10,
        "ws925_max_mps",
        shear,
        "updraft700_pos_max_pas",
        "tp6_mm_max",
        "t700_c_min",
        "t850_c_mean",
        "hail_flag",
        "lead_hours",
        F.hour("valid_ts").cast("bigint").alias("hour_of_day"),
        F.dayofweek("valid_ts").cast("bigint").alias("day_of_week"),
        F.month("valid_ts").cast("bigint").alias("month"),
        (ws10 * c("tp6_mm_max")).alias("wind_precip_interaction"),
        (ws10 * ws10).alias("wind_squared"),
        (shear * c("updraft700_pos_max_pas")).alias("shear_updraft_interaction"),
        "outage_ratio_6h_max",
        label_event(c("outage_ratio_6h_max"), cfg).alias("outage_event"),
        hash_split(c("county_fips"), c("valid_ts")).alias("data_split"),
    )


def split_rows(data: DataFrame, split: str) -> DataFrame:
    return data.where(F.col("data_split") == split)

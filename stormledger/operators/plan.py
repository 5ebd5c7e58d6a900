"""Daily pre-positioning plan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Config
from ..functions.flags import hail_flag, reason_codes, risk_tier, wind_flag
from ..functions.times import in_window
from .coverage import with_thresholds


def _counts(features: DataFrame, thresholds: DataFrame, cfg: Config) -> DataFrame:
    """The counts below, with the county's wind threshold carried along."""
    wanted = features.where(F.col("lead_hours").isin(*cfg.lead_hours) & in_window(F.col("hour_ts"), cfg))
    return (
        with_thresholds(wanted, thresholds)
        .groupBy("county_fips", F.col("hour_ts").alias("valid_ts"))
        .agg(
            F.max("ws10_max_mps").alias("ws10_max_mps_24_48"),
            F.count_if(wind_flag()).alias("wind_flags_leads"),
            F.count_if(hail_flag(cfg)).alias("hail_flags_leads"),
            F.max("p90_ws10").alias("p90_ws10"),
        )
    )


def six_hour_wind_hail_counts(features: DataFrame, thresholds: DataFrame, cfg: Config) -> DataFrame:
    """Strongest wind, and how many leads flag wind and hail, per county and valid time."""
    return _counts(features, thresholds, cfg).drop("p90_ws10")


def daily_plan(features: DataFrame, thresholds: DataFrame, cfg: Config) -> DataFrame:
    """Risk tier and its reasons per county and day.

    The day's strongest wind is rounded before it is compared, which can decide a tier.
    """
    daily = (
        _counts(features, thresholds, cfg)
        .groupBy("county_fips", F.to_date("valid_ts").alias("day_utc"))
        .agg(
            F.round(F.max("ws10_max_mps_24_48"), 2).alias("ws10_daymax"),
            F.sum("wind_flags_leads").alias("wind_consistency"),
            F.sum("hail_flags_leads").alias("hail_consistency"),
            F.max("p90_ws10").alias("p90_ws10"),
        )
    )
    windy = F.col("ws10_daymax") >= F.col("p90_ws10")
    confirmed = windy & (F.col("wind_consistency") >= cfg.wind_consistency_min)
    hail = F.col("hail_consistency") >= cfg.hail_consistency_min
    return daily.select(
        "county_fips",
        "day_utc",
        risk_tier(windy, confirmed, hail).alias("tier"),
        "ws10_daymax",
        "wind_consistency",
        "hail_consistency",
        reason_codes(windy, confirmed, hail).alias("reason_codes"),
    )


def order_plan(plan: DataFrame) -> DataFrame:
    return plan.orderBy("day_utc", "county_fips")

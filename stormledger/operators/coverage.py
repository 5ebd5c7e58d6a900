"""Which events the forecasts warned of, and at which leads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import Config
from ..functions.flags import as_int, hail_flag, wind_flag
from ..functions.times import BLOCK_HOURS, block_end_6h, block_start_6h, in_window, minutes_between

# The leads that get a flag column are fixed; the earliest lead considers every lead present.
FLAG_LEADS = (24, 30, 36, 42, 48)


def with_thresholds(rows: DataFrame, thresholds: DataFrame) -> DataFrame:
    """Attach each county's thresholds. Stored ones have a known size, by which Catalyst broadcasts them."""
    return rows.join(thresholds, "county_fips")


def wx_lead_flags(features: DataFrame, thresholds: DataFrame, cfg: Config) -> DataFrame:
    """Per county and time: a wind and a hail flag for each lead, and the shortest flagged lead."""
    wind, hail = wind_flag(), hail_flag(cfg)

    def at(lead: int, flag: Column) -> Column:
        return F.max(as_int((F.col("lead_hours") == lead) & flag))

    return (
        with_thresholds(features.where(in_window(F.col("hour_ts"), cfg)), thresholds)
        .groupBy("county_fips", F.col("hour_ts").alias("valid_ts"))
        .agg(
            *[at(lead, wind).alias(f"wind{lead}") for lead in FLAG_LEADS],
            *[at(lead, hail).alias(f"hail{lead}") for lead in FLAG_LEADS],
            F.min(F.when(wind | hail, F.col("lead_hours"))).alias("earliest_lead_h"),
        )
    )


def event_coverage(events: DataFrame, flags: DataFrame, cfg: Config) -> DataFrame:
    """Detection flags of each event over the times from its first to its last block end.

    The range condition becomes equality by listing the block ends of a span. Events of a county
    do not overlap, so its spans and their blocks grow with the calendar and not with the number
    of events: flags are settled per span and then looked up by each event. Events are read twice
    and should be a stored table.
    """
    spanned = events.withColumns({
        "first_block": block_end_6h(F.col("start_ts")),
        "last_block": block_end_6h(F.col("end_ts")),
    })
    span = ["county_fips", "first_block", "last_block"]
    step = F.make_dt_interval(F.lit(0), F.lit(BLOCK_HOURS))
    blocks = (
        spanned.select(*span)
        .distinct()
        .select("*", F.explode(F.sequence("first_block", "last_block", step)).alias("block"))
    )
    # A forecast valid between block boundaries is inside a span unless it is past the last one.
    slotted = flags.withColumnsRenamed({"county_fips": "wx_county"}).withColumn(
        "slot", block_start_6h(F.col("valid_ts"))
    )
    inside = (
        (F.col("county_fips") == F.col("wx_county"))
        & (F.col("block") == F.col("slot"))
        & ((F.col("valid_ts") == F.col("slot")) | (F.col("slot") < F.col("last_block")))
    )
    leads = {
        f"dect_{lead}h": F.coalesce(F.greatest(F.max(f"wind{lead}"), F.max(f"hail{lead}")), F.lit(0).cast("bigint"))
        for lead in FLAG_LEADS
    }
    detected = (
        blocks.join(slotted, inside, "left")
        .groupBy(*span)
        .agg(*[e.alias(n) for n, e in leads.items()], F.min("earliest_lead_h").alias("earliest_lead_h"))
    )
    return spanned.join(detected, span).select(
        "county_fips",
        "event_id",
        "start_ts",
        "end_ts",
        minutes_between(F.col("start_ts"), F.col("end_ts")).alias("duration_min"),
        "peak_outage",
        *leads,
        F.greatest(*leads).alias("any_flag_anylead"),
        "earliest_lead_h",
    )

"""Risk flags and tiers. Flags keep SQL's three-valued logic: unknown input gives unknown."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import Config

# Fixed cutoffs of the tiers.
SEVERE_RATIO = 0.15
OUTAGE_RATIO = 0.05
HIGH_PROBABILITY = 0.7
MEDIUM_PROBABILITY = 0.3

# Fixed texts of the reason codes.
REASON_WIND = "wind>=county p90"
REASON_CONFIRMED = "multi-lead-confirmed"
REASON_HAIL = "hail-ingredients"


def as_int(condition: Column) -> Column:
    """1 where true; 0 where false or unknown."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0)).cast("bigint")


def wind_flag() -> Column:
    """Any of the three wind measures reaches its county threshold."""
    return (
        (F.col("ws10_max_mps") >= F.col("p90_ws10"))
        | (F.col("ws925_max_mps") >= F.col("p90_ws925"))
        | (F.col("shear_0_6km_max_mps") >= F.col("p90_shear"))
    )


def hail_flag(cfg: Config) -> Column:
    """Freezing level and moisture together."""
    return (F.col("t700_c_min") <= F.lit(cfg.hail_temp_threshold)) & (
        F.col("tp6_mm_max") >= F.lit(cfg.hail_precip_threshold)
    )


def risk_tier(windy: Column, confirmed: Column, hail: Column) -> Column:
    return F.when(confirmed | hail, "HIGH").when(windy, "MEDIUM").otherwise("LOW")


def reason_codes(windy: Column, confirmed: Column, hail: Column) -> Column:
    return F.concat_ws(
        "; ",
        F.when(windy, REASON_WIND),
        F.when(confirmed, REASON_CONFIRMED),
        F.when(hail, REASON_HAIL),
    )


def severity_tier(c: Column) -> Column:
    return F.when(c >= SEVERE_RATIO, "SEVERE").when(c >= OUTAGE_RATIO, "OUTAGE").otherwise("NORMAL")


def probability_tier(c: Column) -> Column:
    return F.when(c >= HIGH_PROBABILITY, "HIGH").when(c >= MEDIUM_PROBABILITY, "MEDIUM").otherwise("LOW")

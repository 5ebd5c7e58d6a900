"""County-relative thresholds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Config
from ..functions.times import in_window

def county_thresholds(features: DataFrame, cfg: Config) -> DataFrame:
    """High quantiles of wind and updraft over all leads of each county.

    Wind is cut into 11 equal parts and the tenth boundary taken, hence the 10/11 quantile under
    names that say p90. Quantiles are exact: of each county and value only a count is kept, and a county
    has no more rows than the window has hours and leads.
    """

    def quantile(column: str, level: float):
        return F.expr(f"percentile_disc({level!r}D) WITHIN GROUP (ORDER BY {column})")

    return (
        features.where(in_window(F.col("hour_ts"), cfg))
        .groupBy("county_fips")
        .agg(
            quantile("ws10_max_mps", cfg.wind_quantile).alias("p90_ws10"),
            quantile("ws925_max_mps", cfg.wind_quantile).alias("p90_ws925"),
            quantile("shear_0_6km_max_mps", cfg.wind_quantile).alias("p90_shear"),
            quantile("updraft700_pos_max_pas", cfg.updraft_quantile).alias("p80_updraft"),
        )
    )

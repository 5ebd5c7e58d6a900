"""Per-county weather ingredients for each valid time and lead."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Config
from ..functions import weather as W
from ..functions.times import trunc_hour
from ..sources.forecasts import explode_forecast, in_init_times
from ..sources.tables import write_clustered
from ..storage import stored
from .spatial import area_bounds, cell_counties, cells_of, in_bounds, near_pairs


def cell_features(steps: DataFrame, *keep: str) -> DataFrame:
    """Wind speeds, shear, updraft, temperatures and precipitation of each forecast step."""
    c = F.col
    return steps.select(
        *keep,
        trunc_hour(c("valid_time")).alias("hour_ts"),
        "lead_hours",
        W.wind_speed(c("u10"), c("v10")).alias("ws10_mps"),
        W.wind_speed(c("u925"), c("v925")).alias("ws925_mps"),
        W.wind_shear(c("u10"), c("v10"), c("u500"), c("v500")).alias("shear_0_6km_mps"),
        W.updraft_proxy(c("omega700")).alias("updraft700_pos_pas"),
        W.kelvin_to_celsius(c("t700_k")).alias("t700_c"),
        W.kelvin_to_celsius(c("t850_k")).alias("t850_c"),
        W.m_to_mm(c("tp6_m")).alias("tp6_mm"),
    )


def scope_forecasts(forecasts: DataFrame, counties: DataFrame, cfg: Config) -> DataFrame:
    """Cut the scan down by run and bounding box before any array is opened.

    The box is found by one small job over the counties, so that it reaches the Parquet scan as
    plain numbers and skips row groups of far-away cells.
    """
    return forecasts.where(in_init_times(cfg)).where(in_bounds(area_bounds(counties, cfg)))


def cell_map(forecasts: DataFrame, counties: DataFrame, cfg: Config) -> DataFrame:
    """Cells of the area of interest and the counties each counts for."""
    return cell_counties(near_pairs(cells_of(forecasts), counties, cfg))


def stored_cell_map(forecasts: DataFrame, counties: DataFrame, cfg: Config) -> DataFrame:
    """The cell map, computed once and stored, so geometry is settled once per cell.

    Its files tell Catalyst its size: the forecast join broadcasts a small map, and joins a large
    one on `cell_id` by shuffling, where adaptive execution splits a cell that has most rows.
    """
    return stored(cell_map(forecasts, counties, cfg), "cell_map")


def county_weather(scoped: DataFrame, cells: DataFrame, cfg: Config) -> DataFrame:
    """Worst and mean conditions over the cells of each county, per valid hour and lead.

    Wind, shear, updraft and precipitation take the maximum, temperature the minimum. Everything
    aggregates partially before the only large shuffle.
    """
    steps = explode_forecast(scoped.join(cells, "cell_id"), cfg, "counties")
    return (
        cell_features(steps, "counties")
        .select("*", F.inline("counties"))
        .groupBy("county_fips", "county_name", "hour_ts", "lead_hours")
        .agg(
            F.max("ws10_mps").alias("ws10_max_mps"),
            F.max("ws925_mps").alias("ws925_max_mps"),
            F.max("shear_0_6km_mps").alias("shear_0_6km_max_mps"),
            F.max("updraft700_pos_pas").alias("updraft700_pos_max_pas"),
            F.min("t700_c").alias("t700_c_min"),
            F.avg("t700_c").alias("t700_c_mean"),
            F.avg("t850_c").alias("t850_c_mean"),
            F.max("tp6_mm").alias("tp6_mm_max"),
            F.avg("tp6_mm").alias("tp6_mm_mean"),
        )
    )


def weather_features(forecasts: DataFrame, counties: DataFrame, cfg: Config) -> DataFrame:
    """County weather straight from nested forecasts and the county reference."""
    scoped = scope_forecasts(forecasts, counties, cfg)
    return county_weather(scoped, stored_cell_map(scoped, counties, cfg), cfg)


def save_weather_features(features: DataFrame, path: str) -> None:
    by_day = features.withColumn("hour_date", F.to_date("hour_ts"))
    write_clustered(by_day, path, "hour_date", ["county_fips", "lead_hours"])


def read_weather_features(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop("hour_date")

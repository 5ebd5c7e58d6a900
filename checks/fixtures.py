"""The driver's tables as outage readings, counties and forecasts (see FIXTURES.md).

Each mapping is one SELECT that reads the same in Spark and DuckDB but for interval and timestamp
spelling, which `spark_sql` and `duck_sql` fill in. All mappings are row-by-row or tiny joins: they
add no shuffle over the large tables.
"""

from __future__ import annotations

import re
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stormledger.config import Config
from stormledger.schemas import BANDS

CFG = Config(
    county_fips=tuple(f"{1000 + i:05d}" for i in range(20)),
    start_date="2024-01-01",
    end_date="2024-01-31",
    outage_threshold=0.3,
    event_outage_threshold=0.05,
    min_samples_per_block=2,
    hail_consistency_min=3,
    ml_models=("regressor", "logistic"),
    ml_max_iterations=10,
)

# Learners on one 0/1 feature: all rows teach every tree, so that the result is no matter of chance.
FLAG_CFG = replace(CFG, ml_subsample=1.0, ml_min_tree_child_weight=1, ml_max_iterations=50)
STRONG_WIND = 30.0

# Added before rounding to 6 digits: means of few-digit values often lie exactly between two
# roundings, where the summation order would decide.
NUDGE = 3e-8

# Result columns that change type for the comparison only, because the two engines hand whole numbers
# with NULLs, and dates, to pandas in different types.
COMPARED_AS = {
    "outage_vs_weather": {"lead_hours": "double", "samples_in_block": "double", "customers_out_6h_max": "double"},
    "event_marks": {"gap_min": "double", "event_id": "double"},
    "wx_lead_flags": {"earliest_lead_h": "double"},
    "event_coverage": {"earliest_lead_h": "double"},
    "events_view": {"earliest_lead_h": "double"},
    "daily_plan": {"day_utc": "string"},
    "risk_map_view": {"day_utc": "string"},
    "preboard_view": {"day_utc": "string"},
}

COUNTIES = """
select lpad(cast(1000 + n_nationkey as string), 5, '0') as county_fips_code,
       lpad(cast(n_regionkey as string), 2, '0')        as state_fips_code,
       n_name                                           as county_name,
       -100e0 + 2e0 * (n_nationkey % 5)                 as lon0,
       30e0 + 2e0 * floor(n_nationkey / 5e0)            as lat0,
       -98e0 + 2e0 * (n_nationkey % 5)                  as lon1,
       32e0 + 2e0 * floor(n_nationkey / 5e0)            as lat1
from {nation}
"""

STATES = """
select lpad(cast(r_regionkey as string), 2, '0') as state_fips_code, r_name as state_name from {region}
"""

OUTAGE_RAW = """
select 1000 + user_id % 25 as fips_code,
       concat('COUNTY_', cast(user_id % 25 as string)) as county,
       'ST' as state,
       cast(floor(value * 10e0) as bigint) as customers_out,
       ts as run_start_time,
       case when event_id % 97 = 0 then cast(0 as bigint) else cast(5000 as bigint) end as total_customers
from {events}
"""

FORECAST_FLAT = """
select l_suppkey as cell_id,
       -101e0 + (l_suppkey * 7 % 120) / 10e0 as lon,
       29e0 + (l_suppkey * 13 % 120) / 10e0  as lat,
       TS('2023-12-30 00:00:00') + DAYS(l_partkey % 32) as init_time,
       cast(24 + 6 * ((l_linenumber - 1) % 5) as bigint) as hours,
       TS('2023-12-30 00:00:00') + DAYS(l_partkey % 32) + HOURS(24 + 6 * ((l_linenumber - 1) % 5)) as valid_time,
       (l_quantity - 25e0) * (1e0 + (l_partkey % 32 * 5 % 9) / 9e0)   as u10,
       l_discount * 100e0                                             as v10,
       (l_quantity - 25e0) * (1e0 + (l_partkey % 32 * 7 % 13) / 13e0) as u925,
       l_tax * 200e0                                                  as v925,
       l_quantity                                                     as u500,
       l_extendedprice / 5000e0                                       as v500,
       case when l_returnflag = 'R' then null else (l_discount - l_tax) * 10e0 end as omega700,
       268.15e0 + l_quantity / 5e0 + (l_partkey % 32 * 7 % 11) + (l_suppkey * 3 % 5) as t700_k,
       278.15e0 + l_quantity / 5e0 + (l_partkey % 32 * 7 % 11)        as t850_k,
       case when l_linestatus = 'O' and l_linenumber = 1 then null
            else l_discount * l_tax * (l_partkey % 32 % 4) / 4e0 end  as tp6_m
from {lineitem}
"""


# Half diagonal of the tilted cells, in degrees.
TILT = 0.15


def _fill(text: str, days: str, hours: str, ts: str) -> str:
    # Arguments hold at most one level of nested parentheses.
    arg = r"\(((?:[^()]|\((?:[^()]|\([^()]*\))*\))*)\)"
    text = re.sub(r"\bDAYS" + arg, lambda m: days.format(m[1]), text)
    text = re.sub(r"\bHOURS" + arg, lambda m: hours.format(m[1]), text)
    return re.sub(r"\bTS\(('[^']*')\)", lambda m: ts.format(m[1]), text)


def duck_sql(text: str) -> str:
    text = _fill(text, "to_days(cast({} as integer))", "to_hours(cast({} as integer))", "timestamp {}")
    return re.sub(r"\{(\w+)\}", r"\1", text)


def spark_sql(text: str) -> str:
    return _fill(
        text,
        "make_dt_interval(cast({} as int), 0)",
        "make_dt_interval(0, cast({} as int))",
        "timestamp_ntz {}",
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _run(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    names = set(re.findall(r"\{(\w+)\}", text))
    return spark.sql(spark_sql(text), **{n: table(spark, sf_dir, n) for n in names})


def counties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """County outlines are their boxes, as one ring each."""

    def corner(lon: str, lat: str):
        return F.struct(F.col(lon).alias("lon"), F.col(lat).cast("double").alias("lat"))

    ring = F.array(
        corner("lon0", "lat0"), corner("lon1", "lat0"), corner("lon1", "lat1"), corner("lon0", "lat1")
    )
    return _run(spark, sf_dir, COUNTIES).select(
        "county_fips_code", "state_fips_code", "county_name", F.array(ring).alias("county_geom")
    )


def bent_counties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counties as an L each: their box without its upper right quarter."""

    def corner(lon: str, lat: str):
        return f"named_struct('lon', cast({lon} as double), 'lat', cast({lat} as double))"

    x, y = "(lon0 + lon1) / 2", "(lat0 + lat1) / 2"
    ring = ", ".join(
        corner(*p)
        for p in (("lon0", "lat0"), ("lon1", "lat0"), ("lon1", y), (x, y), (x, "lat1"), ("lon0", "lat1"))
    )
    return _run(spark, sf_dir, COUNTIES).select(
        "county_fips_code", "state_fips_code", "county_name", F.expr(f"array(array({ring}))").alias("county_geom")
    )


def tilted_cells(cells: DataFrame) -> DataFrame:
    """Cells as squares that stand on a corner, TILT degrees from their centre."""
    corners = ", ".join(
        f"named_struct('lon', lon + {dx} * {TILT}D, 'lat', lat + {dy} * {TILT}D)" for dx, dy in ((1, 0), (0, 1), (-1, 0), (0, -1))
    )
    return cells.withColumn("cell_geom", F.expr(f"array(array({corners}))"))


def states(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, sf_dir, STATES)


def outage_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, sf_dir, OUTAGE_RAW)


def forecasts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested forecasts: every source row becomes an array of two steps.

    The first comes under a lead that nobody asks for. Several rows then share a cell, run and lead, as
    in the flat form, and no rows are gathered.
    """

    def step(hours):
        bands = [F.col(short).cast("double").alias(name) for short, name in BANDS.items()]
        return F.struct(F.col("valid_time").alias("time"), hours.alias("hours"), *bands)

    return _run(spark, sf_dir, FORECAST_FLAT).select(
        "cell_id",
        "lon",
        "lat",
        "init_time",
        F.array(step(F.col("hours") + 1), step(F.col("hours"))).alias("forecast"),
    )

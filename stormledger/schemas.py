"""Declared schemas. Times are `timestamp_ntz` holding UTC, so no session time zone can move them."""

from __future__ import annotations

from pyspark.sql import types as T

OUTAGE_RAW = (
    "fips_code bigint, county string, state string, customers_out bigint, "
    "run_start_time timestamp_ntz, total_customers bigint"
)

OUTAGE_COLUMNS = [
    "county_fips", "county", "state", "customers_out", "total_customers", "outage_ratio", "ts",
]

RING = "array<struct<lon: double, lat: double>>"
COUNTY_GEOM = f"array<{RING}>"

# Names of the forecast bands that are read, out of the many each step holds. Fixed by the input.
BANDS = {
    "u10": "10m_u_component_of_wind",
    "v10": "10m_v_component_of_wind",
    "u925": "925_u_component_of_wind",
    "v925": "925_v_component_of_wind",
    "u500": "500_u_component_of_wind",
    "v500": "500_v_component_of_wind",
    "omega700": "700_vertical_velocity",
    "t700_k": "700_temperature",
    "t850_k": "850_temperature",
    "tp6_m": "total_precipitation_6hr",
}

# Reading with this schema is what prunes the nested bands at the Parquet scan: exploding an array
# of structs read with the full schema would fetch every band.
FORECAST = (
    "cell_id bigint, lon double, lat double, init_time timestamp_ntz, "
    "forecast array<struct<time: timestamp_ntz, hours: bigint, "
    + ", ".join(f"`{name}`: double" for name in BANDS.values())
    + ">>, init_date date"
)

# The 15 model inputs, in order.
MODEL_FEATURES = [
    "ws10_max_mps", "ws925_max_mps", "shear_0_6km_max_mps", "updraft700_pos_max_pas",
    "tp6_mm_max", "t700_c_min", "t850_c_mean",
    "hail_flag", "lead_hours",
    "hour_of_day", "day_of_week", "month",
    "wind_precip_interaction", "wind_squared", "shear_updraft_interaction",
]

PIPELINE_RUNS = T.StructType([
    T.StructField("run_id", T.StringType(), False),
    T.StructField("phase", T.StringType(), False),
    T.StructField("started_at", T.TimestampNTZType(), False),
    T.StructField("completed_at", T.TimestampNTZType(), False),
    T.StructField("duration_seconds", T.DoubleType()),
    T.StructField("status", T.StringType()),
    T.StructField("steps_completed", T.LongType()),
    T.StructField("steps_failed", T.LongType()),
    T.StructField("config", T.StringType()),
    T.StructField("step_details", T.StringType()),
    T.StructField("git_commit", T.StringType()),
    T.StructField("hostname", T.StringType()),
])

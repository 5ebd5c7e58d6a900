from datetime import datetime, timedelta

from stormledger.config import Config
from stormledger.schemas import BANDS

DAY = datetime(2024, 3, 10)  # a clock change in the test session's zone


def config(**changes) -> Config:
    base = dict(county_fips=("01001", "01003"), start_date="2024-03-10", end_date="2024-03-12")
    return Config(**{**base, **changes})


def at(text: str) -> datetime:
    return datetime.fromisoformat(text)


def minutes(n: float) -> datetime:
    return DAY + timedelta(minutes=n)


def rows(df) -> list[tuple]:
    return [tuple(r) for r in df.collect()]


READINGS = "county_fips string, ts timestamp_ntz, outage_ratio double, customers_out bigint"


def readings(spark, data):
    """data: (county, ts, ratio) triples."""
    return spark.createDataFrame([(c, t, r, None) for c, t, r in data], READINGS)


FEATURES = (
    "county_fips string, county_name string, hour_ts timestamp_ntz, lead_hours bigint, ws10_max_mps double, "
    "ws925_max_mps double, shear_0_6km_max_mps double, updraft700_pos_max_pas double, t700_c_min double, "
    "t700_c_mean double, t850_c_mean double, tp6_mm_max double, tp6_mm_mean double"
)


def feature(county, ts, lead, ws10=1.0, ws925=1.0, shear=1.0, updraft=0.0, t700=5.0, tp=0.0):
    return (county, county, ts, lead, ws10, ws925, shear, updraft, t700, t700, t700, tp, tp)


def features(spark, data):
    return spark.createDataFrame(data, FEATURES)


THRESHOLDS = "county_fips string, p90_ws10 double, p90_ws925 double, p90_shear double, p80_updraft double"


def thresholds(spark, *data):
    return spark.createDataFrame(list(data) or [("01001", 10.0, 100.0, 100.0, 1.0)], THRESHOLDS)


STEP = "struct<time: timestamp_ntz, hours: bigint, " + ", ".join(f"`{b}`: double" for b in BANDS.values()) + ">"
FORECASTS = f"cell_id bigint, lon double, lat double, init_time timestamp_ntz, forecast array<{STEP}>"


def step(init, hours, **bands):
    values = {"u10": 3.0, "v10": 4.0, "u925": 6.0, "v925": 8.0, "u500": 3.0, "v500": 16.0, "omega700": -2.0,
              "t700_k": 273.15, "t850_k": 283.15, "tp6_m": 0.003, **bands}
    return (init + timedelta(hours=hours), hours, *[values[b] for b in BANDS])


COUNTIES = (
    "county_fips_code string, state_fips_code string, state_name string, county_name string, "
    "county_geom array<array<struct<lon: double, lat: double>>>"
)


def county(code, *rings):
    # Outlines are given open; rings close themselves.
    return (code, code[:2], "State", f"County {code}", [[(float(x), float(y)) for x, y in ring] for ring in rings])


def box(x0, y0, x1, y1):
    return [(x0, y0), (x1, y0), (x1, y1), (x0, y1)]

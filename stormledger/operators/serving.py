"""Result views for dashboards. County names join from the reference by its own size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scores import safe_ratio

# Fixed bounds of the correlation bands.
MEASURES = ("r_ws10", "r_ws925", "r_shear", "r_updraft", "r_precip", "r_t700")
BANDS = ((0.5, "strong"), (0.3, "moderate"), (0.1, "weak"))


def _named(rows: DataFrame, counties: DataFrame, *names: str) -> DataFrame:
    lookup = counties.select(F.col("county_fips_code").alias("county_fips"), *names)
    return rows.join(lookup, "county_fips")


def timeseries_view(master: DataFrame, counties: DataFrame) -> DataFrame:
    return _named(master.where(F.col("lead_hours").isNotNull()), counties, "county_name", "state_name").select(
        "county_fips", "county_name", "state_name", "valid_ts", "lead_hours", "outage_ratio_6h_max",
        "ws10_max_mps", "ws925_max_mps", "shear_0_6km_max_mps", "tp6_mm_max", "hail_flag",
    )


def correlation_view(correlations: DataFrame, counties: DataFrame) -> DataFrame:
    return _named(correlations, counties, "county_name").select(
        "county_fips", "county_name", "lead_hours", "n_scored",
        "r_ws10", "r_ws925", "r_shear", "r_updraft", "r_precip", "r_t700",
    )


_PLAN = ["day_utc", "tier", "ws10_daymax", "wind_consistency", "hail_consistency", "reason_codes"]


def risk_map_view(plan: DataFrame, counties: DataFrame) -> DataFrame:
    return _named(plan, counties, "county_name", "state_name", "county_geom").select(
        "county_fips", "county_name", "state_name", F.col("county_geom").alias("geom"), *_PLAN
    )


def preboard_view(plan: DataFrame, counties: DataFrame) -> DataFrame:
    rank = F.when(F.col("tier") == "HIGH", 1).when(F.col("tier") == "MEDIUM", 2).otherwise(3)
    return (
        _named(plan, counties, "county_name", "state_name")
        .select("county_fips", "county_name", "state_name", *_PLAN)
        .orderBy(rank, "day_utc", "county_fips")
    )


def events_view(coverage: DataFrame, counties: DataFrame) -> DataFrame:
    return _named(coverage, counties, "county_name", "state_name").select(
        "county_fips", "county_name", "state_name",
        *[c for c in coverage.columns if c != "county_fips"],
    )


def latest_events(events: DataFrame) -> DataFrame:
    return events.orderBy(F.desc("start_ts"), "county_fips")


def kpi_overview(preboard: DataFrame, events: DataFrame) -> DataFrame:
    """One row of headline numbers. Both views feed one aggregate, so nothing is joined."""
    plan = preboard.select("county_fips", "tier")
    found = events.select("event_id", "any_flag_anylead", "earliest_lead_h")
    return (
        plan.unionByName(found, allowMissingColumns=True)
        .agg(
            F.countDistinct("county_fips").alias("counties_monitored"),
            F.count_if(F.col("tier") == "HIGH").alias("high_risk_county_days"),
            F.count_if(F.col("any_flag_anylead") == 1).alias("events_detected"),
            F.count("event_id").alias("total_events"),
            # The exact median counts distinct values, and leads have only a handful.
            F.median("earliest_lead_h").alias("median_earliest_lead_h"),
        )
        .withColumn("detection_rate", safe_ratio(F.col("events_detected"), F.col("total_events")))
    )


def correlation_band(r: Column) -> Column:
    band = F.when(r.isNull(), F.lit(None).cast("string"))
    for bound, name in BANDS:
        band = band.when(r >= bound, name)
    return band.otherwise("none")


def correlation_heatmap(view: DataFrame, leads: tuple[int, ...], measures: tuple[str, ...] = MEASURES) -> DataFrame:
    """Each correlation as counties by leads, a row per county and measure, with a band for every cell."""
    long = view.unpivot(["county_fips", "county_name", "lead_hours"], list(measures), "measure", "r")
    grid = long.groupBy("county_fips", "county_name", "measure").pivot("lead_hours", list(leads)).agg(F.first("r"))
    cells = [c for lead in leads for c in (
        F.col(str(lead)).alias(f"r_{lead}h"),
        correlation_band(F.col(str(lead))).alias(f"band_{lead}h"),
    )]
    return grid.select("county_fips", "county_name", "measure", *cells)

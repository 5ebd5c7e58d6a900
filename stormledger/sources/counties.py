"""County reference."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import Config
from ..functions.geometry import from_wkt


def counties_ref(counties: DataFrame, states: DataFrame) -> DataFrame:
    """Counties with the name of their state, where it is known.

    `states` has one row per state and comes from a file, so Catalyst broadcasts it by its size.
    """
    return counties.join(states, "state_fips_code", "left").select(
        "county_fips_code", "state_fips_code", "state_name", "county_name", "county_geom"
    )


def outlines_from_wkt(counties: DataFrame, column: str = "county_geom") -> DataFrame:
    """Counties whose outlines come as well-known text, with ring arrays in place of the text."""
    return counties.withColumn("county_geom", from_wkt(column))


def in_counties(column: str, cfg: Config) -> Column:
    """Membership in the configured counties. As text: thousands of codes parse at once."""
    codes = ", ".join("'" + code.replace("'", "\\'") + "'" for code in cfg.county_fips)
    return F.expr(f"{column} in ({codes})")


def target_counties(counties: DataFrame, cfg: Config) -> DataFrame:
    return counties.where(in_counties("county_fips_code", cfg))

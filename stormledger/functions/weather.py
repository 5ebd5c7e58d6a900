"""Weather ingredients and unit conversions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed conversion constants.
KELVIN_ZERO = 273.15
MM_PER_M = 1000.0
MPH_PER_MPS = 2.237
KNOTS_PER_MPS = 1.944


def wind_speed(u: Column, v: Column) -> Column:
    return F.sqrt(u * u + v * v)


def wind_shear(u_low: Column, v_low: Column, u_high: Column, v_high: Column) -> Column:
    """Length of the vector difference between two levels."""
    return wind_speed(u_high - u_low, v_high - v_low)


def updraft_proxy(omega: Column) -> Column:
    """Upward motion only. Unknown stays unknown, although Spark's greatest() would skip it."""
    return F.when(omega.isNotNull(), F.greatest(F.lit(0.0), -omega))


def kelvin_to_celsius(c: Column) -> Column:
    return c - KELVIN_ZERO


def m_to_mm(c: Column) -> Column:
    """Depth in millimetres; a missing accumulation counts as none."""
    return F.coalesce(c, F.lit(0.0)) * MM_PER_M


def mps_to_mph(c: Column) -> Column:
    return c * MPH_PER_MPS


def mps_to_knots(c: Column) -> Column:
    return c * KNOTS_PER_MPS


def ratio_to_pct(c: Column) -> Column:
    return c * 100.0

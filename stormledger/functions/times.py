"""Time expressions over `timestamp_ntz`, none of which consults the session time zone."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import Config

BLOCK_HOURS = 6


def ntz(value: datetime) -> Column:
    return F.lit(value.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")


def to_ts(c: Column) -> Column:
    return c.cast("timestamp_ntz")


def midnight(c: Column) -> Column:
    return F.to_date(c).cast("timestamp_ntz")


def _hours(c: Column) -> Column:
    return F.make_dt_interval(F.lit(0), c.cast("int"))


def trunc_hour(c: Column) -> Column:
    return midnight(c) + _hours(F.hour(c))


def block_start_6h(c: Column) -> Column:
    return midnight(c) + _hours(F.floor(F.hour(c) / BLOCK_HOURS) * BLOCK_HOURS)


def block_end_6h(c: Column) -> Column:
    """End of the 6-hour block a reading falls in; 06:00 sharp belongs to the block ending 12:00."""
    return midnight(c) + _hours(F.floor(F.hour(c) / BLOCK_HOURS) * BLOCK_HOURS + BLOCK_HOURS)


def chunk_start(c: Column, minutes: int) -> Column:
    """Start of the fixed-length piece of a day that a time falls in."""
    of_day = F.hour(c) * 60 + F.minute(c)
    return midnight(c) + F.make_dt_interval(F.lit(0), F.lit(0), (of_day - of_day % minutes).cast("int"))


def minutes_between(start: Column, end: Column) -> Column:
    """Whole elapsed minutes, truncated. Subtracting keeps it exact across a clock change."""
    gap = end - start
    day, hour, minute = (F.extract(F.lit(part), gap).cast("bigint") for part in ("DAY", "HOUR", "MINUTE"))
    return day * 1440 + hour * 60 + minute


def in_window(c: Column, cfg: Config) -> Column:
    return (c >= ntz(cfg.start)) & (c < ntz(cfg.end))


def date_in_window(c: Column, cfg: Config) -> Column:
    """The same window on a partition date; wider by the final day, which `in_window` trims."""
    return c.between(F.lit(cfg.start.date()), F.lit(cfg.end.date()))

"""Outage events: runs of readings at or above a threshold, tolerant of missing readings.

An event starts at a reading that is on while the one before it is off, unknown or absent, or is
on but more than the allowed minutes earlier. Any reading below the threshold ends the event.

A county may hold a large share of all readings, so its history is never ordered in one task:

1. readings at the same instant fold to one row (off sorts before on, so the fold loses nothing);
2. ordering happens inside short pieces of a county's history;
3. one summary row per piece passes the last reading and the running event count to the next.

Only the summaries are ordered per county. A piece is some hours long, so a
county has a fixed number of them per day whatever its number of readings.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import Config
from ..functions.flags import as_int
from ..functions.times import chunk_start, minutes_between
from .blocks import in_scope


def outage_on(cfg: Config) -> Column:
    return F.col("outage_ratio") >= F.lit(cfg.event_outage_threshold)


def _instants(readings: DataFrame, cfg: Config) -> DataFrame:
    on = outage_on(cfg)
    piece = chunk_start(F.col("ts"), 60 * cfg.event_piece_hours)
    return (
        in_scope(readings, cfg)
        .select("county_fips", piece.alias("piece"), "ts", "outage_ratio")
        # Always true. The join below implies it for one side; stated here, both sides plan alike
        # and share their shuffle.
        .where(F.col("piece").isNotNull())
        # The only shuffle of readings: instants, windows and the join all keep to it.
        .repartition("county_fips", "piece")
        .groupBy("county_fips", "piece", "ts")
        .agg(
            F.count(F.lit(1)).alias("readings"),
            F.max("outage_ratio").alias("outage_ratio"),
            # Whether the first reading of this instant is on, and whether the last is.
            (F.count_if(on) == F.count(F.lit(1))).alias("opens_on"),
            (F.count_if(on) > 0).alias("closes_on"),
        )
    )


def _starts(row_on: str, opens_on: str, before_on: str, before_ts: str, ts: str, cfg: Config) -> Column:
    """Whether an event starts at an instant, given the last reading before it."""
    gap = minutes_between(F.col(before_ts), F.col(ts))
    follows = F.col(opens_on) & F.coalesce(F.col(before_on), F.lit(False)) & (gap <= cfg.event_gap_minutes)
    return F.col(row_on) & ~follows


def _numbered(readings: DataFrame, cfg: Config, only_on: bool) -> DataFrame:
    """Instants with what the piece before hands on, and their event number.

    With `only_on`, instants below the threshold and the hand-over of pieces that never reach it
    are left out after numbering. Using the peak there also gives both sides of the join the same
    columns, so that they share one shuffle of the instants.
    """
    piece = ["county_fips", "piece"]
    inside = Window.partitionBy(*piece).orderBy("ts")
    # Inside a piece; the first instant of each still lacks its predecessor.
    local = (
        _instants(readings, cfg)
        .withColumns({
            "nth": F.row_number().over(inside),
            "before_ts": F.lag("ts").over(inside),
            "before_on": F.lag("closes_on").over(inside),
        })
        .withColumn("later_start", (F.col("nth") > 1) & _starts("closes_on", "opens_on", "before_on", "before_ts", "ts", cfg))
        .withColumn(
            "later_starts",
            F.sum(F.col("later_start").cast("bigint")).over(
                inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
            ),
        )
    )
    across = Window.partitionBy("county_fips").orderBy("piece")
    carried = (
        local.groupBy(*piece)
        .agg(
            F.min_by("opens_on", "ts").alias("first_opens_on"),
            F.min_by("closes_on", "ts").alias("first_on"),
            F.min("ts").alias("first_ts"),
            F.max("ts").alias("last_ts"),
            F.max_by("closes_on", "ts").alias("last_on"),
            F.max("later_starts").alias("later_starts"),
            F.max("outage_ratio").alias("peak"),
        )
        .withColumns({
            "carry_ts": F.lag("last_ts").over(across),
            "carry_on": F.lag("last_on").over(across),
        })
        .withColumn("first_start", _starts("first_on", "first_opens_on", "carry_on", "carry_ts", "first_ts", cfg))
        .withColumn("started", F.col("later_starts") + F.col("first_start").cast("bigint"))
        .withColumn("upto", F.sum("started").over(across.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        .select(
            *piece,
            "carry_ts",
            "carry_on",
            "first_start",
            "peak",
            # Events begun before this piece, and the one its first instant begins.
            (F.col("upto") - F.col("later_starts")).alias("base"),
        )
    )
    if only_on:
        carried = carried.where(F.col("peak") >= F.lit(cfg.event_outage_threshold))
        local = local.where("closes_on")
    number = F.when(F.col("closes_on"), F.col("base") + F.col("later_starts"))
    return local.join(carried.drop("peak"), piece).withColumn("event_id", number)


def event_marks(readings: DataFrame, cfg: Config) -> DataFrame:
    """Every instant with its gap, previous state, start mark and event number (on rows only)."""
    first = F.col("nth") == 1
    starts = F.when(first, F.col("first_start")).otherwise(F.col("later_start"))
    return (
        _numbered(readings, cfg, only_on=False)
        .withColumn("prev_ts", F.when(first, F.col("carry_ts")).otherwise(F.col("before_ts")))
        .select(
            "county_fips",
            "ts",
            "readings",
            "outage_ratio",
            F.col("closes_on").alias("outage_on"),
            F.when(first, F.col("carry_on")).otherwise(F.col("before_on")).alias("prev_outage_on"),
            minutes_between(F.col("prev_ts"), F.col("ts")).alias("gap_min"),
            as_int(starts).alias("is_start"),
            "event_id",
        )
    )


def outage_events(readings: DataFrame, cfg: Config) -> DataFrame:
    """One row per event, numbered from 1 in each county."""
    return (
        _numbered(readings, cfg, only_on=True)
        .groupBy("county_fips", "event_id")
        .agg(
            F.min("ts").alias("start_ts"),
            F.max("ts").alias("end_ts"),
            F.max("outage_ratio").alias("peak_outage"),
        )
        .select(
            "county_fips",
            "event_id",
            "start_ts",
            "end_ts",
            minutes_between(F.col("start_ts"), F.col("end_ts")).alias("duration_min"),
            "peak_outage",
        )
    )

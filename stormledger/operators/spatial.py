"""Which grid cells count for which county.

A cell is used if its centre lies in the area of interest (within the buffer of any target
county), and then counts for every county whose buffer its box meets. Candidates come from an
equi-join on square tiles; each cell sits in exactly one tile, so no pair appears twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import Config
from ..functions import geometry as G
from ..sources.counties import target_counties
from .outlines import outline_pairs


def cells_of(forecasts: DataFrame) -> DataFrame:
    """The distinct grid cells, with their outlines where forecasts carry `cell_geom`. Reads narrow columns
    and combines before shuffling."""
    outline = [c for c in ("cell_geom",) if c in forecasts.columns]
    return forecasts.select("cell_id", "lon", "lat", *outline).distinct()


def county_regions(counties: DataFrame, cfg: Config) -> DataFrame:
    """Target counties with their outline's sides and bounding box."""
    return (
        target_counties(counties, cfg)
        .select(
            F.col("county_fips_code").alias("county_fips"), "county_name", "county_geom",
            G.edges("county_geom").alias("side"),
        )
        .withColumns(G.bounds())
        .withColumn("boxed", G.is_box("county_geom"))
        .drop("county_geom")
    )


def _reach(cfg: Config) -> tuple[Column, Column]:
    """Degrees of longitude and latitude that a box must grow by to surely cover the buffer."""
    grow_lat = cfg.cell_half_deg + cfg.spatial_buffer_m / G.METRES_PER_DEGREE + G.SLACK
    grow_lon = f"""
        {G.number(cfg.cell_half_deg + G.SLACK)} + {G.number(cfg.spatial_buffer_m / G.METRES_PER_DEGREE)}
        / cos(radians(least(89D, greatest(abs(ymin - {grow_lat!r}D), abs(ymax + {grow_lat!r}D)))))"""
    return F.expr(grow_lon), F.lit(grow_lat)


def _tile(c: Column, cfg: Config) -> Column:
    return F.floor(c / cfg.tile_deg)


def area_bounds(counties: DataFrame, cfg: Config) -> tuple[float, float, float, float] | None:
    """Smallest box holding every cell that can matter, as four numbers for the scan to push down.

    One small job over the county reference; None if no target county is known.
    """
    grow_lon, grow_lat = _reach(cfg)
    box = (
        county_regions(counties, cfg)
        .agg(
            F.min(F.col("xmin") - grow_lon),
            F.min(F.col("ymin") - grow_lat),
            F.max(F.col("xmax") + grow_lon),
            F.max(F.col("ymax") + grow_lat),
        )
        .first()
    )
    return None if box is None or box[0] is None else tuple(box)


def in_bounds(box: tuple[float, float, float, float] | None) -> Column:
    if box is None:
        return F.lit(False)
    return F.col("lon").between(box[0], box[2]) & F.col("lat").between(box[1], box[3])


def near_pairs(cells: DataFrame, counties: DataFrame, cfg: Config) -> DataFrame:
    """(cell, county) pairs whose box lies within the buffer; `centre_near` tells whether the
    centre does too. Cells with outlines of their own are taken by these, others as squares."""
    if "cell_geom" in cells.columns:
        return outline_pairs(cells, counties, cfg)
    regions = county_regions(counties, cfg)
    grow_lon, grow_lat = _reach(cfg)
    tiles = regions.select(
        "county_fips", "county_name", "xmin", "ymin", "xmax", "ymax", "boxed",
        F.explode(
            F.sequence(_tile(F.col("xmin") - grow_lon, cfg), _tile(F.col("xmax") + grow_lon, cfg))
        ).alias("tx"),
        _tile(F.col("ymin") - grow_lat, cfg).alias("ty0"),
        _tile(F.col("ymax") + grow_lat, cfg).alias("ty1"),
    ).select("*", F.explode(F.sequence("ty0", "ty1")).alias("ty"))

    r, half = cfg.spatial_buffer_m, cfg.cell_half_deg
    candidates = (
        cells.withColumns({"tx": _tile(F.col("lon"), cfg), "ty": _tile(F.col("lat"), cfg)})
        .join(tiles, ["tx", "ty"])
        .where(G.box_within(half, r))
        .drop("tx", "ty", "ty0", "ty1")
        # Few bytes but much arithmetic per row: spread over the session's shuffle partitions. A stated
        # number keeps adaptive execution from merging them by size. Grouping by cell later needs no
        # further shuffle.
        .repartition(int(cells.sparkSession.conf.get("spark.sql.shuffle.partitions")), "cell_id")
    )
    # The outline's sides are fetched per candidate, not carried on every tile.
    sides = regions.select("county_fips", F.when(~F.col("boxed"), F.col("side")).alias("side"))

    def exact(width: float) -> Column:
        return G.box_within(width, r) & (F.col("boxed") | G.outline_within(width, r))

    return (
        candidates.join(sides, "county_fips")
        .where(exact(half))
        .select("cell_id", "lon", "lat", "county_fips", "county_name", exact(0.0).alias("centre_near"))
    )


def aoi_filter(cells: DataFrame, pairs: DataFrame) -> DataFrame:
    """Cells whose centre is within the buffer of any target county."""
    return cells.join(pairs.where("centre_near").select("cell_id"), "cell_id", "left_semi")


def cell_counties(pairs: DataFrame) -> DataFrame:
    """One row per cell in the area of interest, with the counties it counts for.

    The list is as long as the number of target counties within reach of one cell.
    """
    return (
        pairs.groupBy("cell_id")
        .agg(
            F.bool_or("centre_near").alias("in_aoi"),
            F.collect_set(F.struct("county_fips", "county_name")).alias("counties"),
        )
        .where("in_aoi")
        .select("cell_id", "counties")
    )

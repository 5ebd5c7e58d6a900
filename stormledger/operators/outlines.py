"""Which cells, given by their own outlines, come near which counties.

The distance is that between two outlines of any form. Candidates come from tiles of several sizes: a shape
is filed under tiles about as large as itself, and under larger ones as far as the other side has any, so
a small shape never lists the many small tiles of a large one. Two shapes meet at the larger of their two
sizes, in the one tile that holds the lower left corner of what their boxes share.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import Config
from ..functions import geometry as G
from ..sources.counties import target_counties
from ..storage import stored

BOX = ("xmin", "ymin", "xmax", "ymax")


def cell_shapes(cells: DataFrame, radius: float) -> DataFrame:
    """(cell_id, lon, lat, cell_side, box, level size): sides of each cell and its box, grown by the radius.

    A cell without an outline is its centre. The centre is always within the box.
    """
    point = F.array(F.array(F.struct(F.col("lon").cast("double").alias("lon"), F.col("lat").cast("double").alias("lat"))))
    geom = F.when(F.size(F.flatten("cell_geom")) > 0, F.col("cell_geom")).otherwise(point)
    sides = cells.select("cell_id", "lon", "lat", geom.alias("cell_geom"))
    sides = sides.select("cell_id", "lon", "lat", G.edges("cell_geom").alias("side")).withColumns(G.bounds())
    grow_x = F.least(F.lit(360.0), F.expr(f"{G.number(radius)} / {G.LON_SCALE}")) + G.SLACK
    grow_y = F.lit(radius / G.METRES_PER_DEGREE + G.SLACK)
    return sides.select(
        "cell_id", "lon", "lat", F.col("side").alias("cell_side"),
        (F.least("xmin", "lon") - grow_x).alias("xmin"), (F.least("ymin", "lat") - grow_y).alias("ymin"),
        (F.greatest("xmax", "lon") + grow_x).alias("xmax"), (F.greatest("ymax", "lat") + grow_y).alias("ymax"),
    )


def _levelled(shapes: DataFrame, cfg: Config) -> DataFrame:
    """With the level of tiles that are as large as the shape or larger, by powers of two."""
    extent = F.greatest(F.col("xmax") - F.col("xmin"), F.col("ymax") - F.col("ymin"), F.lit(cfg.tile_deg))
    return shapes.withColumn("level", F.ceil(F.log2(extent / cfg.tile_deg)).cast("int"))


def _filed(shapes: DataFrame, top: int, cfg: Config) -> DataFrame:
    """A row for each tile that a shape's box meets, on its own level and those above up to `top`."""
    levels = F.sequence("level", F.greatest("level", F.lit(top)))
    size = F.lit(cfg.tile_deg) * F.pow(F.lit(2.0), "tile_level")
    on = shapes.withColumn("tile_level", F.explode(levels)).withColumn("tile_size", size)
    on = on.withColumn("tx", F.explode(F.sequence(F.floor(F.col("xmin") / F.col("tile_size")), F.floor(F.col("xmax") / F.col("tile_size")))))
    return on.withColumn("ty", F.explode(F.sequence(F.floor(F.col("ymin") / F.col("tile_size")), F.floor(F.col("ymax") / F.col("tile_size")))))


def _top(shapes: DataFrame) -> int:
    return shapes.agg(F.max("level")).first()[0] or 0


def candidates(cells: DataFrame, regions: DataFrame, cfg: Config) -> DataFrame:
    """(cell_id, county_fips) whose boxes meet, each pair once. Both tables have a box and a level."""
    tile = ["tile_level", "tx", "ty"]
    left = _filed(cells.select("cell_id", "level", *BOX), _top(regions), cfg)
    right = _filed(regions.select("county_fips", "level", *BOX), _top(cells), cfg).drop("tile_size")
    right = right.withColumnsRenamed({c: f"county_{c}" for c in (*BOX, "level")})
    meeting = F.col("tile_level") == F.greatest("level", "county_level")
    overlap = (
        (F.greatest("xmin", "county_xmin") <= F.least("xmax", "county_xmax"))
        & (F.greatest("ymin", "county_ymin") <= F.least("ymax", "county_ymax"))
    )
    once = (F.floor(F.greatest("xmin", "county_xmin") / F.col("tile_size")) == F.col("tx")) & (
        F.floor(F.greatest("ymin", "county_ymin") / F.col("tile_size")) == F.col("ty")
    )
    return left.join(right, tile).where(meeting & overlap & once).select("cell_id", "county_fips")


def shapes_within(radius: float) -> Column:
    """Whether the outlines `cell_side` and `side` come within `radius` metres of each other, at the scale of `lat`.

    Either two sides cross or come that close, of which one end is then the nearest point, or one outline
    holds a corner of the other. Only sides in reach of the cell's grown box are looked at.
    """

    def metres(sides: str) -> str:
        return f"""transform({sides}, e -> named_struct(
            'ax', (e.x0 - lon) * {G.LON_SCALE}, 'ay', (e.y0 - lat) * {G.LAT_SCALE},
            'dx', (e.x1 - e.x0) * {G.LON_SCALE}, 'dy', (e.y1 - e.y0) * {G.LAT_SCALE}))"""

    def holds(sides: str, x: str, y: str) -> str:
        return f"""size(filter({sides}, h -> (h.y0 > {y}) <> (h.y1 > {y})
            and {x} < h.x0 + try_divide((h.x1 - h.x0) * ({y} - h.y0), h.y1 - h.y0))) % 2 = 1"""

    # Where the end of one side lies as seen from the start of the other, and the other's direction.
    ends = [
        f"named_struct('gx', {p}.ax + {t} * {p}.dx - {q}.ax, 'gy', {p}.ay + {t} * {p}.dy - {q}.ay, 'dx', {q}.dx, 'dy', {q}.dy)"
        for p, q in (("c", "s"), ("s", "c"))
        for t in ("0D", "1D")
    ]
    place = "greatest(0D, least(1D, coalesce(try_divide(v.gx * v.dx + v.gy * v.dy, v.dx * v.dx + v.dy * v.dy), 0D)))"
    close = f"""exists(array({", ".join(ends)}), v -> exists(array({place}),
        t -> power(v.gx - t * v.dx, 2) + power(v.gy - t * v.dy, 2) <= {G.number(radius * radius)}))"""

    def turns(p: str, q: str) -> str:
        """Whether the ends of q lie on both sides of the line through p."""
        start = f"({p}.dx * ({q}.ay - {p}.ay) - {p}.dy * ({q}.ax - {p}.ax))"
        end = f"({p}.dx * ({q}.ay + {q}.dy - {p}.ay) - {p}.dy * ({q}.ax + {q}.dx - {p}.ax))"
        return f"{start} * {end} < 0D"

    near = "filter(side, e -> least(e.x0, e.x1) <= xmax and greatest(e.x0, e.x1) >= xmin and least(e.y0, e.y1) <= ymax and greatest(e.y0, e.y1) >= ymin)"
    touch = f"""exists({metres("cell_side")}, c -> exists({metres(near)}, s -> {close} or ({turns("c", "s")} and {turns("s", "c")})))"""
    within = f"exists(cell_side, c -> {holds('side', 'c.x0', 'c.y0')}) or exists({near}, e -> {holds('cell_side', 'e.x0', 'e.y0')})"
    return F.expr(f"({touch}) or ({within})")


def outline_pairs(cells: DataFrame, counties: DataFrame, cfg: Config) -> DataFrame:
    """(cell, county) pairs whose outlines lie within the buffer of each other; `centre_near` tells whether the
    cell's centre lies within the county's buffer.

    `cells` has `cell_id`, unique, `lon`, `lat` (centre) and `cell_geom`, rings as in `county_geom`. Outlines may be
    of any form and size; holes count by the even-odd rule. A null or empty cell outline is the centre alone; a
    county without one is near nothing.
    """
    radius = cfg.spatial_buffer_m
    shapes = stored(_levelled(cell_shapes(cells, radius), cfg), "cell_shapes")
    regions = target_counties(counties, cfg).where(F.size(F.flatten("county_geom")) > 0)
    regions = regions.select(F.col("county_fips_code").alias("county_fips"), "county_name", G.edges("county_geom").alias("side"))
    regions = stored(_levelled(regions.withColumns(G.bounds()), cfg), "county_shapes")
    # Few bytes but much arithmetic per row: spread over the session's shuffle partitions.
    parts = int(cells.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    met = candidates(shapes, regions, cfg).repartition(parts, "cell_id")
    both = met.join(shapes.drop("level"), "cell_id").join(regions.select("county_fips", "county_name", "side"), "county_fips")
    return both.where(shapes_within(radius)).select(
        "cell_id", "lon", "lat", "county_fips", "county_name", G.outline_within(0.0, radius).alias("centre_near")
    )

"""Planar distance tests between a grid cell and a county outline.

Degrees are scaled to metres at the cell's latitude. "Meets the outline grown by r" is tested as
"within r of the outline", so no grown outline is ever built.

The tests are SQL text over the columns `lon, lat` (cell centre), `xmin, ymin, xmax, ymax` (county
box) and `side` (county outline): nested lambdas are far quicker to parse than to build call by
call.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

METRES_PER_DEGREE = 111320.0
# Degrees by which coarse tests reach further, so that rounding never drops what the exact test keeps.
SLACK = 1e-9


def number(value: float) -> str:
    """A double literal; plain decimals would be exact decimals in SQL."""
    return f"{float(value)!r}D"


LON_SCALE = f"({number(METRES_PER_DEGREE)} * cos(radians(lat)))"
LAT_SCALE = number(METRES_PER_DEGREE)


def edges(geom: str) -> Column:
    """All sides of all rings of an outline, closing each ring."""
    return F.expr(f"""
        flatten(transform({geom}, ring -> zip_with(
            ring,
            concat(slice(ring, 2, size(ring)), slice(ring, 1, 1)),
            (a, b) -> named_struct('x0', a.lon, 'y0', a.lat, 'x1', b.lon, 'y1', b.lat))))""")


def bounds() -> dict[str, Column]:
    """Bounding box of the sides."""
    return {
        name: F.expr(f"array_{pick}(transform(side, e -> e.{axis}0))")
        for name, pick, axis in (("xmin", "min", "x"), ("ymin", "min", "y"), ("xmax", "max", "x"), ("ymax", "max", "y"))
    }


def is_box(geom: str) -> Column:
    """Whether an outline is exactly its bounding box, for which the box test alone is exact."""
    return F.expr(f"""
        size({geom}) = 1
        and size(array_distinct(transform(side, e -> named_struct('x', e.x0, 'y', e.y0)))) = 4
        and forall(side, e -> e.x0 in (xmin, xmax) and e.y0 in (ymin, ymax) and (e.x0 = e.x1 or e.y0 = e.y1))""")


def box_within(half: float, radius: float) -> Column:
    """Whether a cell of the given half-width lies within `radius` metres of the county box."""
    h = number(half)
    gap_x = f"greatest(0D, lon - {h} - xmax, xmin - lon - {h}) * {LON_SCALE}"
    gap_y = f"greatest(0D, lat - {h} - ymax, ymin - lat - {h}) * {LAT_SCALE}"
    return F.expr(f"power({gap_x}, 2) + power({gap_y}, 2) <= {number(radius * radius)}")


def outline_within(half: float, radius: float) -> Column:
    """Whether a cell lies within `radius` metres of the county outline.

    Either a side comes that close, or the cell is wholly inside, and then so is its centre.

    A side is the point (ax, ay) + t (dx, dy), t from 0 to 1, seen from the cell centre, with the
    cell reaching hx and hy around it. Its squared distance to the cell is convex and piecewise
    quadratic in t, so the minimum is at an end, where the side crosses a line through a cell
    edge, or nearest to a cell corner: ten places, all of which are tried. Sides whose own box is
    out of reach, which are nearly all, are dropped first.
    """
    crossings = [f"try_divide({s} s.h{a} - s.a{a}, s.d{a})" for a in "xy" for s in "+-"]
    corners = [
        f"try_divide(({p} s.hx - s.ax) * s.dx + ({q} s.hy - s.ay) * s.dy, s.dx * s.dx + s.dy * s.dy)"
        for p in "+-"
        for q in "+-"
    ]
    places = ", ".join(f"greatest(0D, least(1D, {t}))" for t in ["0D", "1D", *crossings, *corners])
    far_x = f"({number(half + SLACK)} + {number(radius)} / {LON_SCALE})"
    far_y = number(half + SLACK + radius / METRES_PER_DEGREE)
    reachable = f"""filter(side, e ->
        least(e.x0, e.x1) - lon <= {far_x} and lon - greatest(e.x0, e.x1) <= {far_x}
        and least(e.y0, e.y1) - lat <= {far_y} and lat - greatest(e.y0, e.y1) <= {far_y})"""
    close = f"""
        exists(
            transform({reachable}, e -> named_struct(
                'ax', (e.x0 - lon) * {LON_SCALE}, 'ay', (e.y0 - lat) * {LAT_SCALE},
                'dx', (e.x1 - e.x0) * {LON_SCALE}, 'dy', (e.y1 - e.y0) * {LAT_SCALE},
                'hx', {number(half)} * {LON_SCALE}, 'hy', {number(half)} * {LAT_SCALE})),
            s -> exists(
                array({places}),
                t -> power(greatest(0D, abs(s.ax + t * s.dx) - s.hx), 2)
                   + power(greatest(0D, abs(s.ay + t * s.dy) - s.hy), 2) <= {number(radius * radius)}))"""
    inside = """
        size(filter(side, e -> (e.y0 > lat) <> (e.y1 > lat)
            and lon < e.x0 + try_divide((e.x1 - e.x0) * (lat - e.y0), e.y1 - e.y0))) % 2 = 1"""
    return F.expr(f"{close} or {inside}")


def to_wkt(geom: str) -> Column:
    """An outline as well-known text, one polygon per ring."""
    return F.expr(f"""
        concat('MULTIPOLYGON (', array_join(transform({geom}, ring -> concat('((', array_join(
            transform(concat(ring, slice(ring, 1, 1)),
                      p -> concat_ws(' ', cast(p.lon as string), cast(p.lat as string))), ', '), '))')), ', '), ')')""")


def from_wkt(text: str) -> Column:
    """The rings of a POLYGON or MULTIPOLYGON in well-known text; null for null, no rings for an empty one.

    Rings count by the even-odd rule, so holes and parts need not be told apart. A closing point that
    repeats the first is left out. Other shapes, and rings wider than 180 degrees, which would have to
    cross the antimeridian, fail.
    """
    return F.expr(f"""
        case when {text} is null then null
             when not {text} rlike '^(?i)\\\\s*(MULTI)?POLYGON\\\\b' then raise_error(concat('not a polygon: ', left({text}, 60)))
             else transform(
                 transform(regexp_extract_all({text}, '\\\\(([^()]+)\\\\)', 1), ring -> transform(
                     split(trim(ring), '\\\\s*,\\\\s*'),
                     p -> named_struct('lon', cast(split(trim(p), '\\\\s+')[0] as double), 'lat', cast(split(trim(p), '\\\\s+')[1] as double)))),
                 ring -> case
                     when array_max(transform(ring, p -> p.lon)) - array_min(transform(ring, p -> p.lon)) > 180
                     then raise_error('an outline crosses the antimeridian: split it there')
                     when size(ring) > 1 and ring[0] = element_at(ring, -1) then slice(ring, 1, size(ring) - 1)
                     else ring end)
        end""")

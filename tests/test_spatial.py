"""The tiled join against every cell paired with every county, by an independent distance."""

import math
import random

import pytest

from stormledger.operators import spatial as SP

from .helpers import COUNTIES, box, config, county, rows

M = 111320.0


def point_segment(px, py, ax, ay, bx, by):
    dx, dy = bx - ax, by - ay
    length = dx * dx + dy * dy
    t = 0 if length == 0 else max(0, min(1, ((px - ax) * dx + (py - ay) * dy) / length))
    return math.hypot(px - ax - t * dx, py - ay - t * dy)


def crosses(p, q, r, s):
    def turn(a, b, c):
        return (b[0] - a[0]) * (c[1] - a[1]) - (b[1] - a[1]) * (c[0] - a[0])

    return turn(p, q, r) * turn(p, q, s) < 0 and turn(r, s, p) * turn(r, s, q) < 0


def inside(point, rings):
    x, y = point
    odd = False
    for ring in rings:
        for (x0, y0), (x1, y1) in zip(ring, ring[1:] + ring[:1]):
            if (y0 > y) != (y1 > y) and x < x0 + (x1 - x0) * (y - y0) / (y1 - y0):
                odd = not odd
    return odd


def distance(lon, lat, half, rings):
    kx, ky = M * math.cos(math.radians(lat)), M
    rings = [[((x - lon) * kx, (y - lat) * ky) for x, y in ring] for ring in rings]
    hx, hy = half * kx, half * ky
    corners = [(-hx, -hy), (hx, -hy), (hx, hy), (-hx, hy)]
    if inside((0.0, 0.0), rings):
        return 0.0
    best = math.inf
    for ring in rings:
        for p, q in zip(ring, ring[1:] + ring[:1]):
            if abs(p[0]) <= hx and abs(p[1]) <= hy:
                return 0.0
            for r, s in zip(corners, corners[1:] + corners[:1]):
                if half and crosses(p, q, r, s):
                    return 0.0
                best = min(best, point_segment(*r, *p, *q), point_segment(*p, *r, *s))
    return best


def star(rng, x, y):
    """A jagged, mostly non-convex ring."""
    n = rng.randint(5, 9)
    spokes = [(2 * math.pi * k / n, rng.uniform(0.15, 1.1)) for k in range(n)]
    return [(x + r * math.cos(a), y + r * math.sin(a)) for a, r in spokes]


def setup(spark, shapes, cells):
    counties = spark.createDataFrame([county(f"{k:05d}", *rings) for k, rings in enumerate(shapes)], COUNTIES)
    grid = spark.createDataFrame([(k, float(x), float(y)) for k, (x, y) in enumerate(cells)], "cell_id bigint, lon double, lat double")
    cfg = config(county_fips=tuple(f"{k:05d}" for k in range(len(shapes))))
    return counties, grid, cfg


def test_matches_brute_force_on_rings(spark):
    rng = random.Random(7)
    shapes = [[star(rng, -95 + 1.7 * (k % 4), 30 + 1.7 * (k // 4))] for k in range(10)]
    shapes.append([box(-90, 35, -88.5, 36)])
    shapes.append([box(-93, 38, -91, 40), box(-92.6, 38.4, -91.4, 39.6)])  # a hole wider than the buffer
    shapes.append([star(rng, -86, 31), star(rng, -84, 33)])  # two parts
    cells = [(-97 + 0.25 * i, 28 + 0.25 * j) for i in range(56) for j in range(52)]
    counties, grid, cfg = setup(spark, shapes, cells)
    pairs = SP.near_pairs(grid, counties, cfg)
    want_pairs, want_centre, near_limit = set(), set(), set()
    for c, (x, y) in enumerate(cells):
        for k, rings in enumerate(shapes):
            xs, ys = [p[0] for r in rings for p in r], [p[1] for r in rings for p in r]
            if not (min(xs) - 1 < x < max(xs) + 1 and min(ys) - 1 < y < max(ys) + 1):
                continue
            whole, centre = distance(x, y, cfg.cell_half_deg, rings), distance(x, y, 0.0, rings)
            if min(abs(whole - cfg.spatial_buffer_m), abs(centre - cfg.spatial_buffer_m)) < 1e-6:
                near_limit.add((c, f"{k:05d}"))
            if whole <= cfg.spatial_buffer_m:
                want_pairs.add((c, f"{k:05d}"))
            if centre <= cfg.spatial_buffer_m:
                want_centre.add(c)
    assert not near_limit and len(want_pairs) > 500
    got = rows(pairs.select("cell_id", "county_fips"))
    assert len(got) == len(set(got)) and set(got) == want_pairs
    assert {r[0] for r in rows(SP.aoi_filter(grid, pairs).select("cell_id"))} == want_centre
    # A hole's middle is outside: not every cell of the box with a hole belongs.
    assert any(distance(x, y, 0.125, shapes[11]) > cfg.spatial_buffer_m for x, y in cells if -92.2 < x < -91.8 and 38.8 < y < 39.2)


def test_centre_decides_use_and_box_decides_county(spark):
    shapes = [[box(-90, 30, -89, 31)], [box(-88.55, 30, -87, 31)]]
    # Within both buffers; edge within but centre outside; inside the first only.
    cells = [(-88.775, 30.5), (-90.36, 30.5), (-89.7, 30.5)]
    counties, grid, cfg = setup(spark, shapes, cells)
    pairs = SP.near_pairs(grid, counties, cfg)
    assert set(rows(pairs.select("cell_id", "county_fips"))) == {(0, "00000"), (0, "00001"), (1, "00000"), (2, "00000")}
    used = {r.cell_id: sorted(c.county_fips for c in r.counties) for r in SP.cell_counties(pairs).collect()}
    assert used == {0: ["00000", "00001"], 2: ["00000"]}


def test_bounds_hold_every_used_cell(spark):
    shapes = [[star(random.Random(3), -95, 47)], [box(-90, 30, -89, 31)]]
    cells = [(-100 + 0.3 * i, 26 + 0.3 * j) for i in range(50) for j in range(80)]
    counties, grid, cfg = setup(spark, shapes, cells)
    bounds = SP.area_bounds(counties, cfg)
    kept = grid.where(SP.in_bounds(bounds))
    everything = SP.near_pairs(grid, counties, cfg).select("cell_id", "county_fips")
    assert kept.count() < grid.count() and everything.count() > 20
    assert set(rows(SP.near_pairs(kept, counties, cfg).select("cell_id", "county_fips"))) == set(rows(everything))


def test_no_target_county_gives_no_cells(spark):
    counties, grid, cfg = setup(spark, [[box(-90, 30, -89, 31)]], [(-89.5, 30.5)])
    other = config(county_fips=("99999",))
    assert SP.area_bounds(counties, other) is None
    assert grid.where(SP.in_bounds(None)).count() == 0


def test_outlines_as_text(spark):
    from stormledger.functions.geometry import from_wkt

    texts = ["POLYGON ((0 0, 2 0, 2 2, 0 0), (0.5 0.5,1 0.5 , 1 1, 0.5 0.5))", " multipolygon(((-1.5 3, 1e1 3, 4 5)), ((7 7, 8 7, 8 8, 7 7)))", None, "POLYGON EMPTY"]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(from_wkt("t")).collect()]
    as_points = [None if g is None else [[(p.lon, p.lat) for p in ring] for ring in g] for g in got]
    assert as_points == [
        [[(0, 0), (2, 0), (2, 2)], [(0.5, 0.5), (1, 0.5), (1, 1)]], [[(-1.5, 3), (10, 3), (4, 5)], [(7, 7), (8, 7), (8, 8)]], None, [],
    ]
    for bad in ("POINT (1 2)", "POLYGON ((-179 0, 179 0, 179 1, -179 0))", "POLYGON ((a b, 1 2, 3 4))"):
        with pytest.raises(Exception, match="polygon|antimeridian|(?i:cast)"):
            spark.createDataFrame([(bad,)], "t string").select(from_wkt("t")).collect()

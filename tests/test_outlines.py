"""Outlines of any form and size against every cell paired with every county, by an independent distance."""

import math
import random

from stormledger.operators import outlines as O
from stormledger.operators import spatial as SP

from .helpers import COUNTIES, box, config, county, rows
from .test_spatial import M, crosses, distance, inside, point_segment, star

CELLS = "cell_id bigint, lon double, lat double, cell_geom array<array<struct<lon: double, lat: double>>>"


def apart(lat, one, other):
    """Metres between two outlines at the scale of a latitude."""
    kx = M * math.cos(math.radians(lat))
    one, other = ([[(x * kx, y * M) for x, y in ring] for ring in rings] for rings in (one, other))
    if any(inside(p, other) for ring in one for p in ring) or any(inside(p, one) for ring in other for p in ring):
        return 0.0
    best = math.inf
    for r in one:
        for p, q in zip(r, r[1:] + r[:1]):
            for s in other:
                for a, b in zip(s, s[1:] + s[:1]):
                    if crosses(p, q, a, b):
                        return 0.0
                    best = min(best, *(point_segment(*e, *a, *b) for e in (p, q)), *(point_segment(*e, *p, *q) for e in (a, b)))
    return best


def setup(spark, shapes, cells):
    counties = spark.createDataFrame([county(f"{k:05d}", *rings) for k, rings in enumerate(shapes)], COUNTIES)
    plain = [(k, float(x), float(y), geom and [[(float(a), float(b)) for a, b in ring] for ring in geom]) for k, (x, y, geom) in enumerate(cells)]
    grid = spark.createDataFrame(plain, CELLS)
    return counties, grid, config(county_fips=tuple(f"{k:05d}" for k in range(len(shapes))))


def test_equals_brute_force_over_shapes_of_many_sizes(spark):
    rng = random.Random(11)
    shapes = [[star(rng, -95 + 2.1 * (k % 4), 30 + 2.1 * (k // 4))] for k in range(8)]
    shapes.append([box(-99, 29, -84, 39), box(-98, 30, -85, 38)])  # a frame around all others
    shapes.append([box(-90.01, 35, -90, 35.01)])
    shapes.append([[(-93, 36), (-91, 36), (-91, 36.5), (-92, 36.5), (-92, 38), (-93, 38)]])
    cells = []
    for k in range(400):
        x, y, size = rng.uniform(-100, -83), rng.uniform(28, 40), rng.choice([0.02, 0.15, 0.15, 0.6, 3.0])
        turn, n = rng.uniform(0, 6), rng.choice([3, 4, 4, 7])
        ring = [(x + size * math.cos(turn + 2 * math.pi * i / n), y + size * math.sin(turn + 2 * math.pi * i / n)) for i in range(n)]
        cells.append((x, y, [ring]))
    counties, grid, cfg = setup(spark, shapes, cells)
    want, centres = set(), set()
    for c, (x, y, geom) in enumerate(cells):
        for k, rings in enumerate(shapes):
            if apart(y, geom, rings) <= cfg.spatial_buffer_m:
                want.add((c, f"{k:05d}"))
                if distance(x, y, 0.0, rings) <= cfg.spatial_buffer_m:
                    centres.add((c, f"{k:05d}"))
    got = O.outline_pairs(grid, counties, cfg).collect()
    assert len(got) == len({(r.cell_id, r.county_fips) for r in got}) and len(want) > 250
    assert {(r.cell_id, r.county_fips) for r in got} == want
    assert {(r.cell_id, r.county_fips) for r in got if r.centre_near} == centres


def test_squares_as_outlines_give_what_squares_give(spark):
    rng = random.Random(5)
    shapes = [[star(rng, -95, 30)], [star(rng, -93, 31)], [box(-92, 29, -91, 30)]]
    spots = [(-97 + 0.25 * i, 28 + 0.25 * j) for i in range(28) for j in range(20)]
    counties, grid, cfg = setup(spark, shapes, [(x, y, [box(x - 0.125, y - 0.125, x + 0.125, y + 0.125)]) for x, y in spots])
    columns = ["cell_id", "county_fips", "county_name", "centre_near"]
    squares = rows(SP.near_pairs(grid.drop("cell_geom"), counties, cfg).select(columns))
    again = SP.near_pairs(SP.cells_of(grid.union(grid)), counties, cfg)
    assert sorted(rows(again.select(columns))) == sorted(squares) and len(squares) > 60


def test_awkward_outlines(spark):
    shapes = [[box(-90, 30, -89, 31)], [], [[]]]
    cells = [
        (-89.5, 30.5, None), (-89.5, 30.5, []), (-89.5, 30.5, [[]]),  # the centre alone
        (-89.5, 30.5, [[(-89.5, 30.5)]]), (-80.0, 30.5, [[(-80.0, 30.5), (-89.5, 30.5)]]),  # a point, a line
        (-89.5, 30.5, [box(-95, 25, -85, 35)]), (-80.0, 30.5, None),
    ]
    counties, grid, cfg = setup(spark, shapes, cells)
    pairs = rows(O.outline_pairs(grid, counties, cfg).select("cell_id", "county_fips", "centre_near"))
    assert sorted(pairs) == [(k, "00000", k != 4) for k in range(6)]
    assert O.outline_pairs(grid.limit(0), counties, cfg).count() == 0
    assert O.outline_pairs(grid, counties.limit(0), cfg).count() == 0


def test_small_shapes_list_few_tiles(spark):
    """A cell as wide as a continent costs a few tiles, not thousands."""
    counties, grid, cfg = setup(spark, [[box(-90, 30, -89, 31)]], [(-100.0, 40.0, [box(-130, 20, -70, 55)]), (-89.5, 30.5, None)])
    shapes = O._levelled(O.cell_shapes(grid, cfg.spatial_buffer_m), cfg)
    filed = O._filed(shapes, O._top(shapes), cfg)
    assert max(r["count"] for r in filed.groupBy("cell_id", "tile_level").count().collect()) <= 4

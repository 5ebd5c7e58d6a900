import math
import random

import numpy as np
from pyspark.sql import functions as F

from stormledger.llm import negatives as N

from .helpers import CLASHING

SCHEMA = "vec_id long, label int, embedding array<double>"


def plain(rows, every, cfg):
    """All products of all pairs. rows: (id, label, vector) without repeated ids."""
    good = [
        (i, lab, [math.floor(cfg.scale * x) for x in v]) for i, lab, v in rows
        if i is not None and lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = set()
    for a, la, va in good:
        if a % every:
            continue
        scored = sorted(((-sum(x * y for x, y in zip(va, v)), i, lab) for i, lab, v in good if i != a and len(v) == len(va)))
        for p, pos, _ in [s for s in scored if s[2] == la][: cfg.positives]:
            near = [(s, i) for s, i, lab in scored if lab != la and cfg.least_percent * -p <= 100 * -s <= cfg.most_percent * -p]
            out |= {(a, pos, k + 1, i, -p, -s) for k, (s, i) in enumerate(near[: cfg.negatives])}
    return out


def found(spark, rows, every, cfg, more=False):
    table = spark.createDataFrame(rows, SCHEMA)
    if more:
        table = table.selectExpr("*", *[f"'x' AS `{c.replace('`', '``')}`" for c in [*CLASHING, "vec", "length", "needed", "block", "group"]])
    return [tuple(r) for r in N.hard_negatives(table, F.col("vec_id") % every == 0, cfg).collect()]


def random_rows(n, dim, labels, seed):
    rnd = random.Random(seed)
    centres = [[rnd.gauss(0, 1) for _ in range(dim)] for _ in range(labels)]
    rows = []
    for i in range(n):
        lab, size = rnd.randrange(labels), rnd.choice([0.3, 1.0, 4.0])
        rows.append((i, lab, [size * (c + rnd.gauss(0, 0.6)) for c in centres[rnd.randrange(labels)]]))
    return rows


def test_equals_brute_force_in_small_blocks(spark):
    rows = random_rows(240, 6, 4, 1)
    cfg = N.Settings(rows=180, anchors=60, prunes_percent=95)
    got = found(spark, rows, 5, cfg)
    assert len(got) == len(set(got)) and set(got) == plain(rows, 5, cfg) and len(got) > 100


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, 1, [1.0, 0.0]), (0, 1, [1.0, 0.0]), (1, 1, [1.0, 0.0]), (2, 1, [1.0, 0.0]), (3, 2, [0.9, 0.0]), (4, 2, [0.9, 0.0]),
        (5, 3, [0.9, 0.1]), (6, None, [0.9, 0.0]), (7, 2, None), (8, 2, [nan, 0.0]), (9, 2, [inf, 0.0]), (10, 2, [None, 0.9]), (None, 2, [0.9, 0.0]),
        (50, 2, [0.0, 0.0]), (100, 4, []), (101, 4, []), (102, 5, []), (150, 6, [1.0, 2.0, 3.0]), (200, 7, [-1.0, 0.0]), (201, 7, [1.0, 0.0]),
    ]
    cfg = N.Settings()
    got = found(spark, rows, 50, cfg, more=True)
    assert len(got) == len(set(got)) and set(got) == plain(rows[:1] + rows[2:], 50, cfg)
    assert (0, 1, 1, 3, 65536, 58880) in got and (100, 101, 1, 102, 0, 0) in got
    assert found(spark, [], 50, cfg) == []


def test_large_numbers_are_exact_or_clipped():
    a = np.array([[2.0**40, 1.0], [1e140, 0.0]])
    b = np.array([[2.0**15, 3.0], [1e140, 1.0], [-1e140, 1.0]])
    assert N.products(a, b).tolist() == [[2**55 + 3, N.FURTHEST, -N.FURTHEST], [N.FURTHEST, N.FURTHEST, -N.FURTHEST]]


def test_coordinate_ranges_lose_nothing_and_prune():
    rnd = np.random.default_rng(3)
    rows = np.floor(rnd.normal(size=(400, 5)) * 50)
    lengths = np.sqrt((rows * rows).sum(axis=1))
    block = N.Block(rows, lengths)
    pruned = 0
    for k in range(40):
        scores = rows @ rows[k]
        for needed in np.quantile(scores, [0.6, 0.9, 0.99]):
            some = block.feasible(rows[k], lengths[k], needed, N.Settings(prunes_percent=99))
            kept = np.arange(400) if some is None else some
            assert set(np.flatnonzero(scores >= needed)) <= set(kept)
            pruned += 400 - len(kept)
    assert pruned > 1_000

import random

import pytest

from stormledger.operators.events import event_marks, outage_events

from .helpers import config, minutes, readings, rows

A, B = "01001", "01003"


def detect(data, cfg):
    """Events read off one ordered list per county."""
    events = []
    for county in sorted({c for c, _, _ in data if c in cfg.county_fips}):
        mine = sorted((t, -1.0 if r is None else r) for c, t, r in data if c == county and cfg.start <= t < cfg.end)
        current, number, before = None, 0, None
        for t, r in mine:
            on = r >= cfg.event_outage_threshold
            if on:
                gap = before and int((t - before[0]).total_seconds() // 60)
                if before is None or not before[1] or gap > cfg.event_gap_minutes:
                    number += 1
                    current = [county, number, t, t, r]
                    events.append(current)
                current[3], current[4] = t, max(current[4], r)
            before = (t, on)
    return {(c, n, s, e, int((e - s).total_seconds() // 60), p) for c, n, s, e, p in events}


def found(spark, data, cfg):
    return set(rows(outage_events(readings(spark, data), cfg).select(
        "county_fips", "event_id", "start_ts", "end_ts", "duration_min", "peak_outage")))


CASES = {
    "dip ends": [(A, 0, 0.1), (A, 15, 0.1), (A, 30, 0.0), (A, 45, 0.1)],
    "gap of exactly the limit": [(A, 0, 0.1), (A, 60, 0.1)],
    "gap over the limit": [(A, 0, 0.1), (A, 61, 0.1)],
    "seconds do not round up": [(A, 0, 0.1), (A, 60.98, 0.1)],
    "unknown ratio ends": [(A, 0, 0.1), (A, 15, None), (A, 30, 0.1)],
    "first reading on": [(A, 0, 0.1)],
    "ends at the window": [(A, -15, 0.1), (A, 0, 0.1), (A, 2879, 0.1), (A, 2880, 0.1)],
    "same instant on twice": [(A, 0, 0.1), (A, 0, 0.2), (A, 15, 0.1)],
    "same instant off then on": [(A, 0, 0.1), (A, 15, 0.0), (A, 15, 0.2), (A, 30, 0.1)],
    "across many empty pieces": [(A, 5, 0.1), (A, 65, 0.1), (A, 700, 0.1), (A, 2000, 0.1), (A, 2059, 0.1)],
    "two counties": [(A, 0, 0.1), (B, 5, 0.1), (A, 10, 0.0), (B, 10, 0.3)],
    "other counties are ignored": [("99999", 0, 0.1)],
}


@pytest.mark.parametrize("name", CASES)
def test_hand_cases(spark, name):
    data = [(c, minutes(m), r) for c, m, r in CASES[name]]
    assert found(spark, data, config()) == detect(data, config())


@pytest.mark.parametrize("hours", [1, 6, 24])
def test_pieces_do_not_change_events(spark, hours):
    rng = random.Random(hours)
    cfg = config(event_piece_hours=hours, event_gap_minutes=20)
    data = []
    for county in (A, A, A, B):  # one county holds most readings
        t = rng.uniform(-60, 0)
        while t < 3000:
            t += rng.choice([0, 1, 4, 9, 20, 21, 45, 130])
            data.append((county, minutes(t), rng.choice([None, 0.0, 0.001, 0.005, 0.02, 0.3, 0.3, 0.3])))
    got = found(spark, data, cfg)
    assert len(got) > 50 and got == detect(data, cfg)


def test_marks_partition_the_on_readings(spark):
    data = [(A, minutes(m), r) for m, r in [(0, 0.1), (15, 0.1), (30, 0.0), (200, 0.2), (201, None), (202, 0.2)]]
    got = rows(event_marks(readings(spark, data), config()).select(
        "outage_on", "prev_outage_on", "gap_min", "is_start", "event_id").orderBy("ts"))
    assert got == [
        (True, None, None, 1, 1), (True, True, 15, 0, 1), (False, True, 15, 0, None),
        (True, False, 170, 1, 2), (False, True, 1, 0, None), (True, False, 1, 1, 3),
    ]

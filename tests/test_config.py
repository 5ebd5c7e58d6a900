from datetime import datetime

import pytest

from stormledger.config import Config

from .helpers import config


def test_required_settings():
    with pytest.raises(ValueError, match="county_fips, start_date"):
        Config(end_date="2024-01-01")
    with pytest.raises(ValueError, match="start_date"):
        config(start_date="2024-04-01")


def test_init_times_cover_longest_lead_and_end():
    times = config(lead_hours=(24, 30), init_hours=(0, 12)).init_times()
    # 30 hours before the start, floored to a day, to the end inclusive.
    assert times[0] == datetime(2024, 3, 8) and times[-1] == datetime(2024, 3, 12, 12)
    assert len(times) == 10


def test_from_env_reads_lists_and_numbers():
    cfg = Config.from_env({
        "COUNTY_FIPS": "01051, 01101", "START_DATE": "2024-05-06", "END_DATE": "2024-05-15",
        "LEAD_HOURS": "24,48", "OUTAGE_THRESHOLD": "0.1", "ML_MODELS": "logistic", "EVENT_GAP_MINUTES": "30",
    })
    assert cfg.county_fips == ("01051", "01101") and cfg.lead_hours == (24, 48)
    assert cfg.outage_threshold == 0.1 and cfg.ml_models == ("logistic",) and cfg.event_gap_minutes == 30


def test_fingerprint_follows_settings():
    assert config().fingerprint() == config().fingerprint() != config(outage_threshold=0.2).fingerprint()


def test_init_time_filter_is_the_list(spark):
    from datetime import timedelta

    from stormledger.sources.forecasts import in_init_times

    cfg = config(lead_hours=(24, 30), init_hours=(0, 12))
    near = [t + timedelta(minutes=m) for t in cfg.init_times() for m in (-720, -360, -1, 0, 1, 360, 720)]
    df = spark.createDataFrame([(t,) for t in sorted(set(near))], "init_time timestamp_ntz")
    assert sorted(r.init_time for r in df.where(in_init_times(cfg)).collect()) == sorted(cfg.init_times())


def test_settings_that_cannot_work_are_refused():
    for bad in ({"event_piece_hours": 5}, {"automl_families": ()}, {"automl_families": ("logistic", "other")}):
        with pytest.raises(ValueError):
            config(**bad)

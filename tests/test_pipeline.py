"""Whole runs: setup, phases, resume, dry run, failure, log."""

import json
from datetime import timedelta

import pytest

from stormledger.plans.runs import ordered_phases, recent_runs, run_phases, run_setup
from stormledger.plans.workspace import Workspace
from stormledger.schemas import MODEL_FEATURES, OUTAGE_RAW
from stormledger.sources.forecasts import forecast_scan, save_forecasts
from stormledger.sources.outages import load_outage_csv, read_outage_lines, read_outage_part, save_outage_raw, upsert_outage_raw
from stormledger.sources.tables import write_clustered, write_table
from stormledger.sources.tables import ensure_namespace

from .helpers import COUNTIES, DAY, FORECASTS, box, config, county, rows, step

CFG = config(county_fips=("01001", "01003"), min_samples_per_block=2, ml_max_iterations=2, end_date="2024-03-20",
             ml_models=("regressor", "logistic"))


@pytest.fixture(scope="module")
def inputs(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("run"))
    raw = spark.createDataFrame(
        [(fips, "C", "S", (7 * k * fips) % 100 if k % 9 < 4 else 0, DAY + timedelta(minutes=60 * k), 1000)
         for fips in (1001, 1003, 1005) for k in range(240)],
        OUTAGE_RAW,
    )
    counties = spark.createDataFrame([county("01001", box(-90, 30, -89, 31)), county("01003", box(-88, 30, -87, 31))], COUNTIES)
    states = spark.createDataFrame([("01", "Alabama")], "state_fips_code string, state_name string")
    run_setup(spark, root, raw, counties.drop("state_name"), states)
    init = DAY - timedelta(days=2)
    forecasts = spark.createDataFrame(
        [(c, -89.5 + 2 * (c % 2), 30.5, init + timedelta(days=d),
          [step(init + timedelta(days=d), h, u10=float((d * h * (c + 1)) % 30)) for h in range(0, 54, 6)])
         for c in range(2) for d in range(12)],
        FORECASTS,
    )
    save_forecasts(forecasts, f"{root}/forecasts", CFG)
    return root, forecast_scan(spark, f"{root}/forecasts", CFG)


def test_phase_order():
    assert ordered_phases(["serving", "correlation", "serving"]) == ["correlation", "serving"]
    assert ordered_phases(["all"]) == ["correlation", "ml", "serving"]
    assert ordered_phases(["ml-eval", "ml", "ml-data"]) == ["ml"] and ordered_phases(["ml-eval", "ml-data"]) == ["ml-data", "ml-eval"]
    with pytest.raises(ValueError):
        ordered_phases(["looks"])


def test_dry_run_stores_nothing(spark, inputs):
    root, forecasts = inputs
    got = run_phases(spark, CFG, root, forecasts, dry_run=True)
    assert {r.status for r in got} == {"PLANNED"}
    plans = {r.step: r.detail for r in got}
    assert "GreaterThanOrEqual(lon" in plans["weather_features"]
    assert "Physical Plan" in plans["event_coverage"] and plans["model_regressor"] == ""
    assert not Workspace(spark, CFG, root).is_built("weather_features")
    assert recent_runs(spark, root).count() == 0


def test_full_run_then_resume(spark, inputs):
    root, forecasts = inputs
    got = run_phases(spark, CFG, root, forecasts)
    assert {r.status for r in got} == {"OK"}, [r for r in got if r.status != "OK"]
    assert spark.table("preboard_view").count() == 20
    other = spark.newSession()
    assert other.read.parquet(f"{root}/preboard_view").count() == 20
    assert other.read.parquet(f"{root}/kpi_overview").count() == 1
    assert other.read.parquet(f"{root}/correlation_heatmap").count() == 12
    for name in ("evaluation_regressor", "evaluation_logistic"):
        row = spark.read.parquet(f"{root}/{name}").first()
        assert row.model_type in name and row.run_id.startswith("ml-")
    assert spark.read.parquet(f"{root}/threshold_sweep_regressor").count() == 6
    every = spark.read.parquet(f"{root}/training_data").count()
    for key, column in (("regressor", "predicted_ratio"), ("logistic", "predicted_probability")):
        scores = spark.read.parquet(f"{root}/scores_{key}")
        assert scores.where(f"{column} is not null").count() == every > spark.read.parquet(f"{root}/predictions_{key}").count()
        assert other.read.parquet(f"{root}/ml_risk_{key}").where("ml_risk_tier is not null").count() == every
        assert spark.table(f"ml_risk_{key}").count() == every
        assert spark.read.parquet(f"{root}/explanation_{key}").select("feature").distinct().count() == len(MODEL_FEATURES)
    log = recent_runs(spark, root).collect()
    assert sorted(r.phase for r in log) == ["correlation", "ml", "serving"]
    assert all(r.status == "SUCCESS" and r.steps_failed == 0 and r.started_at <= r.completed_at for r in log)
    assert json.loads(log[0].config)["start_date"] == "2024-03-10"

    again = run_phases(spark, CFG, root, forecasts, ["correlation"], resume=True)
    assert {(r.kind, r.status) for r in again} == {("table", "SKIPPED"), ("view", "OK")}
    scoring = run_phases(spark, CFG, root, forecasts, ["ml-score"], resume=True)
    assert {(r.step, r.status) for r in scoring} == {(f"{n}_{k}", "SKIPPED") for n in ("scores", "ml_risk") for k in CFG.ml_models}
    # Other settings: nothing may be skipped.
    changed = config(**{**CFG.__dict__, "outage_threshold": 0.2})
    other = run_phases(spark, changed, root, forecasts, ["correlation"], resume=True)
    assert {r.status for r in other} == {"OK"}


def test_first_failure_stops_and_is_logged(spark, inputs, tmp_path):
    root, forecasts = inputs
    broken = forecasts.drop("forecast")
    got = run_phases(spark, config(**{**CFG.__dict__, "outage_threshold": 0.3}), root, broken, ["correlation", "serving"])
    assert [(r.step, r.status) for r in got] == [("cell_map", "OK"), ("weather_features", "FAILED")]
    last = recent_runs(spark, root, 1).first()
    assert (last.status, last.steps_failed, last.phase) == ("FAILED", 1, "correlation")
    assert not Workspace(spark, CFG, root).is_built("weather_features")


def test_resume_rebuilds_whatever_follows_from_a_new_input(spark, inputs, tmp_path, monkeypatch):
    from stormledger.plans import steps

    _, forecasts = inputs
    raw = spark.read.parquet(f"{inputs[0]}/outage_raw")
    counties = spark.read.parquet(f"{inputs[0]}/counties_ref").drop("state_name")
    states = spark.createDataFrame([("01", "Alabama")], "state_fips_code string, state_name string")
    roots = {name: str(tmp_path / name) for name in ("resumed", "fresh")}
    run_setup(spark, roots["resumed"], raw, counties, states)
    assert {r.status for r in run_phases(spark, CFG, roots["resumed"], forecasts, ["correlation"])} == {"OK"}
    half = raw.where("minute(run_start_time) = 0 and customers_out % 2 = 0")
    for root in roots.values():
        run_setup(spark, root, half, counties, states)

    def fails(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(steps, "event_coverage", fails)
        got = run_phases(spark, CFG, roots["resumed"], forecasts, ["correlation"])
    assert got[-1].step == "event_coverage" and got[-1].status == "FAILED"
    got = {r.step: r.status for r in run_phases(spark, CFG, roots["resumed"], forecasts, ["correlation"], resume=True)}
    assert got["outage_events"] == "SKIPPED"
    assert {got[s] for s in ("event_coverage", "lead_performance", "correlations")} == {"OK"}
    run_phases(spark, CFG, roots["fresh"], forecasts, ["correlation"])
    for name in ("lead_performance", "correlations", "event_coverage", "outage_6h_qc"):
        resumed, fresh = (
            sorted(str([round(v, 9) if isinstance(v, float) else v for v in r]) for r in rows(spark.read.parquet(f"{roots[k]}/{name}")))
            for k in ("resumed", "fresh")
        )
        assert resumed == fresh
    other = run_phases(spark, CFG, roots["fresh"], forecasts, ["correlation"], resume=True, forecasts_id="next day")
    assert {r.step: r.status for r in other}["weather_features"] == "OK"


def test_loading_twice_adds_nothing(spark, tmp_path):
    csv = tmp_path / "in.csv"
    csv.write_text("fips_code,county,state,customers_out,run_start_time,total_customers\n"
                   "1001,Autauga,Alabama,12,2024-03-10 02:15:00,100\n1003,Baldwin,Alabama,,2024-03-10T02:30:00,\n")
    frame = load_outage_csv(spark, str(csv))
    assert rows(frame)[0] == (1001, "Autauga", "Alabama", 12, DAY + timedelta(minutes=135), 100)
    assert rows(frame)[1] == (1003, "Baldwin", "Alabama", None, DAY + timedelta(minutes=150), None)
    for mode, n in (("overwrite", 2), ("overwrite", 2), ("append", 4)):
        save_outage_raw(frame, str(tmp_path / "raw"), mode)
        assert spark.read.parquet(str(tmp_path / "raw")).count() == n


def test_a_failed_build_leaves_the_old_table(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(spark.range(3), path)
    bad = spark.range(3).selectExpr("if(id = 2, raise_error('broken'), id) as id")
    for write in (lambda df: write_table(df, path), lambda df: write_clustered(df.selectExpr("id", "1 as part"), path, "part", ["id"])):
        with pytest.raises(Exception, match="broken"):
            write(bad)
        assert rows(spark.read.parquet(path).orderBy("id")) == [(0,), (1,), (2,)]
    write_table(spark.read.parquet(path).selectExpr("id + 5 as id"), path)  # a table from itself
    assert rows(spark.read.parquet(path).orderBy("id")) == [(5,), (6,), (7,)]


def test_upsert_keeps_the_latest_load_once(spark, tmp_path):
    path, t = str(tmp_path / "raw"), DAY
    schema = "fips_code bigint, county string, state string, customers_out bigint, run_start_time timestamp_ntz, total_customers bigint"
    upsert_outage_raw(spark.createDataFrame([(1, "A", "S", 9, t, 10), (2, "B", "S", 1, t, 10)], schema), path)
    later = [(1, "A", "S", 3, t, 10), (1, "A", "S", None, t, 10), (3, "C", "S", None, t, None), (3, "C", "S", None, t, None), (None, "x", "S", 1, t, 1), (4, "x", "S", 1, None, 1)]
    for _ in range(2):
        upsert_outage_raw(spark.createDataFrame(later, schema), path)
    assert rows(spark.read.parquet(path).orderBy("fips_code").select("fips_code", "customers_out")) == [(1, 3), (2, 1), (3, None)]


def test_unreadable_lines_are_quarantined_whole(spark, tmp_path):
    csv = tmp_path / "in.csv"
    bad = ["1001,A,S,twelve,2024-03-10 00:00:00,2", "1001,A,S,1,not-a-time,2", "1001,A,S", "1,A,S,1,2024-03-10 00:00:00,2,9"]
    csv.write_text("\n".join(["fips_code,county,state,customers_out,run_start_time,total_customers", "1,A,S,,2024-03-10 00:00:00,2", *bad, "2,B,S,1,2024-03-10 00:00:00,"]) + "\n")
    good, held = read_outage_lines(spark, str(csv))
    assert [(r.fips_code, r.customers_out) for r in good.orderBy("fips_code").collect()] == [(1, None), (2, 1)]
    assert sorted(r.line for r in held.collect()) == sorted(bad) and all("in.csv" in r.file for r in held.collect())


@pytest.mark.parametrize("line", ["1001,A,S,twelve,2024-03-10 00:00:00,2", "1001,A,S,1,not-a-time,2", "1001,A,S"])
def test_unreadable_lines_are_refused(spark, tmp_path, line):
    csv = tmp_path / "in.csv"
    csv.write_text(f"fips_code,county,state,customers_out,run_start_time,total_customers\n1001,A,S,1,2024-03-10 00:00:00,2\n{line}\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        load_outage_csv(spark, str(csv)).collect()


def test_other_headers_are_refused(spark, tmp_path):
    csv = tmp_path / "in.csv"
    csv.write_text("county,fips_code,state,customers_out,run_start_time,total_customers\nA,1001,S,1,2024-03-10 00:00:00,2\n")
    with pytest.raises(Exception, match="(?i)header"):
        load_outage_csv(spark, str(csv)).collect()


def test_window_prunes_day_folders(spark, inputs):
    root, _ = inputs
    plan = read_outage_part(spark, f"{root}/outage_part", config())._jdf.queryExecution().toString()
    assert "ts_date" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_namespace_is_created_once(spark):
    ensure_namespace(spark, "storm_check")
    ensure_namespace(spark, "storm_check")
    assert spark.catalog.databaseExists("storm_check")

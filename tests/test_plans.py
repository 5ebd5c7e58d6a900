"""Shapes of the physical plans."""

import contextlib
import io

import pytest

from checks.compare import DATA
from checks.queries import CFG, Inputs, queries
from stormledger.operators.events import outage_events
from stormledger.operators.spatial import in_bounds
from stormledger.operators.weather_features import county_weather
from stormledger.sources.forecasts import explode_forecast, forecast_scan, save_forecasts

SF = f"{DATA}/sf0.001"
LEARNED = {"train_regressor", "train_classifier", "train_logistic", "model_search", "feature_importance",
           "predict_regression", "predict_classification", "batch_score", "ml_risk_view", "global_explanation"}


def explain(df) -> str:
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()


@pytest.mark.parametrize("name", sorted(set(queries()) - LEARNED))
def test_no_pair_joins_and_no_python_workers(spark, name):
    plan = explain(queries()[name](spark, SF))
    for bad in ("CartesianProduct", "NestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in plan


def test_forecast_scan_reads_wanted_runs_and_bands_only(spark, tmp_path):
    """Stored forecasts carry more bands than are read."""
    from pyspark.sql import functions as F

    path = str(tmp_path / "forecasts")
    wide = Inputs(spark, SF).forecasts.withColumn(
        "forecast", F.transform("forecast", lambda f: f.withField("2m_temperature", F.lit(1.0)))
    )
    save_forecasts(wide, path, CFG)
    steps = explode_forecast(forecast_scan(spark, path, CFG).where(in_bounds((-100.0, 30.0, -90.0, 38.0))), CFG)
    plan = explain(steps)
    schema = next(line for line in plan.splitlines() if line.startswith("ReadSchema"))
    assert "10m_u_component_of_wind" in schema and "2m_temperature" not in schema
    assert "init_date" in next(line for line in plan.splitlines() if line.startswith("PartitionFilters"))
    pushed = next(line for line in plan.splitlines() if line.startswith("PushedFilters"))
    assert "GreaterThanOrEqual(lon,-100.0)" in pushed and "LessThanOrEqual(lat,38.0)" in pushed
    assert steps.count() > 0


def test_weather_has_one_shuffle_and_combines_before_it(spark):
    i = Inputs(spark, SF)
    cells = spark.createDataFrame([], "cell_id bigint, counties array<struct<county_fips: string, county_name: string>>")
    plan = explain(county_weather(i.forecasts, cells.hint("broadcast"), CFG))
    body = plan.split("(1) Scan")[0]
    assert body.count("Exchange") - body.count("BroadcastExchange") == 1
    assert body.count("HashAggregate") == 2


def test_events_share_the_shuffle_of_readings(spark):
    df = outage_events(Inputs(spark, SF).readings, CFG)
    df.collect()
    final = explain(df).split("Initial Plan")[0]
    assert "ReusedExchange" in final

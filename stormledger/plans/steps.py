"""The steps of each phase, in order."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame

from ..config import Config
from ..operators import evaluation as E
from ..operators import serving as S
from ..operators.attribution import global_explanation
from ..operators.blocks import outage_6h_qc, six_hour_grid
from ..operators.coverage import event_coverage, wx_lead_flags
from ..operators.events import outage_events
from ..operators.master import outage_vs_weather
from ..operators.models import batch_score, model_kind
from ..operators.plan import daily_plan
from ..operators.skill import correlations, lead_performance, threshold_sweep
from ..operators.thresholds import county_thresholds
from ..operators.training import training_data
from ..operators.weather_features import cell_map, county_weather, save_weather_features, scope_forecasts
from .workspace import Step, Workspace


def _outages(ws: Workspace) -> DataFrame:
    return ws.get("outage_part")


def _weather(ws: Workspace) -> DataFrame:
    """County weather from scoped forecasts and the cell map, which is a step of its own."""
    scoped = scope_forecasts(ws.scan(), ws.get("counties_ref"), ws.cfg)
    return county_weather(scoped, ws.get("cell_map"), ws.cfg)


def _cells(ws: Workspace) -> DataFrame:
    counties = ws.get("counties_ref")
    return cell_map(scope_forecasts(ws.scan(), counties, ws.cfg), counties, ws.cfg)


def _coverage(ws: Workspace) -> DataFrame:
    flags = wx_lead_flags(ws.get("weather_features"), ws.get("county_thresholds"), ws.cfg)
    return event_coverage(ws.get("outage_events"), flags, ws.cfg)


def correlation_steps() -> list[Step]:
    """Thresholds, blocks and the plan are stored although cheap: several later steps read them."""
    return [
        Step("cell_map", "table", _cells),
        Step("weather_features", "table", _weather, save_weather_features, drop=("hour_date",)),
        Step("outage_6h_qc", "table", lambda ws: outage_6h_qc(_outages(ws), ws.cfg)),
        Step("six_hour_grid", "view", lambda ws: six_hour_grid(ws.get("counties_ref"), ws.cfg)),
        Step("county_thresholds", "table", lambda ws: county_thresholds(ws.get("weather_features"), ws.cfg)),
        Step(
            "outage_vs_weather",
            "table",
            lambda ws: outage_vs_weather(
                ws.get("six_hour_grid"), ws.get("weather_features"), ws.get("outage_6h_qc"), ws.cfg
            ),
        ),
        Step("outage_events", "table", lambda ws: outage_events(_outages(ws), ws.cfg)),
        Step("event_coverage", "table", _coverage),
        Step(
            "daily_plan",
            "table",
            lambda ws: daily_plan(ws.get("weather_features"), ws.get("county_thresholds"), ws.cfg),
        ),
        Step(
            "lead_performance",
            "table",
            lambda ws: lead_performance(ws.get("outage_vs_weather"), ws.get("county_thresholds"), ws.cfg),
        ),
        Step("correlations", "table", lambda ws: correlations(ws.get("outage_vs_weather"), ws.cfg)),
    ]


def training_steps() -> list[Step]:
    return [Step("training_data", "table", lambda ws: training_data(ws.get("outage_vs_weather"), ws.cfg))]


def model_steps(cfg: Config) -> list[Step]:
    def train(key: str, ws: Workspace):
        return model_kind(key).train(ws.get("training_data"), ws.cfg)

    return [Step(f"model_{key}", "model", partial(train, key), plannable=False) for key in cfg.ml_models]


def evaluation_steps(cfg: Config, run_id: str) -> list[Step]:
    """Predictions are stored first; the other tables of a model are aggregates over them."""
    steps: list[Step] = []
    for key in cfg.ml_models:
        predictions = f"predictions_{key}"
        if model_kind(key).category == "regressor":
            predict, tables = E.predict_regression, {
                "evaluation": E.evaluate_regression,
                "threshold_sweep": threshold_sweep,
            }
        else:
            predict, tables = E.predict_classification, {
                "evaluation": E.evaluate_classification,
                "confusion_matrix": E.confusion_matrix,
                "roc_curve": E.roc_curve,
                "roc_points": E.roc_points,
            }

        def scored(ws: Workspace, key=key, predict=predict) -> DataFrame:
            return E.tagged(predict(ws.model(key), ws.get("training_data")), key, run_id)

        def importance(ws: Workspace, key=key) -> DataFrame:
            return E.tagged(E.feature_importance(ws.model(key), ws.get("training_data")), key, run_id)

        def explained(ws: Workspace, key=key) -> DataFrame:
            return E.tagged(global_explanation(ws.model(key), ws.get("training_data")), key, run_id)

        def measured(ws: Workspace, key=key, source=predictions, measure=None) -> DataFrame:
            return E.tagged(measure(ws.get(source)), key, run_id)

        steps.append(Step(predictions, "table", scored, plannable=False))
        steps.append(Step(f"feature_importance_{key}", "table", importance, plannable=False))
        steps.append(Step(f"explanation_{key}", "table", explained, plannable=False))
        steps += [
            Step(f"{name}_{key}", "table", partial(measured, measure=measure), plannable=False)
            for name, measure in tables.items()
        ]
    return steps


def scoring_steps(cfg: Config, run_id: str) -> list[Step]:
    """Every row scored by every model, and its tier: what a daily run hands on, not only the TEST rows."""
    steps: list[Step] = []
    for key in cfg.ml_models:

        def scores(ws: Workspace, key=key) -> DataFrame:
            rows = batch_score(ws.model(key), ws.get("training_data"), model_kind(key).category)
            return E.tagged(rows, key, run_id)

        def risk(ws: Workspace, key=key) -> DataFrame:
            return E.ml_risk_view(ws.get(f"scores_{key}"))

        steps.append(Step(f"scores_{key}", "table", scores, plannable=False))
        steps.append(Step(f"ml_risk_{key}", "table", risk, plannable=False, shown=True))
    return steps


def serving_steps() -> list[Step]:
    """What dashboards read: stored, so that it outlives the session that made it."""

    def over(source: str, view):
        return lambda ws: view(ws.get(source), ws.get("counties_ref"))

    views = {
        "timeseries_view": over("outage_vs_weather", S.timeseries_view),
        "correlation_view": over("correlations", S.correlation_view),
        "risk_map_view": over("daily_plan", S.risk_map_view),
        "preboard_view": over("daily_plan", S.preboard_view),
        "events_view": over("event_coverage", S.events_view),
        "kpi_overview": lambda ws: S.kpi_overview(ws.get("preboard_view"), ws.get("events_view")),
        "correlation_heatmap": lambda ws: S.correlation_heatmap(ws.get("correlation_view"), ws.cfg.lead_hours),
    }
    return [Step(name, "table", build, shown=True) for name, build in views.items()]

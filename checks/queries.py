"""One runnable query per operator, over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stormledger.functions import weather as W
from stormledger.functions.geometry import to_wkt
from stormledger.operators import attribution as A
from stormledger.operators import evaluation as E
from stormledger.operators import models as M
from stormledger.operators import serving as S
from stormledger.operators.blocks import outage_6h_qc, six_hour_grid
from stormledger.operators.coverage import event_coverage, wx_lead_flags
from stormledger.operators.events import event_marks, outage_events
from stormledger.operators.master import outage_vs_weather
from stormledger.operators.plan import daily_plan, order_plan, six_hour_wind_hail_counts
from stormledger.operators.skill import correlations, lead_performance, threshold_sweep
from stormledger.operators.outlines import outline_pairs
from stormledger.operators.spatial import aoi_filter, cells_of, near_pairs
from stormledger.operators.thresholds import county_thresholds
from stormledger.operators.training import split_rows, training_data
from stormledger.operators.weather_features import (
    cell_features,
    read_weather_features,
    save_weather_features,
    weather_features,
)
from stormledger.plans.runs import recent_runs, run_phases, run_setup
from stormledger.sources.counties import counties_ref, outlines_from_wkt
from stormledger.sources.forecasts import explode_forecast, forecast_scan, in_init_times, save_forecasts
from stormledger.sources.outages import (
    load_outage_csv,
    outage_part,
    read_outage_lines,
    read_outage_part,
    save_outage_part,
    upsert_outage_raw,
)
from stormledger.schemas import BANDS, MODEL_FEATURES
from stormledger.storage import scratch_path, stored

from . import fixtures as FX

CFG = FX.CFG


def rounded(df: DataFrame, *names: str) -> DataFrame:
    """Means and ratios depend on summation order in the last digits."""
    return df.withColumns({n: F.round(F.col(n) + FX.NUDGE, 6) for n in names})


class Inputs:
    """Lazily planned inputs of one query; each intermediate is planned once."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._made: dict[str, DataFrame] = {}

    def _once(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        if name not in self._made:
            self._made[name] = make()
        return self._made[name]

    @property
    def raw(self) -> DataFrame:
        return self._once("raw", lambda: FX.outage_raw(self.spark, self.sf_dir))

    @property
    def readings(self) -> DataFrame:
        return outage_part(self.raw)

    @property
    def counties(self) -> DataFrame:
        return self._once(
            "counties", lambda: counties_ref(FX.counties(self.spark, self.sf_dir), FX.states(self.spark, self.sf_dir))
        )

    @property
    def forecasts(self) -> DataFrame:
        return self._once("forecasts", lambda: FX.forecasts(self.spark, self.sf_dir))

    @property
    def steps(self) -> DataFrame:
        return explode_forecast(self.forecasts.where(in_init_times(CFG)), CFG)

    @property
    def pairs(self) -> DataFrame:
        return near_pairs(cells_of(self.forecasts), self.counties, CFG)

    @property
    def weather(self) -> DataFrame:
        return self._once("weather", lambda: weather_features(self.forecasts, self.counties, CFG))

    @property
    def stored_weather(self) -> DataFrame:
        """Weather features materialised, as the pipeline does, for queries that read them twice."""
        return self._once("stored_weather", lambda: stored(self.weather, "weather"))

    @property
    def thresholds(self) -> DataFrame:
        """Stored, as the pipeline does, for queries that use them more than once."""
        return self._once("thresholds", lambda: stored(county_thresholds(self.stored_weather, CFG), "thresholds"))

    @property
    def blocks(self) -> DataFrame:
        return outage_6h_qc(self.readings, CFG)

    @property
    def grid(self) -> DataFrame:
        return six_hour_grid(self.counties, CFG)

    @property
    def master(self) -> DataFrame:
        return outage_vs_weather(self.grid, self._made.get("stored_weather", self.weather), self.blocks, CFG)

    @property
    def events(self) -> DataFrame:
        return outage_events(self.readings, CFG)

    @property
    def stored_events(self) -> DataFrame:
        return self._once("stored_events", lambda: stored(self.events, "events"))

    @property
    def flags(self) -> DataFrame:
        return wx_lead_flags(self.stored_weather, self.thresholds, CFG)

    @property
    def coverage(self) -> DataFrame:
        return event_coverage(self.stored_events, self.flags, CFG)

    @property
    def plan(self) -> DataFrame:
        return daily_plan(self.stored_weather, self.thresholds, CFG)

    @property
    def performance(self) -> DataFrame:
        thresholds = self.thresholds
        return lead_performance(self.master, thresholds, CFG)

    @property
    def correlations(self) -> DataFrame:
        return rounded(correlations(self.master, CFG), "r_ws10", "r_ws925", "r_shear", "r_updraft", "r_precip", "r_t700")

    @property
    def training(self) -> DataFrame:
        return training_data(self.master, CFG)

    @property
    def stored_training(self) -> DataFrame:
        return self._once("stored_training", lambda: stored(self.training, "training"))

    @property
    def fixed_scores(self) -> DataFrame:
        """A plain function of the wind in place of a model, so evaluation can be checked exactly."""
        score = F.least(F.lit(1.0), F.col("ws10_max_mps") / 60.0)
        return split_rows(self.training, "TEST").select(
            "county_fips", "valid_ts", "lead_hours",
            F.col("outage_ratio_6h_max").alias("actual_ratio"),
            score.alias("predicted_ratio"),
            F.col("outage_event").alias("actual_event"),
            (score >= 0.5).cast("bigint").alias("predicted_event"),
            score.alias("predicted_probability"),
        )

    def model(self, key: str):
        return M.model_kind(key).train(self.stored_training, CFG)

    @property
    def flagged(self) -> DataFrame:
        """Training rows whose only feature is a strong wind, 0 or 1: what is learned has a closed form."""
        return self._once("flagged", lambda: stored(one_flag(self.training), "flagged"))

    def flag_model(self, key: str):
        return M.model_kind(key).train(self.flagged, FX.FLAG_CFG)


def one_flag(training: DataFrame) -> DataFrame:
    strong = (F.col("ws10_max_mps") >= FX.STRONG_WIND).cast("bigint")
    nothing = {c: F.lit(None).cast(t) for c, t in training.dtypes if c in MODEL_FEATURES and c not in ("hail_flag", "lead_hours")}
    # The lead stays as a key under its own name, and is missing as a feature.
    return training.withColumns(nothing | {"hail_flag": strong, "lead_hours": F.lit(None).cast("bigint")})


def _csv(i: Inputs) -> DataFrame:
    path = scratch_path(i.spark, "outages_csv")
    fine = "yyyy-MM-dd HH:mm:ss.SSSSSS"
    i.raw.write.options(header=True, timestampNTZFormat=fine).csv(path)
    return load_outage_csv(i.spark, path)


def _upsert(i: Inputs) -> DataFrame:
    """Readings with other counts are loaded first, then the true ones, twice: only the latest stay, once each."""
    path = scratch_path(i.spark, "outage_raw")
    upsert_outage_raw(i.raw.withColumn("customers_out", F.col("customers_out") + 1_000), path)
    for _ in range(2):
        upsert_outage_raw(i.raw, path)
    return i.spark.read.parquet(path).select("fips_code", "run_start_time", "customers_out", "total_customers")


def _quarantine(i: Inputs) -> DataFrame:
    """Lines of every seventh count are spoilt, in a different way by the count's last digit, before they are read."""
    path, n = scratch_path(i.spark, "outage_lines"), F.col("customers_out")
    time = F.date_format("run_start_time", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    texts = {c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in i.raw.columns} | {"run_start_time": time}
    spoilt = F.when(n % 7 == 0, F.when(n % 2 == 0, F.lit("many")).otherwise(F.lit("1.5.2"))).otherwise(texts["customers_out"])
    lines = i.raw.select(*[(spoilt if c == "customers_out" else texts[c]).alias(c) for c in i.raw.columns])
    lines.write.options(header=True, emptyValue="").csv(path)
    good, bad = read_outage_lines(i.spark, path)
    kinds = good.groupBy("fips_code").agg(F.count(F.lit(1)).alias("n"), F.sum("customers_out").alias("customers_out")).withColumn("kind", F.lit("read"))
    held = bad.groupBy(F.split("line", ",")[0].cast("long").alias("fips_code")).agg(F.count(F.lit(1)).alias("n"))
    return kinds.unionByName(held.withColumns({"kind": F.lit("quarantined"), "customers_out": F.lit(0).cast("long")}))


def _counties(i: Inputs) -> DataFrame:
    """Outlines go out as text and come back from it."""
    text = stored(FX.counties(i.spark, i.sf_dir).withColumn("county_geom", to_wkt("county_geom")), "outlines")
    ref = counties_ref(outlines_from_wkt(text), FX.states(i.spark, i.sf_dir))
    return ref.withColumn("county_geom", to_wkt("county_geom"))


def _stored_outages(i: Inputs) -> DataFrame:
    path = scratch_path(i.spark, "outage_part")
    save_outage_part(i.readings, path)
    return rounded(read_outage_part(i.spark, path), "outage_ratio")


def _stored_forecasts(i: Inputs) -> DataFrame:
    path = scratch_path(i.spark, "forecasts")
    save_forecasts(i.forecasts, path, CFG)
    def total(band: str):
        return F.aggregate("forecast", F.lit(0.0), lambda a, step: a + step[band])

    sums = [total(band).alias(short) for short, band in BANDS.items()]
    scanned = forecast_scan(i.spark, path, CFG).select(
        "cell_id", "lon", "lat", "init_time", F.size("forecast").cast("bigint").alias("n_steps"), *sums
    )
    return rounded(scanned, *BANDS)


def _stored_weather(i: Inputs) -> DataFrame:
    path = scratch_path(i.spark, "weather_features")
    save_weather_features(i.weather, path)
    return rounded(read_weather_features(i.spark, path), "t700_c_mean", "t850_c_mean", "tp6_mm_mean")


def _unit_conversions(i: Inputs) -> DataFrame:
    rows = i.master.where(F.col("lead_hours").isNotNull())
    return rows.select(
        "county_fips", "valid_ts", "lead_hours",
        W.mps_to_mph(F.col("ws10_max_mps")).alias("ws10_mph"),
        W.mps_to_knots(F.col("ws10_max_mps")).alias("ws10_knots"),
        W.ratio_to_pct(F.col("outage_ratio_6h_max")).alias("outage_pct"),
    ).transform(rounded, "ws10_mph", "ws10_knots", "outage_pct")


def _heatmap(i: Inputs) -> DataFrame:
    return S.correlation_heatmap(S.correlation_view(i.correlations, i.counties), CFG.lead_hours)


def _pipeline_runs(i: Inputs) -> DataFrame:
    """Set up, run, resume after other readings, and count what is stored: phase, step, status and rows.

    The first run sees only part of the readings, so a resume that kept any table made from them would
    show in the counts.
    """
    root = scratch_path(i.spark, "pipeline")
    counties, states = FX.counties(i.spark, i.sf_dir), FX.states(i.spark, i.sf_dir)
    run_setup(i.spark, root, i.raw.where("customers_out % 2 = 0"), counties, states)
    run_phases(i.spark, CFG, root, i.forecasts, ["correlation"])
    run_setup(i.spark, root, i.raw, counties, states)
    run_phases(i.spark, CFG, root, i.forecasts, ["correlation", "ml-data", "serving"], resume=True)
    log = recent_runs(i.spark, root, 3).select("phase", F.explode(F.from_json("step_details", "array<struct<step: string, status: string>>")).alias("s"))
    tables = ["weather_features", "outage_6h_qc", "county_thresholds", "outage_events", "event_coverage", "daily_plan",
              "lead_performance", "correlations", "training_data"]
    counts = None
    for name in tables:
        one = i.spark.read.parquet(f"{root}/{name}").agg(F.lit(name).alias("step"), F.count(F.lit(1)).alias("n_rows"))
        counts = one if counts is None else counts.union(one)
    return log.select("phase", "s.*").join(counts, "step")


def _importance(i: Inputs, key: str) -> DataFrame:
    return E.tagged(E.feature_importance(i.model(key), i.stored_training), key, "check")


def _predict(i: Inputs, key: str) -> DataFrame:
    predict = E.predict_regression if M.model_kind(key).category == "regressor" else E.predict_classification
    return E.tagged(predict(i.model(key), i.stored_training), key, "check")


def _evaluated(i: Inputs, key: str) -> DataFrame:
    measure = E.evaluate_regression if M.model_kind(key).category == "regressor" else E.evaluate_classification
    return E.tagged(measure(_predict(i, key)), key, "check")


def _batch(i: Inputs, key: str) -> DataFrame:
    path = scratch_path(i.spark, "model")
    M.save_model(i.model(key), path)
    return M.batch_score(M.load_model(path), i.stored_training, M.model_kind(key).category)


def _flag_predictions(i: Inputs, key: str) -> DataFrame:
    """Predictions for TEST rows; an iterative fit's probability to three digits, as far as it converges."""
    if M.model_kind(key).category == "regressor":
        return E.predict_regression(i.flag_model(key), i.flagged)
    rows = E.predict_classification(i.flag_model(key), i.flagged)
    return rows.withColumn("predicted_probability", F.round("predicted_probability", 3))


def _flag_rows(i: Inputs, key: str) -> DataFrame:
    rows = _flag_predictions(i, key).drop("lead_hours")
    return rounded(rows, *[c for c in ("actual_ratio", "predicted_ratio") if c in rows.columns])


def _flag_metrics(i: Inputs, key: str) -> DataFrame:
    rows = stored(_flag_predictions(i, key), "flag_predictions")
    regressor = M.model_kind(key).category == "regressor"
    return _all_rounded((E.evaluate_regression if regressor else E.evaluate_classification)(rows))


def _flag_batch(i: Inputs) -> DataFrame:
    path = scratch_path(i.spark, "flag_model")
    M.save_model(i.flag_model("logistic"), path)
    rows = M.batch_score(M.load_model(path), i.flagged, "classifier")
    return rows.withColumn("predicted_probability", F.round("predicted_probability", 3))


def _flag_attributions(i: Inputs, key: str) -> DataFrame:
    rows = A.attributions(i.flag_model(key), i.flagged).withColumn("by_flag", F.col("attribution")[MODEL_FEATURES.index("hail_flag")])
    return rounded(rows.select("county_fips", "valid_ts", "raw_output", "base", "by_flag"), "raw_output", "base", "by_flag")


def _attribution_sums(i: Inputs) -> DataFrame:
    """What attributions and base leave of the prediction, over all features: nothing."""
    rows = A.attributions(i.model("regressor"), i.stored_training)
    left = F.col("raw_output") - F.col("base") - F.aggregate("attribution", F.lit(0.0), lambda a, v: a + v)
    return rows.select("county_fips", "valid_ts", F.col("lead_hours").cast("double").alias("lead_hours"), F.round(F.abs(left), 6).alias("unexplained"))


BUILDERS: dict[str, Callable[[Inputs], DataFrame]] = {
    # Sources and sinks.
    "load_outage_csv": _csv,
    "outage_upsert": _upsert,
    "outage_quarantine": _quarantine,
    "outage_part": _stored_outages,
    "counties_ref": _counties,
    "init_time_list": lambda i: i.forecasts.where(in_init_times(CFG))
    .groupBy("init_time")
    .agg(F.count(F.lit(1)).alias("forecast_rows")),
    "forecast_scan": _stored_forecasts,
    "explode_forecast": lambda i: i.steps,
    # Weather.
    "cell_features": lambda i: cell_features(i.steps, "cell_id"),
    "aoi_filter": lambda i: aoi_filter(cells_of(i.forecasts), i.pairs),
    "spatial_join": lambda i: i.pairs.select("cell_id", "county_fips"),
    "spatial_join_outlines": lambda i: outline_pairs(
        FX.tilted_cells(cells_of(i.forecasts)), FX.bent_counties(i.spark, i.sf_dir), CFG
    ).select("cell_id", "county_fips", "centre_near"),
    "weather_features": _stored_weather,
    "county_thresholds": lambda i: county_thresholds(i.weather, CFG),
    # Outages, and both together.
    "outage_6h_qc": lambda i: rounded(i.blocks, "outage_ratio_6h_mean"),
    "six_hour_grid": lambda i: i.grid,
    "outage_vs_weather": lambda i: rounded(
        i.master, "t700_c_mean", "t850_c_mean", "tp6_mm_mean", "outage_ratio_6h_mean"
    ),
    "event_marks": lambda i: event_marks(i.readings, CFG).withColumn("prev_outage_on", F.col("prev_outage_on").cast("string")),
    "outage_events": lambda i: i.events,
    "wx_lead_flags": lambda i: i.flags,
    "event_coverage": lambda i: i.coverage,
    "six_hour_wind_hail_counts": lambda i: six_hour_wind_hail_counts(i.stored_weather, i.thresholds, CFG),
    "daily_plan": lambda i: order_plan(i.plan),
    "lead_performance": lambda i: rounded(i.performance, "precision", "recall", "f1"),
    "correlations": lambda i: i.correlations,
    # Serving.
    "timeseries_view": lambda i: S.timeseries_view(i.master, i.counties),
    "correlation_view": lambda i: S.correlation_view(i.correlations, i.counties),
    "risk_map_view": lambda i: S.risk_map_view(i.plan, i.counties).withColumn("geom", to_wkt("geom")),
    "preboard_view": lambda i: S.preboard_view(i.plan, i.counties),
    "events_view": lambda i: S.latest_events(S.events_view(i.coverage, i.counties)),
    "kpi_overview": lambda i: rounded(S.kpi_overview(i.plan, i.coverage), "detection_rate"),
    "correlation_heatmap": _heatmap,
    "unit_conversions": _unit_conversions,
    # Evaluation arithmetic on a fixed score.
    "training_data": lambda i: rounded(i.training, "t850_c_mean"),
    "evaluate_regression": lambda i: _all_rounded(E.evaluate_regression(i.fixed_scores)),
    "evaluate_classification": lambda i: _all_rounded(E.evaluate_classification(stored(i.fixed_scores, "scores"))),
    "confusion_matrix": lambda i: E.confusion_matrix(i.fixed_scores),
    "roc_curve": lambda i: rounded(E.roc_curve(i.fixed_scores), "recall", "false_positive_rate"),
    "roc_points": lambda i: rounded(E.roc_points(i.fixed_scores), "threshold", "recall", "false_positive_rate"),
    "threshold_sweep": lambda i: rounded(threshold_sweep(i.fixed_scores), "precision", "recall", "f1"),
    # Learned models: no SQL equivalent.
    "train_regressor": lambda i: _evaluated(i, "regressor"),
    "train_classifier": lambda i: _evaluated(i, "classifier"),
    "train_logistic": lambda i: _evaluated(i, "logistic"),
    "model_search": lambda i: _evaluated(i, "automl"),
    "feature_importance": lambda i: _importance(i, "regressor"),
    "predict_regression": lambda i: _predict(i, "regressor"),
    "predict_classification": lambda i: _predict(i, "logistic"),
    "batch_score": lambda i: _batch(i, "logistic"),
    "ml_risk_view": lambda i: E.ml_risk_view(_batch(i, "logistic")),
    "global_explanation": lambda i: A.global_explanation(i.model("regressor"), i.stored_training),
    "attribution_sums": _attribution_sums,
    # Learned from one 0/1 feature, where class rates, means and the boosting recurrence are closed forms.
    "train_regressor_flag": lambda i: _flag_metrics(i, "regressor"),
    "train_classifier_flag": lambda i: _flag_metrics(i, "classifier"),
    "train_logistic_flag": lambda i: _flag_metrics(i, "logistic"),
    "model_search_flag": lambda i: _flag_metrics(i, "automl"),
    "predict_regression_flag": lambda i: _flag_rows(i, "regressor"),
    "predict_classification_flag": lambda i: _flag_rows(i, "classifier"),
    "batch_score_flag": lambda i: _flag_batch(i).select(
        "county_fips", "valid_ts", "hail_flag", "outage_event", "data_split", "predicted_event", "predicted_probability"
    ),
    "ml_risk_view_flag": lambda i: E.ml_risk_view(_flag_batch(i)),
    "feature_importance_flag": lambda i: rounded(E.feature_importance(i.flag_model("regressor"), i.flagged), "attribution"),
    "attribution_flag": lambda i: _flag_attributions(i, "regressor"),
    # Runs.
    "pipeline_runs": _pipeline_runs,
}


def _all_rounded(df: DataFrame) -> DataFrame:
    return rounded(df, *df.columns)


def compared(name: str, df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.col(c).cast(t) for c, t in FX.COMPARED_AS.get(name, {}).items()})


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(name: str, build: Callable[[Inputs], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, sf_dir: compared(name, build(Inputs(spark, sf_dir)))

    return {name: bind(name, build) for name, build in BUILDERS.items()}

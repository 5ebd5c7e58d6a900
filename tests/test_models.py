"""Learners on data with a planted signal, and the arithmetic of their evaluation."""

import math
import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from stormledger.operators import evaluation as E
from stormledger.operators import models as M
from stormledger.schemas import MODEL_FEATURES

from .helpers import DAY, config

SCHEMA = (
    "county_fips string, valid_ts timestamp_ntz, "
    + ", ".join(f"{f} {'bigint' if f in ('hail_flag', 'lead_hours', 'hour_of_day', 'day_of_week', 'month') else 'double'}" for f in MODEL_FEATURES)
    + ", outage_ratio_6h_max double, outage_event bigint, data_split string"
)
CFG = dict(ml_max_iterations=5, ml_models=("regressor", "classifier", "logistic", "automl"))


@pytest.fixture(scope="module")
def data(spark):
    """Strong wind raises the outage ratio; some updrafts are missing."""
    rng = random.Random(1)
    rows = []
    for k in range(600):
        wind = rng.uniform(0, 30)
        ratio = min(1.0, max(0.0, (wind - 18) / 20 + rng.gauss(0, 0.05)))
        values = {f: rng.random() for f in MODEL_FEATURES} | {
            "ws10_max_mps": wind, "wind_squared": wind * wind, "hail_flag": k % 2, "lead_hours": 24, "hour_of_day": 6,
            "day_of_week": 1 + k % 7, "month": 3, "updraft700_pos_max_pas": None if k % 10 == 0 else rng.random(),
        }
        rows.append(("01001", DAY + timedelta(hours=6 * k), *[values[f] for f in MODEL_FEATURES],
                     None if k % 50 == 0 else ratio, int(ratio >= 0.05), "TEST" if k % 5 == 0 else "TRAIN"))
    df = spark.createDataFrame(rows, SCHEMA).repartition(4).cache()
    df.count()
    yield df
    df.unpersist()


def test_regressor_finds_the_signal(data):
    model = M.train_regressor(data, config(**CFG))
    predictions = E.predict_regression(model, data)
    assert predictions.columns == ["county_fips", "valid_ts", "lead_hours", "actual_ratio", "predicted_ratio", "predicted_tier"]
    assert predictions.count() == 120
    scores = E.evaluate_regression(predictions).first()
    assert scores.r2_score > 0.5 and scores.mean_absolute_error < 0.1
    top = E.feature_importance(model, data).first()
    assert top.feature in ("ws10_max_mps", "wind_squared")


@pytest.mark.parametrize("key", ["classifier", "logistic", "automl"])
def test_classifiers_find_the_signal_and_repeat(data, key):
    cfg = config(**CFG)
    predictions = E.predict_classification(M.model_kind(key).train(data, cfg), data).cache()
    scores = E.evaluate_classification(predictions).first()
    assert scores.roc_auc > 0.9 and scores.recall > 0.7
    matrix = {r.expected_label: (r._0, r._1) for r in E.confusion_matrix(predictions).collect()}
    assert sum(sum(v) for v in matrix.values()) == 120
    assert scores.recall == matrix[1][1] / sum(matrix[1])
    curve = E.roc_curve(predictions).collect()
    assert len(curve) == 101 and curve[0].recall == 1.0
    assert all(a.recall >= b.recall and a.false_positive_rate >= b.false_positive_rate for a, b in zip(curve, curve[1:]))
    if key != "automl":
        again = E.predict_classification(M.model_kind(key).train(data, cfg), data)
        assert predictions.exceptAll(again).count() == 0


def test_feature_without_values_is_left_out(data):
    empty = data.withColumn("updraft700_pos_max_pas", F.lit(None).cast("double"))
    model = M.train_logistic(empty, config(**CFG))
    assert E.evaluate_classification(E.predict_classification(model, empty)).first().roc_auc > 0.9
    weights = {r.feature: r.attribution for r in E.feature_importance(model, empty).collect()}
    assert len(weights) == 15 and weights["updraft700_pos_max_pas"] == 0.0 and weights["ws10_max_mps"] > 0


def test_balanced_weights_use_training_rows(data):
    weighted = M.balanced_weights(data).where("data_split = 'TRAIN'")
    sums = {r.outage_event: r.s for r in weighted.groupBy("outage_event").agg(F.sum("weight").alias("s")).collect()}
    assert sums[0] == pytest.approx(sums[1]) == pytest.approx(240)


def test_save_load_and_batch_score(data, tmp_path):
    model = M.train_logistic(data, config(**CFG))
    M.save_model(model, str(tmp_path / "m"))
    scored = M.batch_score(M.load_model(str(tmp_path / "m")), data, "classifier")
    assert scored.count() == 600 and set(data.columns) < set(scored.columns)
    assert dict(scored.dtypes)["lead_hours"] == "bigint"
    tiers = E.ml_risk_view(scored)
    assert {r.ml_risk_tier for r in tiers.select("ml_risk_tier").distinct().collect()} <= {"HIGH", "MEDIUM", "LOW"}


def test_unknown_model():
    with pytest.raises(ValueError, match="unknown model"):
        M.model_kind("oracle")


def predictions(spark, data):
    rows = [(y, p, int(p is not None and p >= 0.5)) for y, p in data]
    return spark.createDataFrame(rows, "actual_event bigint, predicted_probability double, predicted_event bigint")


def test_classification_arithmetic(spark):
    data = [(1, 0.9), (1, 0.4), (0, 0.4), (0, 0.6), (0, 0.1), (1, 1.0)]
    r = E.evaluate_classification(predictions(spark, data)).first()
    assert (r.precision, r.recall, r.accuracy) == (2 / 3, 2 / 3, 4 / 6)
    loss = -sum(math.log(p if y else 1 - p) for y, p in data if p < 1) / 6
    assert r.log_loss == pytest.approx(loss)
    pairs = [(a > b) + (a == b) / 2 for y, a in data if y for z, b in data if not z]
    assert r.roc_auc == pytest.approx(sum(pairs) / len(pairs))


def test_one_class_has_no_auc(spark):
    r = E.evaluate_classification(predictions(spark, [(1, 0.9), (1, 0.2)])).first()
    assert r.roc_auc is None and r.recall == 0.5


def test_roc_is_exact_at_cutoffs(spark):
    """Scores equal to a cutoff count as passing it, also where score * 100 rounds below."""
    data = [(k % 2, k / 100) for k in range(101)] + [(1, 0.29), (0, 0.57), (1, 0.58)]
    for r in E.roc_curve(predictions(spark, data)).collect():
        assert r.true_positives == sum(y == 1 and p >= r.threshold for y, p in data), r.threshold
        assert r.false_positives == sum(y == 0 and p >= r.threshold for y, p in data), r.threshold


def test_roc_points_are_exact_at_every_score(spark):
    data = [(k % 3 == 0, (k * 37 % 101) / 101) for k in range(300)] + [(1, None), (0, None), (1, 0.5)]
    data = [(int(y), p) for y, p in data]
    got = {r.threshold: r for r in E.roc_points(predictions(spark, data).repartition(5)).collect()}
    scored = [(y, p) for y, p in data if p is not None]
    assert set(got) == {p for _, p in scored}
    for t, r in got.items():
        tp, fp = (sum(y == v and p >= t for y, p in scored) for v in (1, 0))
        n_pos = sum(y for y, _ in data)
        assert (r.true_positives, r.false_positives, r.false_negatives, r.true_negatives) == (tp, fp, n_pos - tp, len(data) - n_pos - fp)
        assert r.recall == tp / n_pos
    assert E.roc_points(predictions(spark, data[:1]).where("1 = 0")).count() == 0


def test_single_class_training(data):
    none = data.withColumn("outage_event", F.lit(0).cast("bigint"))
    for key in ("logistic", "classifier"):
        got = E.predict_classification(M.model_kind(key).train(none, config(**CFG)), none)
        assert got.where("predicted_event = 1").count() == 0

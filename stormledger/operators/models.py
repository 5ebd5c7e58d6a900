"""Outage models with MLlib, trained on TRAIN rows with TEST rows as validation data."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import Imputer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import Config
from ..schemas import MODEL_FEATURES
from ..storage import shared_dir

SEED = 42
TREE_DEPTH = 6
VALUES = [f"{name}_value" for name in MODEL_FEATURES]


def _fit_features(train: DataFrame) -> PipelineModel:
    """Spark's trees take no missing values, so those become the column mean. A column without any
    value has no mean and is left out of the model."""
    filled = train.agg(*[F.count(c).alias(c) for c in VALUES]).first()
    usable = [c for c in VALUES if filled[c]]
    if not usable:
        raise ValueError("no training row has any feature")
    names = [f"{c}_filled" for c in usable]
    return Pipeline(stages=[
        Imputer(strategy="mean", inputCols=usable, outputCols=names),
        VectorAssembler(inputCols=names, outputCol="features", handleInvalid="keep"),
    ]).fit(train)


def feature_inputs(model: PipelineModel) -> dict[str, str]:
    """The model's features in the order of its vector, with the column that feeds each."""
    return {c.removesuffix("_value_filled"): c for c in model.stages[-2].getInputCols()}


def balanced_weights(data: DataFrame) -> DataFrame:
    """Weight each class by n / (2 * its count), over the training rows alone."""
    counts = (
        data.where("data_split = 'TRAIN'").groupBy("outage_event").agg(F.count(F.lit(1)).alias("n_class"))
    )
    # One row per label value, of which there are two.
    total = dict((row["outage_event"], row["n_class"]) for row in counts.collect())
    n = sum(total.values())
    weight = F.lit(1.0)
    for label, size in total.items():
        weight = F.when(F.col("outage_event") == label, F.lit(n / (2.0 * size))).otherwise(weight)
    return data.withColumn("weight", weight)


def _prepared(data: DataFrame) -> DataFrame:
    """Validation marks, and the features as doubles beside the columns themselves."""
    numeric = {value: F.col(name).cast("double") for name, value in zip(MODEL_FEATURES, VALUES)}
    return data.withColumns(numeric).withColumn("validation", F.col("data_split") == "TEST")


def _fit(data: DataFrame, learner, validated: bool) -> PipelineModel:
    """Fit imputation on TRAIN rows, then the learner. Rows persist while it iterates over them."""
    shared_dir(data.sparkSession)
    rows = data if validated else data.where("data_split = 'TRAIN'")
    owned = not rows.is_cached
    if owned:
        rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        features = _fit_features(rows.where("data_split = 'TRAIN'"))
        fitted = learner.fit(features.transform(rows))
        return PipelineModel(stages=[*features.stages, fitted])
    finally:
        if owned:
            rows.unpersist()


def _tree_options(cfg: Config) -> dict:
    return dict(
        maxIter=cfg.ml_max_iterations,
        stepSize=cfg.ml_learn_rate,
        minInstancesPerNode=cfg.ml_min_tree_child_weight,
        subsamplingRate=cfg.ml_subsample,
        maxDepth=TREE_DEPTH,
        validationIndicatorCol="validation",
        featuresCol="features",
        seed=SEED,
    )


def train_regressor(data: DataFrame, cfg: Config) -> PipelineModel:
    """Boosted trees on the outage ratio; blocks without one cannot teach it."""
    known = _prepared(data.where(F.col("outage_ratio_6h_max").isNotNull()))
    return _fit(known, GBTRegressor(labelCol="outage_ratio_6h_max", **_tree_options(cfg)), True)


def train_classifier(data: DataFrame, cfg: Config) -> PipelineModel:
    """Boosted trees on the outage label with balanced class weights."""
    rows = _prepared(balanced_weights(data))
    return _fit(rows, GBTClassifier(labelCol="outage_event", weightCol="weight", **_tree_options(cfg)), True)


def _logistic(cfg: Config) -> LogisticRegression:
    return LogisticRegression(
        labelCol="outage_event", weightCol="weight", featuresCol="features", maxIter=cfg.ml_max_iterations
    )


def train_logistic(data: DataFrame, cfg: Config) -> PipelineModel:
    """Logistic regression with balanced class weights."""
    return _fit(_prepared(balanced_weights(data)), _logistic(cfg), False)


def model_search(data: DataFrame, cfg: Config) -> PipelineModel:
    """Best of the configured families by ROC AUC on the validation rows; the first of equal ones."""
    rows = _prepared(balanced_weights(data)).persist(StorageLevel.MEMORY_AND_DISK)
    families = {
        "logistic": (_logistic(cfg), False),
        "forest": (
            RandomForestClassifier(
                labelCol="outage_event", weightCol="weight", featuresCol="features",
                maxDepth=TREE_DEPTH, minInstancesPerNode=cfg.ml_min_tree_child_weight, seed=SEED,
            ),
            False,
        ),
        "boosted": (GBTClassifier(labelCol="outage_event", weightCol="weight", **_tree_options(cfg)), True),
    }
    score = BinaryClassificationEvaluator(labelCol="outage_event", metricName="areaUnderROC", numBins=0)
    try:
        held_out = rows.where("validation")
        best, best_auc = None, float("-inf")
        for learner, validated in (families[name] for name in cfg.automl_families):
            model = _fit(rows, learner, validated)
            auc = score.evaluate(model.transform(held_out))
            if best is None or auc > best_auc:
                best, best_auc = model, auc
        return best
    finally:
        rows.unpersist()


@dataclass(frozen=True)
class ModelKind:
    category: str
    train: Callable[[DataFrame, Config], PipelineModel]


REGISTRY = {
    "regressor": ModelKind("regressor", train_regressor),
    "classifier": ModelKind("classifier", train_classifier),
    "logistic": ModelKind("classifier", train_logistic),
    "automl": ModelKind("classifier", model_search),
}


def model_kind(key: str) -> ModelKind:
    if key not in REGISTRY:
        raise ValueError(f"unknown model {key!r}; valid: {', '.join(REGISTRY)}")
    return REGISTRY[key]


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def scored(model: PipelineModel, data: DataFrame) -> DataFrame:
    return model.transform(_prepared(data))


def batch_score(model: PipelineModel, data: DataFrame, category: str) -> DataFrame:
    """Score every row of a table and keep its columns."""
    extra: dict[str, Column] = (
        {"predicted_ratio": F.col("prediction")}
        if category == "regressor"
        else {"predicted_event": F.col("prediction").cast("bigint"), "predicted_probability": positive_probability()}
    )
    return scored(model, data).select(*data.columns, *[e.alias(n) for n, e in extra.items()])


def positive_probability() -> Column:
    return vector_to_array(F.col("probability"))[1]

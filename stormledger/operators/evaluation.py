"""Model evaluation as aggregates over predictions."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.flags import probability_tier, severity_tier
from ..functions.scores import safe_ratio
from ..schemas import MODEL_FEATURES
from ..storage import stored
from .models import feature_inputs, positive_probability, scored
from .training import split_rows

ROC_STEPS = 100
# Rank error, as a part of all rows, of the sketch that brackets the median.
BRACKET = 1_000
SMALLEST_PROBABILITY = 1e-15


def tagged(rows: DataFrame, model_type: str, run_id: str) -> DataFrame:
    """Name the model and run on every evaluation row."""
    return rows.withColumns({"model_type": F.lit(model_type), "run_id": F.lit(run_id)})


def predict_regression(model: PipelineModel, data: DataFrame) -> DataFrame:
    """Actual and predicted ratio with a severity tier, for TEST rows."""
    return scored(model, split_rows(data, "TEST")).select(
        "county_fips",
        "valid_ts",
        "lead_hours",
        F.col("outage_ratio_6h_max").alias("actual_ratio"),
        F.col("prediction").alias("predicted_ratio"),
        severity_tier(F.col("prediction")).alias("predicted_tier"),
    )


def predict_classification(model: PipelineModel, data: DataFrame) -> DataFrame:
    """Actual and predicted event, its probability and tier, for TEST rows.

    The tier applies the ratio cutoffs to the probability.
    """
    probability = positive_probability()
    return scored(model, split_rows(data, "TEST")).select(
        "county_fips",
        "valid_ts",
        "lead_hours",
        F.col("outage_event").alias("actual_event"),
        F.col("prediction").cast("bigint").alias("predicted_event"),
        probability.alias("predicted_probability"),
        severity_tier(probability).alias("predicted_tier"),
    )


def exact_median(rows: DataFrame, column: str) -> float | None:
    """The smallest value with at least half of the rows at or below it; None without rows.

    A mergeable sketch gives two values that surely enclose it. Rows below are counted, and only the
    few between are ordered.
    """
    rows = rows.where(F.col(column).isNotNull()).select(column)
    low, high, n = rows.agg(
        F.percentile_approx(column, 0.5 - 2 / BRACKET, BRACKET), F.percentile_approx(column, 0.5 + 2 / BRACKET, BRACKET), F.count(F.lit(1))
    ).first()
    if not n:
        return None
    below = rows.where(F.col(column) < low).count()
    between = rows.where(F.col(column).between(low, high))
    return between.orderBy(column).offset((n + 1) // 2 - below - 1).limit(1).first()[0]


def evaluate_regression(predictions: DataFrame) -> DataFrame:
    """Errors, R2 and explained variance in one pass, and the median error in two more."""
    p, y = F.col("predicted_ratio"), F.col("actual_ratio")
    error = y - p
    log_error = F.when((p > -1) & (y > -1), F.log1p(p) - F.log1p(y))
    known = predictions.where(y.isNotNull() & p.isNotNull())
    median = exact_median(known.select(F.abs(error).alias("error")), "error")
    sums = known.agg(
        F.avg(F.abs(error)).alias("mean_absolute_error"),
        F.avg(error * error).alias("mean_squared_error"),
        F.avg(log_error * log_error).alias("mean_squared_log_error"),
        F.lit(median).cast("double").alias("median_absolute_error"),
        F.var_pop(y).alias("spread"),
        F.var_pop(error).alias("error_spread"),
    )
    return sums.select(
        "mean_absolute_error",
        "mean_squared_error",
        "mean_squared_log_error",
        "median_absolute_error",
        (1 - F.try_divide(F.col("mean_squared_error"), F.col("spread"))).alias("r2_score"),
        (1 - F.try_divide(F.col("error_spread"), F.col("spread"))).alias("explained_variance"),
    )


def roc_auc(predictions: DataFrame) -> float | None:
    """Exact area under the ROC curve; None unless both classes occur.

    Spark's evaluator sorts scores across partitions and adds up their trapezoids.
    """
    rows = predictions.select(
        F.col("predicted_probability").alias("rawPrediction"), F.col("actual_event").cast("double").alias("label")
    )
    low, high = rows.agg(F.min("label"), F.max("label")).first()
    if low is None or low == high:
        return None
    return BinaryClassificationEvaluator(metricName="areaUnderROC", numBins=0).evaluate(rows)


def evaluate_classification(predictions: DataFrame) -> DataFrame:
    """Precision, recall, accuracy, F1, log loss and ROC AUC."""
    truth, flag = F.col("actual_event") == 1, F.col("predicted_event") == 1
    # Certain answers are kept off 0 and 1, where the logarithm is unbounded.
    p = F.greatest(
        F.lit(SMALLEST_PROBABILITY), F.least(F.lit(1 - SMALLEST_PROBABILITY), F.col("predicted_probability"))
    )
    counts = predictions.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(flag & truth).alias("tp"),
        F.count_if(flag & ~truth).alias("fp"),
        F.count_if(~flag & truth).alias("fn"),
        F.count_if(flag == truth).alias("right"),
        F.avg(-F.when(truth, F.log(p)).otherwise(F.log(1 - p))).alias("log_loss"),
    )
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return counts.select(
        safe_ratio(tp, tp + fp).alias("precision"),
        safe_ratio(tp, tp + fn).alias("recall"),
        safe_ratio(F.col("right"), F.col("n")).alias("accuracy"),
        safe_ratio(2 * tp, 2 * tp + fp + fn).alias("f1_score"),
        "log_loss",
        F.lit(roc_auc(predictions)).cast("double").alias("roc_auc"),
    )


def confusion_matrix(predictions: DataFrame) -> DataFrame:
    """Counts by actual label (rows) and predicted label (columns)."""
    return (
        predictions.groupBy(F.col("actual_event").alias("expected_label"))
        .agg(
            F.count_if(F.col("predicted_event") == 0).alias("_0"),
            F.count_if(F.col("predicted_event") == 1).alias("_1"),
        )
        .orderBy("expected_label")
    )


def roc_curve(predictions: DataFrame, steps: int = ROC_STEPS) -> DataFrame:
    """Counts and rates at evenly spaced cutoffs from 0 to 1, exact at each.

    A score falls in the step at or below it, so the shuffle carries at most `steps + 1` groups.
    Each group then adds itself to the cutoffs it passes, again a small result.
    """
    score = F.col("predicted_probability")
    guess = F.floor(score * steps)
    # The product may round across a cutoff, so the step is settled against the cutoffs themselves.
    step = (
        F.when((guess + 1) / steps <= score, guess + 1).when(guess / steps > score, guess - 1).otherwise(guess)
    )
    per_step = (
        predictions.groupBy(step.alias("step"))
        .agg(
            F.count_if(F.col("actual_event") == 1).alias("pos"),
            F.count_if(F.col("actual_event") == 0).alias("neg"),
        )
    )
    cutoffs = F.sequence(F.lit(0), F.lit(steps))
    passed = (
        per_step.select("step", "pos", "neg", F.explode(cutoffs).alias("cut"))
        .groupBy("cut")
        .agg(
            F.sum(F.when(F.col("step") >= F.col("cut"), F.col("pos")).otherwise(0)).alias("true_positives"),
            F.sum(F.when(F.col("step") >= F.col("cut"), F.col("neg")).otherwise(0)).alias("false_positives"),
            F.sum("pos").alias("positives"),
            F.sum("neg").alias("negatives"),
        )
    )
    return passed.select(
        (F.col("cut") / steps).alias("threshold"),
        safe_ratio(F.col("true_positives"), F.col("positives")).alias("recall"),
        safe_ratio(F.col("false_positives"), F.col("negatives")).alias("false_positive_rate"),
        "true_positives",
        "false_positives",
        (F.col("negatives") - F.col("false_positives")).alias("true_negatives"),
        (F.col("positives") - F.col("true_positives")).alias("false_negatives"),
    ).orderBy("threshold")


def roc_points(predictions: DataFrame) -> DataFrame:
    """Counts and rates at every score that occurs, exact, however many there are.

    A score's counts are prefix sums over all scores above it. Scores are counted, then dealt in ranges
    over tasks; each range's totals, a row per range, give what stands above it, and within a range
    counts are summed up in order. Rows without a score pass no threshold but count as what they are.
    """
    counted = predictions.groupBy(F.col("predicted_probability").alias("threshold")).agg(
        F.count_if(F.col("actual_event") == 1).alias("pos"), F.count_if(F.col("actual_event") == 0).alias("neg")
    )
    ranged = counted.repartitionByRange(F.desc("threshold")).withColumn("part", F.spark_partition_id())
    # Stored, as the ranges are not the same when they are made again.
    rows = stored(ranged, "roc_counts")
    parts = stored(rows.groupBy("part").agg(F.sum(F.when(F.col("threshold").isNotNull(), F.col("pos"))).alias("pos"),
                                            F.sum(F.when(F.col("threshold").isNotNull(), F.col("neg"))).alias("neg")), "roc_ranges")
    ranges = parts.agg(F.array_sort(F.collect_list(F.struct("part", "pos", "neg"))).alias("all"))

    def earlier(name: str):
        before = F.filter("all", lambda q: q["part"] < F.col("one.part"))
        return F.aggregate(before, F.lit(0).cast("long"), lambda a, q: a + F.coalesce(q[name], F.lit(0)))

    above = ranges.select("all", F.explode("all").alias("one")).select(
        F.col("one.part").alias("part"), earlier("pos").alias("pos_above"), earlier("neg").alias("neg_above")
    )
    positives, negatives = rows.agg(F.coalesce(F.sum("pos"), F.lit(0)), F.coalesce(F.sum("neg"), F.lit(0))).first()
    upto = Window.partitionBy("part").orderBy(F.desc("threshold")).rowsBetween(Window.unboundedPreceding, 0)
    summed = rows.where("threshold is not null").select("part", "threshold", F.sum("pos").over(upto).alias("pos"), F.sum("neg").over(upto).alias("neg"))
    tp, fp = F.col("pos") + F.col("pos_above"), F.col("neg") + F.col("neg_above")
    return summed.join(above, "part").select(
        "threshold",
        safe_ratio(tp, F.lit(positives)).alias("recall"),
        safe_ratio(fp, F.lit(negatives)).alias("false_positive_rate"),
        tp.alias("true_positives"),
        fp.alias("false_positives"),
        (F.lit(negatives) - fp).alias("true_negatives"),
        (F.lit(positives) - tp).alias("false_negatives"),
    )


def feature_importance(model: PipelineModel, data: DataFrame) -> DataFrame:
    """How much each feature weighs: gain for trees, standardised coefficient size otherwise.
    A feature the model could not use weighs nothing."""
    learner, inputs = model.stages[-1], feature_inputs(model)
    if hasattr(learner, "featureImportances"):
        values = [float(v) for v in learner.featureImportances.toArray()]
    else:
        train = scored(model, split_rows(data, "TRAIN"))
        spread = train.agg(*[F.stddev_pop(c) for c in inputs.values()]).first()
        values = [abs(float(w)) * float(s or 0.0) for w, s in zip(learner.coefficients.toArray(), spread)]
    weights = dict(zip(inputs, values))
    return data.sparkSession.createDataFrame(
        [(name, weights.get(name, 0.0)) for name in MODEL_FEATURES], "feature string, attribution double"
    ).orderBy(F.desc("attribution"), "feature")


def ml_risk_view(rows: DataFrame) -> DataFrame:
    """Tier of each scored row, by probability or by predicted ratio, whichever it has."""
    if "predicted_probability" in rows.columns:
        return rows.select(
            "county_fips",
            "valid_ts",
            F.col("predicted_probability").alias("outage_probability"),
            probability_tier(F.col("predicted_probability")).alias("ml_risk_tier"),
        )
    return rows.select(
        "county_fips",
        "valid_ts",
        "predicted_ratio",
        severity_tier(F.col("predicted_ratio")).alias("ml_risk_tier"),
    )

"""What each feature adds to each prediction, as exact Shapley values of the fitted model.

A tree's prediction is a sum over leaves, and a leaf's path asks a few features to lie in intervals. With a set
of features known, a leaf counts by the product of 1 or 0 for each known feature and of the share of training
weight that takes the path's way for each unknown one. The Shapley value of one factor of such a product
is an integral over [0, 1] of a polynomial with a degree below the number of factors, which a few
Gauss-Legendre nodes give exactly. So a row costs leaves times depth, not two to the number of features.

A linear model's values are coefficient times distance from the training mean.

Attributions and the base add up to the raw output: the ratio of a regressor, the margin of boosted and
logistic classifiers, the probability of a forest.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import MODEL_FEATURES
from .models import feature_inputs, scored
from .training import split_rows

# Task code travels with the job: executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

KEYS = ["county_fips", "valid_ts", "lead_hours"]
# Numbers one block of rows may hold at a time in a task.
CELLS = 2_000_000


@dataclass(frozen=True)
class Paths:
    """Every leaf as up to `depth` conditions low < x <= high on one feature each.

    `share` is the part of the training weight that follows the conditions of that feature; places without
    a condition have a share of 1 and hold for every value. Its size is that of the model.
    """

    value: np.ndarray
    feature: np.ndarray
    low: np.ndarray
    high: np.ndarray
    share: np.ndarray

    @property
    def base(self) -> float:
        return float((self.value * self.share.prod(axis=1)).sum())


def _leaves(root, leaf_value):
    """Value and conditions {feature: (low, high, share)} of every leaf under a node of a fitted tree."""
    open_nodes = [(root, {})]
    while open_nodes:
        node, path = open_nodes.pop()
        if not node.subtreeDepth():
            yield leaf_value(node), path
            continue
        split, weight = node.split(), node.impurityStats().count()
        name, cut = split.featureIndex(), split.threshold()
        low, high, share = path.get(name, (-np.inf, np.inf, 1.0))
        left, right = node.leftChild(), node.rightChild()
        part = left.impurityStats().count() / weight
        open_nodes.append((left, path | {name: (low, min(high, cut), share * part)}))
        open_nodes.append((right, path | {name: (max(low, cut), high, share * (1.0 - part))}))


def tree_paths(learner) -> Paths:
    """The leaves of all trees of a fitted ensemble, weighted as the ensemble adds them."""
    forest = "RandomForest" in type(learner).__name__

    def leaf_value(node) -> float:
        if not forest:
            return node.prediction()
        stats = list(node.impurityStats().stats())
        return stats[1] / sum(stats) if sum(stats) else 0.0

    found = []
    for tree, weight in zip(learner.trees, learner.treeWeights):
        scale = 1.0 / learner.getNumTrees if forest else weight
        found += [(scale * value, path) for value, path in _leaves(tree._java_obj.rootNode(), leaf_value)]
    depth = max([len(path) for _, path in found] + [1])
    filled = [list(path.items()) + [(0, (-np.inf, np.inf, 1.0))] * (depth - len(path)) for _, path in found]
    part = lambda k: np.array([[c[1][k] for c in path] for path in filled], float)
    names = np.array([[c[0] for c in path] for path in filled], np.int64)
    return Paths(np.array([v for v, _ in found], float), names, part(0), part(1), part(2))


def shapley(paths: Paths, x: np.ndarray) -> np.ndarray:
    """Attributions of rows (n, features), exact for the game of the module docstring."""
    n_leaves, depth = paths.feature.shape
    nodes, weights = np.polynomial.legendre.leggauss((depth + 1) // 2)
    nodes, weights = (nodes + 1.0) / 2.0, weights / 2.0
    # Deals what a place of a path adds to its feature.
    deal = np.zeros((n_leaves * depth, x.shape[1]))
    deal[np.arange(n_leaves * depth), paths.feature.ravel()] = 1.0
    out = np.zeros_like(x, dtype=float)
    step = max(1, CELLS // (n_leaves * depth))
    for at in range(0, len(x), step):
        values = x[at:at + step][:, paths.feature]
        holds = ((values > paths.low) & (values <= paths.high)) | ((paths.low == -np.inf) & (paths.high == np.inf))
        # Shares are above 0 and nodes inside (0, 1), so that no factor is 0 and each can be divided out.
        inner = np.zeros(holds.shape)
        for t, w in zip(nodes, weights):
            factor = paths.share * (1.0 - t) + holds * t
            inner += w * factor.prod(axis=2, keepdims=True) / factor
        added = paths.value[:, None] * (holds - paths.share) * inner
        out[at:at + step] = added.reshape(len(values), -1) @ deal
    return out


def _raw_output(learner) -> Column:
    name = type(learner).__name__
    if name == "RandomForestClassificationModel":
        return vector_to_array(F.col("probability"))[1]
    return vector_to_array(F.col("rawPrediction"))[1] if "Classif" in name or "Logistic" in name else F.col("prediction")


def attributions(model: PipelineModel, data: DataFrame, split: str = "TEST") -> DataFrame:
    """Keys, `base`, `raw_output` of the model and an array `attribution` in the order of `MODEL_FEATURES`.

    One row per row of the split, repeated rows included. Missing features count as the training mean they
    are replaced by; a feature the model could not use adds 0. Without rows the result is empty.
    """
    learner, inputs = model.stages[-1], feature_inputs(model)
    place = {name: k for k, name in enumerate(inputs)}
    rows = scored(model, split_rows(data, split))
    if hasattr(learner, "trees"):
        paths = tree_paths(learner)
        wide = rows.select(*KEYS, _raw_output(learner).alias("raw_output"), vector_to_array(F.col("features")).alias("x"))
        order = [place.get(name, -1) for name in MODEL_FEATURES]

        def explain(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                if len(batch):
                    added = shapley(paths, np.stack(batch.pop("x").to_numpy()))
                    added = np.hstack([added, np.zeros((len(added), 1))])[:, order]
                    yield batch.assign(attribution=list(added))

        schema = wide.drop("x").schema.add("attribution", T.ArrayType(T.DoubleType()))
        return wide.mapInPandas(explain, schema).withColumn("base", F.lit(paths.base))
    train = scored(model, split_rows(data, "TRAIN"))
    # One row: the training mean of each feature.
    means = train.agg(*[F.mean(c) for c in inputs.values()]).first()
    weights = learner.coefficients.toArray()
    added = {
        name: F.lit(float(w)) * (F.col(c) - F.lit(float(m))) for (name, c), w, m in zip(inputs.items(), weights, means)
    }
    base = float(learner.intercept + sum(w * m for w, m in zip(weights, means)))
    return rows.select(
        *KEYS,
        _raw_output(learner).alias("raw_output"),
        F.array(*[added.get(name, F.lit(0.0)) for name in MODEL_FEATURES]).alias("attribution"),
        F.lit(base).alias("base"),
    )


def global_explanation(model: PipelineModel, data: DataFrame, split: str = "TEST") -> DataFrame:
    """Mean absolute attribution of every feature over a split's rows, the largest first; null without rows."""
    rows = attributions(model, data, split)
    # One row of means, turned into a row per feature.
    means = rows.agg(*[F.mean(F.abs(F.col("attribution")[k])).alias(name) for k, name in enumerate(MODEL_FEATURES)])
    return means.select(
        F.explode(F.array(*[F.struct(F.lit(n).alias("feature"), F.col(n).alias("attribution")) for n in MODEL_FEATURES]))
    ).select("col.*").orderBy(F.desc_nulls_last("attribution"), "feature")

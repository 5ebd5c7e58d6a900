"""Shapley values of fitted models beside the definition over all subsets of features."""

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from stormledger.operators import attribution as A
from stormledger.operators import models as M
from stormledger.schemas import MODEL_FEATURES

from .helpers import config
from .test_models import CFG, data  # noqa: F401

N = 6


def plain(node):
    """A fitted tree as (value, feature, cut, sides, training weight)."""
    count, stats = node.impurityStats().count(), list(node.impurityStats().stats())
    if not node.subtreeDepth():
        return (node.prediction() if len(stats) == 3 else stats[1] / sum(stats), None, None, (), count)
    split = node.split()
    return (None, split.featureIndex(), split.threshold(), (plain(node.leftChild()), plain(node.rightChild())), count)


def expected(node, x, known):
    """A tree's output with only some features known: unknown ones take both ways by training weight."""
    value, feature, cut, sides, count = node
    if not sides:
        return value
    if feature in known:
        return expected(sides[int(x[feature] > cut)], x, known)
    return sum(s[4] * expected(s, x, known) for s in sides) / count


def by_definition(value):
    out = []
    for k in range(N):
        rest = [j for j in range(N) if j != k]
        total = 0.0
        for size in range(N):
            weight = math.factorial(size) * math.factorial(N - size - 1) / math.factorial(N)
            total += weight * sum(value({*s, k}) - value({*s}) for s in itertools.combinations(rest, size))
        out.append(total)
    return out


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(3)
    made = []
    for _ in range(300):
        x = [rng.choice([rng.random(), 0.5]) for _ in range(N)]
        y = x[0] * x[1] + (x[2] > 0.6) * x[3] + 0.05 * rng.random()
        made.append((x, y, float(y > 0.6), 1.0 + (y > 0.6)))
    df = spark.createDataFrame(made, "features array<double>, y double, label double, weight double")
    return df.withColumn("features", array_to_vector("features")).coalesce(2).cache()


@pytest.mark.parametrize("learner, options", [
    (GBTRegressor, dict(labelCol="y", maxIter=3, maxDepth=4)),
    (GBTClassifier, dict(weightCol="weight", maxIter=3, maxDepth=3, subsamplingRate=0.7)),
    (RandomForestClassifier, dict(weightCol="weight", numTrees=3, maxDepth=4)),
])
def test_equals_all_subsets(rows, learner, options):
    model = learner(seed=1, **options).fit(rows)
    paths = A.tree_paths(model)
    x = np.array([r.features.toArray() for r in rows.limit(4).collect()])
    got = A.shapley(paths, x)
    roots = [plain(t._java_obj.rootNode()) for t in model.trees]
    scale = [1 / len(roots)] * len(roots) if learner is RandomForestClassifier else model.treeWeights
    for row, values in zip(x, got):
        value = lambda known: sum(w * expected(t, row, known) for w, t in zip(scale, roots))
        assert values == pytest.approx(by_definition(value), abs=1e-9)
        assert paths.base == pytest.approx(value(set()))


def test_blocks_of_rows_do_not_matter(rows, monkeypatch):
    paths = A.tree_paths(GBTRegressor(labelCol="y", maxIter=2, maxDepth=3, seed=1).fit(rows))
    x = np.random.default_rng(1).random((50, N))
    whole = A.shapley(paths, x)
    monkeypatch.setattr(A, "CELLS", 7)
    assert np.allclose(A.shapley(paths, x), whole)


@pytest.mark.parametrize("key", ["regressor", "classifier", "logistic"])
def test_attributions_add_up_to_the_output(data, key):  # noqa: F811
    model = M.model_kind(key).train(data, config(**CFG))
    got = A.attributions(model, data).cache()
    assert got.count() == 120
    off = F.abs(F.col("base") + F.aggregate("attribution", F.lit(0.0), lambda a, v: a + v) - F.col("raw_output"))
    assert got.agg(F.max(off)).first()[0] < 1e-9
    means = A.global_explanation(model, data).collect()
    assert len(means) == 15 and means[0].feature in ("ws10_max_mps", "wind_squared")
    assert all(a.attribution >= b.attribution for a, b in zip(means, means[1:]))


def test_unusable_features_and_no_rows(data):  # noqa: F811
    none = data.withColumn("updraft700_pos_max_pas", F.lit(None).cast("double"))
    model = M.train_regressor(none, config(**CFG))
    place = MODEL_FEATURES.index("updraft700_pos_max_pas")
    assert A.attributions(model, none).where(F.col("attribution")[place] != 0).count() == 0
    empty = none.where("data_split = 'TRAIN'")
    assert A.attributions(model, empty).count() == 0
    assert {r.attribution for r in A.global_explanation(model, empty).collect()} == {None}


def test_a_tree_without_splits(spark, rows):
    flat = rows.withColumn("y", F.lit(2.0))
    model = GBTRegressor(labelCol="y", maxIter=1, maxDepth=3).fit(flat)
    paths = A.tree_paths(model)
    assert paths.base == 2.0 and not A.shapley(paths, np.ones((3, N))).any()

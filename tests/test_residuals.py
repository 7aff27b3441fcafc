"""Boosted trees from histograms of residuals against MLlib's learner, and trees read by their leaves against the walk."""

from dataclasses import replace

import numpy as np
import pytest
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from tunemill.plans import boosting as B
from tunemill.plans import models as M
from tunemill.plans import residuals
from tunemill.plans.trees import pack

FEATURES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def data(spark):
    x = F.col("id")
    df = spark.range(14000).select(
        "id", (x * 7919 % 101).cast("double").alias("a"), (x * 31 % 7).cast("double").alias("b"), F.when(x % 50 > 0, x * 0.37 % 5).alias("c"))
    df = df.withColumn("goal", F.col("a") * 2 + F.col("b") * F.coalesce("c", F.lit(0.0)) + x % 3).repartition(3, "id").sortWithinPartitions("id").persist()
    yield df
    df.unpersist()


@pytest.mark.parametrize("rows, cells", [(14000, 1 << 18), (2000, 1 << 18), (2000, 100)])
def test_trees_are_those_of_mllib(spark, data, monkeypatch, rows, cells):
    monkeypatch.setattr(residuals, "CELLS", cells)
    monkeypatch.setattr(residuals, "LINKS", 2)
    df, params = data.where(F.col("id") < rows), {"n_estimators": 5, "max_depth": 3, "learning_rate": 0.3, "min_child_weight": 20}
    a, b = [pack(spark, M.fit_gbt(df, FEATURES, "goal", params, by_levels=own)) for own in (True, False)]
    assert (a.feature == b.feature).all() and np.allclose(a.cut, b.cut, equal_nan=True) and np.allclose(a.value, b.value) and np.allclose(a.gain, b.gain)
    assert np.allclose(a.weights, b.weights) and (a.roots == b.roots).all()


def test_rows_of_too_many_intervals_to_number(spark, data, monkeypatch):
    df, params = data.where("id < 2000"), {"n_estimators": 3, "max_depth": 3}
    one = pack(spark, M.fit_gbt(df, FEATURES, "goal", params, by_levels=True))
    monkeypatch.setattr(residuals, "NUMBERED", 1)
    other = pack(spark, M.fit_gbt(df, FEATURES, "goal", params, by_levels=True))
    assert (one.feature == other.feature).all() and np.allclose(one.value, other.value) and np.allclose(one.gain, other.gain)


def test_boosting_does_not_fit_by_the_learner_of_mllib(data, monkeypatch):
    monkeypatch.setattr(GBTRegressor, "fit", lambda *_: pytest.fail("fitted by MLlib's learner"))
    model = B.fit_boosting(data, FEATURES, "goal", {"n_estimators": 4, "max_depth": 3}, validation=F.col("id") % 5 == 0)
    assert len(model.all_trees) == 4 == model.fitted.getNumTrees and model.fitted.treeWeights == [1.0, 0.1, 0.1, 0.1]


def test_leaves_are_those_of_the_walk(spark, data):
    trees = pack(spark, M.fit_gbt(data, FEATURES, "goal", {"n_estimators": 6, "max_depth": 5}, by_levels=True))
    walked = replace(trees)
    walked.__dict__["_reached"] = None
    x = np.random.default_rng(1).integers(0, 101, (5000, 3)) / [1, 10, 20]
    x[:50, 1] = trees.cut[trees.feature == 1][0]  # a value on a cut goes left
    assert trees._reached is not None and (trees.each(x) == walked.each(x)).all()

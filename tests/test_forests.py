"""Forests from histograms against MLlib's learner: equal trees without a bootstrap, equal quality with one."""

import numpy as np
import pytest
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from tunemill.operators.evaluate import predictions_match, regression_metrics
from tunemill.plans import forests
from tunemill.plans import models as M
from tunemill.plans.trees import pack

FEATURES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def data(spark):
    x = F.col("id")
    df = spark.range(3000).select(
        "id", (x * 7919 % 101).cast("double").alias("a"), (x * 31 % 7).cast("double").alias("b"), F.when(x % 50 > 0, x * 0.37 % 5).alias("c"))
    df = df.withColumn("goal", F.col("a") * 2 + F.col("b") * F.coalesce("c", F.lit(0.0)) + x % 3).repartition(3, "id").sortWithinPartitions("id").persist()
    yield df
    df.unpersist()


def mllib(df, **params):
    return RandomForestRegressor(seed=42, maxMemoryInMB=1024, **params).fit(M.assemble(df, FEATURES, "goal").select("features", "goal").withColumnRenamed("goal", "label"))


@pytest.mark.parametrize("least", [1, 40])
def test_a_tree_of_all_rows_is_that_of_mllib(spark, data, least):
    own = M.fit_forest(data, FEATURES, "goal", {"n_estimators": 1, "max_depth": 6, "bootstrap": False, "min_samples_leaf": least}, by_levels=True)
    other = mllib(data, numTrees=1, maxDepth=6, bootstrap=False, featureSubsetStrategy="all", minInstancesPerNode=least)
    a, b = pack(spark, own), pack(spark, other)
    assert (a.feature == b.feature).all() and np.allclose(a.cut, b.cut, equal_nan=True) and np.allclose(a.value, b.value) and np.allclose(a.gain, b.gain)
    assert np.allclose(own.featureImportances.toArray(), other.featureImportances.toArray())
    assert [t.numNodes for t in own.trees] == [t.numNodes for t in other.trees]


def test_forest_without_the_learner_of_mllib(spark, data, monkeypatch):
    other = mllib(data, numTrees=20, maxDepth=6, featureSubsetStrategy="all")
    monkeypatch.setattr(RandomForestRegressor, "fit", lambda *_: pytest.fail("grown by MLlib's learner"))
    params = {"n_estimators": 20, "max_depth": 6}
    own = M.fit_forest(data, FEATURES, "goal", params, by_levels=True)
    assert own.getNumTrees == 20 and {t.depth for t in own.trees} == {6} and len({t.toDebugString.split("\n", 1)[1] for t in own.trees}) == 20
    error = [regression_metrics(M.score(data, m, FEATURES), "goal", "prediction").first().rmse for m in (own, other)]
    assert abs(error[0] - error[1]) < 0.05 * error[1]
    assert np.allclose(own.featureImportances.toArray(), other.featureImportances.toArray(), atol=0.02)
    # The same rows give the same forest, also with one tree at a time.
    monkeypatch.setattr(forests, "TABLE_BYTES", 1 << 20)
    again = M.fit_forest(data, FEATURES, "goal", params, by_levels=True)
    one = M.score(data, own, FEATURES)
    assert predictions_match(one, M.score(data, again, FEATURES), ["id"], "prediction").first().same


def test_bootstrap_counts():
    counts = forests._poisson()
    assert abs(counts.mean() - 1) < 1e-4 and abs(counts.var() - 1) < 1e-3 and abs((counts == 0).mean() - np.exp(-1)) < 1e-4


def test_some_features_per_node(spark, data):
    own = M.fit_forest(data, FEATURES, "goal", {"n_estimators": 30, "max_depth": 2, "max_features": "onethird"}, by_levels=True)
    roots = pack(spark, own)
    assert len(set(roots.feature[roots.roots])) > 1  # with all features to choose from each root would take the best
    names = ["all", "sqrt", "log2", "onethird", "0.5", "2", "9", "auto"]
    assert [forests.features_per_node(n, 5, 5) for n in names] == [5, 3, 3, 2, 3, 2, 5, 2] and forests.features_per_node("auto", 1, 5) == 5


def test_values_without_an_end_are_an_error(spark):
    df = spark.createDataFrame([(1.0, 2.0), (float("inf"), 3.0)], "a double, goal double")
    with pytest.raises(Exception, match="not finite"):
        M.fit_forest(df, ["a"], "goal", {"n_estimators": 1, "max_depth": 2}, by_levels=True)

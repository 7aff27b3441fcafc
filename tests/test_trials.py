"""Searches in which every trial gets all its trees: ensembles grown from cells of rows, against MLlib's learners and one by one."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from catalog import modelling
from catalog.registry import QUERIES
from tunemill.operators.evaluate import regression_metrics
from tunemill.plans import boosting as B
from tunemill.plans import trials as T
from tunemill.plans.models import forest_learner
from tunemill.plans.tune import refit_and_test

FEATURES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def data(spark):
    x = F.col("id")
    df = spark.range(3000).select(
        "id", (x * 7919 % 101).cast("double").alias("a"), (x * 31 % 7).cast("double").alias("b"), F.when(x % 50 > 0, x * 0.37 % 5).alias("c"),
        F.element_at(F.array(*[F.lit(s) for s in ("train", "train", "val", "train", "test")]), (x % 5 + 1).cast("int")).alias("split"))
    df = df.withColumn("goal", F.col("a") * 2 + F.col("b") * F.coalesce("c", F.lit(0.0)) + x % 3).repartition(3, "id").sortWithinPartitions("id").persist()
    yield df
    df.unpersist()


def logged(df, kind, space, trials, **more):
    best, log = B.search(df, kind, space, FEATURES, "goal", trials=trials, first_rung=None, **more)
    return best, log.orderBy("trial").collect()


def agree(own, other):
    assert len(own) == len(other)
    for a, b in zip(own, other):
        assert a[:5] == b[:5] and abs(a.rmse - b.rmse) < 1e-9 and a.is_best == b.is_best


BOOSTING = {"max_depth": ("choice", [2, 4]), "n_estimators": ("choice", [6, 14]), "learning_rate": ("choice", [0.3, 1.0]),
            "min_child_weight": ("choice", [1, 30]), "subsample": ("choice", [1.0])}


def test_boosting_of_all_rows_is_that_of_mllib(data, monkeypatch):
    best, own = logged(data, "gbt", BOOSTING, 6, patience=2)
    monkeypatch.setattr(T, "HELD", -1)
    other, rows = logged(data, "gbt", BOOSTING, 6, patience=2)
    agree(own, rows)
    assert best == other
    ends = [(r.trees, json.loads(r.params)["n_estimators"], r.best_round) for r in own]
    assert all(trees == asked or trees == least + 2 for trees, asked, least in ends) and any(trees == asked for trees, asked, _ in ends)


def test_trees_without_a_draw_are_those_of_mllib(data, monkeypatch):
    space = {"max_depth": ("choice", [3, 6]), "n_estimators": ("choice", [2, 3]), "min_samples_leaf": ("choice", [1, 9]), "bootstrap": ("choice", [False])}
    _, own = logged(data, "forest", space, 5)
    monkeypatch.setattr(T, "HELD", -1)
    _, rows = logged(data, "forest", space, 5)
    agree(own, rows)


def test_forests_that_share_trees_are_those_grown_alone(data, monkeypatch):
    monkeypatch.setattr(T, "TREES", 7)
    space = {"max_depth": ("choice", [2, 5, 20]), "n_estimators": ("choice", [4, 9, 30]), "max_features": ("choice", ["sqrt", "0.5", "1.0"]),
             "min_samples_leaf": ("choice", [1, 5])}
    _, rows = logged(data, "forest", space, 8)
    train, val = data.where("split = 'train'"), data.where("split = 'val'")
    for r in rows:
        params = json.loads(r.params)
        assert r.trees == r.best_round == params["n_estimators"]
        tested = T.fit_forest_rows(train, FEATURES, "goal", forest_learner(params)).score(val)
        assert abs(regression_metrics(tested, "goal", "prediction").first().rmse - r.rmse) < 1e-9


@pytest.mark.parametrize("nodes", [1, 40, 3000])
def test_splits_of_sorted_cells_are_those_of_tables(nodes):
    source = np.random.default_rng(nodes)
    bins, node = source.integers(0, 9, 5000).astype(np.uint8), source.integers(0, nodes, 5000)
    w = source.integers(0, 4, 5000).astype(float)
    s = w * source.normal(7, 2, 5000)
    weight, total = np.bincount(node, w, nodes), np.bincount(node, s, nodes)
    with np.errstate(divide="ignore", invalid="ignore"):
        gain, cut = T._best_of_tables(bins, 9, node, w, s, weight, total, 2)
        found, place = T._best_sorted(bins, node, w, s - w * (total / np.maximum(weight, 1)).take(node), weight, 2)
    assert (np.isneginf(gain) == np.isneginf(found))[weight > 0].all()
    has = np.isfinite(gain)
    assert has.any() and np.allclose(gain[has], found[has]) and (cut[has] == place[has]).mean() > 0.99  # but for equal gains


def test_forests_and_subsamples_are_as_good_as_those_of_mllib(data, monkeypatch):
    forest = {"max_depth": ("choice", [8]), "n_estimators": ("choice", [30]), "max_features": ("choice", ["0.5", "1.0"])}
    boosting = {**BOOSTING, "subsample": ("choice", [0.7])}
    own = [logged(data, k, s, 3, patience=20)[1] for k, s in (("forest", forest), ("gbt", boosting))]
    monkeypatch.setattr(T, "HELD", -1)
    other = [logged(data, k, s, 3, patience=20)[1] for k, s in (("forest", forest), ("gbt", boosting))]
    for a, b in zip(sum(own, []), sum(other, [])):
        assert a.params == b.params and abs(a.rmse - b.rmse) < 0.1 * b.rmse


def test_refit_by_cells_and_by_mllib(data, monkeypatch):
    params = {"max_depth": 6, "n_estimators": 40, "bootstrap": True}
    own = refit_and_test(data, "forest", params, FEATURES, "goal")[1].first()
    monkeypatch.setattr(T, "HELD", -1)
    other = refit_and_test(data, "forest", params, FEATURES, "goal")[1].first()
    assert own.rows == other.rows == data.where("split = 'test' AND c IS NOT NULL").count() and abs(own.rmse - other.rmse) < 0.05 * other.rmse


@pytest.mark.parametrize("counts", [128, 0])
def test_rows_of_a_cell_are_drawn_one_by_one(monkeypatch, counts):
    monkeypatch.setattr(T, "COUNTS", counts)
    rows = np.repeat([1.0, 3.0, 40.0], 20000)
    cells = T.Cells(np.zeros((1, 3), np.uint8), [1], np.repeat([0, 1, 2], 20000), np.ones(60000), rows, np.zeros(1, int), np.ones(1), np.zeros(1), 0.0)
    for kind, share, spread in (("poisson", 1.0, 1.0), ("binomial", 0.7, 0.3)):
        times = []
        monkeypatch.setattr(T.Cells, "sums", lambda _, t: times.append(t))
        cells.drawing(kind, share)(np.random.Generator(np.random.SFC64(1)))
        for n in (1, 3, 40):
            own = times[0][rows == n]
            assert abs(own.mean() - n * share) < 0.03 * n and abs(own.var() - n * share * spread) < 0.05 * n


def test_no_rows_to_learn_from_or_to_judge_by(data):
    for kept in ("val", "train"):
        with pytest.raises(ValueError, match="at least one row"):
            B.search(data.where(F.col("split") == kept), "forest", {"n_estimators": ("choice", [2])}, FEATURES, "goal", trials=1, first_rung=None)


def test_registered_boosting_search_is_whole(spark, sf):
    rows = QUERIES["tune_boosting"](spark, sf).collect()
    asked = [json.loads(r.params)["n_estimators"] for r in rows]
    assert len(rows) == 50 and all(n >= 100 for n in asked)
    assert all(r.trees == n or r.trees == r.best_round + modelling.PATIENCE for r, n in zip(rows, asked))


def test_registered_forest_searches_are_whole(spark, sf):
    log = modelling.searched(spark, sf, "forest", modelling.FOREST_SPACE)[1].collect()
    assert len(log) == 50 and all(r.trees == json.loads(r.params)["n_estimators"] >= 50 for r in log)
    best = QUERIES["tune_forest"](spark, sf).first()
    found = {r.name: r.value for r in QUERIES["best_parameters"](spark, sf).collect()}
    assert best.trees == int(found["n_estimators"]) and found == {k: str(v) for k, v in json.loads(best.params).items()}
    assert {r.trials for r in QUERIES["tune_logs"](spark, sf).collect()} == {50}

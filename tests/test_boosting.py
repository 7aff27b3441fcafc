"""Packed trees, boosting with patience and the search in rungs."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from tunemill.plans import boosting as B
from tunemill.plans import models as M
from tunemill.plans import trees as T

FEATURES = ["a", "b"]


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(3)
    a, b, noise = rng.uniform(0, 10, 600), rng.uniform(0, 1, 600), rng.normal(0, 1, 600)
    rows = [(i, float(x), float(y), float(3 * x + 10 * (y > 0.5) + e), "val" if i % 4 == 0 else "train") for i, (x, y, e) in enumerate(zip(a, b, noise))]
    df = spark.createDataFrame(rows, "id int, a double, b double, goal double, split string").repartition(3).persist()
    yield df
    df.unpersist()


def predictions(df):
    return {r.id: r.prediction for r in df.select("id", "prediction").collect()}


@pytest.mark.parametrize("kind", ["forest", "boosting"])
def test_packed_trees_predict_the_same(spark, data, kind):
    fit = M.fit_forest if kind == "forest" else M.fit_gbt
    model = fit(data, FEATURES, "goal", {"n_estimators": 7, "max_depth": 4})
    trees = T.pack(spark, model)
    want, got = predictions(M.score(data, model, FEATURES)), predictions(T.score_trees(data, trees, FEATURES))
    assert want.keys() == got.keys() and all(abs(want[i] - got[i]) < 1e-9 for i in want)
    assert np.allclose(trees.importances(2), model.featureImportances.toArray(), atol=0.05 if kind == "forest" else 1e-9)
    holes = data.withColumn("a", F.when(F.col("id") % 2 == 0, F.lit(float("nan"))).when(F.col("id") % 3 == 0, None).otherwise(F.col("a")))
    assert T.score_trees(holes, trees, FEATURES).count() == holes.where("id % 2 = 1 AND id % 3 > 0").count()
    if kind == "forest":
        spread = {r.id: r for r in M.forest_uncertainty(data, model, FEATURES).collect()}
        each = {i: [] for i in want}
        for tree in model.trees:
            for i, p in predictions(tree.transform(M.assemble(data, FEATURES))).items():
                each[i].append(p)
        assert all(abs(spread[i].pred_std - np.std(each[i])) < 1e-9 and abs(spread[i].prediction - want[i]) < 1e-9 for i in want)


def test_plan_does_not_grow_with_the_trees(spark, data):
    plans = []
    for n in (3, 40):
        trees = T.pack(spark, M.fit_forest(data, FEATURES, "goal", {"n_estimators": n, "max_depth": 3}))
        plans.append(T.score_trees(data, trees, FEATURES)._jdf.queryExecution().analyzed().toString().count("\n"))
    assert plans[0] == plans[1]


def test_best_round():
    assert B.best_round([5, 4, 3, 3, 3], 2) == (3, 5)
    assert B.best_round([5, 4, 4.5, 4.4, 4.3, 1], 3) == (2, 5)
    assert B.best_round([5, 4, 4.5, 4.4, 3], 3) == (5, 5)
    assert B.best_round([5, 4.9, 4.8], 2, least_gain=0.5) == (1, 3)
    assert B.best_round([], 2) == (0, 0)


def test_boosting_is_cut_at_its_best_round(spark, data):
    model = B.fit_boosting(data, FEATURES, "goal", {"n_estimators": 40, "max_depth": 5, "learning_rate": 0.5}, validation=F.col("split") == "val", patience=4)
    rounds = {r["round"]: r for r in B.curve(data.where("split = 'val'"), model, "goal", F.col("split")).collect()}
    assert len(rounds) == 40 and 0 < model.best < model.last < 40 and len(model.trees) == model.best
    errors = [rounds[i].rmse for i in range(1, 41)]
    assert B.best_round(errors, 4) == (model.best, model.last)
    assert errors[model.best - 1] == min(errors[:model.last])
    scored = model.score(data.where("split = 'val'"))
    direct = scored.agg(F.sqrt(F.avg((F.col("goal") - F.col("prediction")) ** 2)).alias("e"), F.avg(F.abs(F.col("goal") - F.col("prediction"))).alias("m")).first()
    assert abs(direct.e - errors[model.best - 1]) < 1e-9 and abs(direct.m - rounds[model.best].mae) < 1e-9
    assert [r.is_best for _, r in sorted(rounds.items())].index(True) == model.best - 1
    assert abs(sum(model.featureImportances) - 1) < 1e-9 and len(model.featureImportances) == 2
    assert len(B.fit_boosting(data, FEATURES, "goal", {"n_estimators": 3, "max_depth": 2}).trees) == 3


def test_search_shares_ensembles_and_ends_bad_trials(spark, data, monkeypatch):
    fitted, fit = [], B.fit_gbt

    def counted(df, features, label, params, seed):
        fitted.append(params)
        return fit(df, features, label, params, seed)

    monkeypatch.setattr(B, "fit_gbt", counted)
    space = {"max_depth": ("choice", [2, 4]), "n_estimators": ("int", 4, 12, 2), "learning_rate": ("choice", [0.02, 0.5])}
    best, log = B.search(data, "gbt", space, FEATURES, "goal", trials=9, first_rung=2, patience=50)
    rows = log.orderBy("trial").collect()
    assert len(rows) == 9 and sum(r.is_best for r in rows) == 1
    low = min(r.rmse for r in rows)
    chosen = next(r for r in rows if r.is_best)
    assert chosen.rmse == low and best == {**json.loads(chosen.params), "n_estimators": chosen.best_round}
    families = {(json.loads(r.params)["max_depth"], json.loads(r.params)["learning_rate"]) for r in rows}
    assert sum(p["n_estimators"] == 2 for p in fitted) == len(families) < 9
    assert {r.rung for r in rows} >= {0, 1} and all(r.trees == 2 for r in rows if r.rung == 0)
    # The same error from a model fitted with the parameters found.
    model = T.pack(spark, fit(data.where("split = 'train'"), FEATURES, "goal", best, 42))
    again = T.score_trees(data.where("split = 'val'"), model, FEATURES)
    assert abs(again.agg(F.sqrt(F.avg((F.col("goal") - F.col("prediction")) ** 2))).first()[0] - low) < 1e-9


def test_forest_search(spark, data):
    space = {"max_depth": ("int", 2, 6, 1), "n_estimators": ("int", 4, 12, 4), "max_features": ("choice", ["0.5", "1.0"])}
    best, log = B.search(data, "forest", space, FEATURES, "goal", trials=6, first_rung=2)
    rows = log.collect()
    assert len(rows) == 6 and all(r.trees == r.best_round for r in rows) and max(r.rung for r in rows) >= 1
    model = T.pack(spark, M.fit_forest(data.where("split = 'train'"), FEATURES, "goal", best))
    again = T.score_trees(data.where("split = 'val'"), model, FEATURES)
    assert abs(again.agg(F.sqrt(F.avg((F.col("goal") - F.col("prediction")) ** 2))).first()[0] - min(r.rmse for r in rows)) < 1e-9

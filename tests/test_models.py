"""Model jobs by their properties: quality on a known signal, repeatability, additivity, save and load."""

import pytest
from pyspark.ml.regression import GBTRegressionModel
from pyspark.sql import functions as F

from tunemill.operators import evaluate as Q
from tunemill.operators.sampling import split
from tunemill.plans import explain as X
from tunemill.plans import models as M
from tunemill.plans.pipeline import run_all
from tunemill.plans import training as T
from tunemill.plans.tune import random_search, refit_and_test
from tunemill.session import scratch_path
from tunemill.sources.files import write_json
from tunemill.sources.synthetic import NORMAL_COLUMNS, synthetic

KEY = ["row_id"]
FEATURES = NORMAL_COLUMNS


@pytest.fixture(scope="module")
def data(spark):
    df = split(synthetic(spark, 1000), "70/15/15", KEY).persist()
    yield df
    df.unpersist()


@pytest.fixture(scope="module")
def gbt(data):
    return M.fit_gbt(data.where("split <> 'test'"), FEATURES, "popularity", {"n_estimators": 40, "max_depth": 4},
                     validation=F.col("split") == "val")


@pytest.fixture(scope="module")
def forest(data):
    return M.fit_forest(data.where("split = 'train'"), FEATURES, "popularity", {"n_estimators": 15, "max_depth": 6})


def r2(df, model):
    return Q.regression_metrics(M.score(df, model, FEATURES), "popularity", "prediction").first().r2


def test_models_find_the_signal(data, gbt, forest):
    test = data.where("split = 'test'")
    assert r2(test, M.fit_linear(data.where("split = 'train'"), FEATURES, "popularity")) > 0.7
    assert r2(test, gbt) > 0.7
    assert r2(test, forest) > 0.6


def test_fit_is_repeatable_and_survives_saving(spark, data, gbt):
    again = M.fit_gbt(data.where("split <> 'test'"), FEATURES, "popularity", {"n_estimators": 40, "max_depth": 4},
                      validation=F.col("split") == "val")
    path = scratch_path(spark, "model")
    gbt.write().save(path)
    one = M.score(data, gbt, FEATURES)
    for other in (again, GBTRegressionModel.load(path)):
        assert Q.predictions_match(one, M.score(data, other, FEATURES), KEY, "prediction").first().same
    assert not Q.predictions_match(one, one.withColumn("prediction", F.col("prediction") + 1), KEY, "prediction").first().same


def test_importance_and_learning_curve(data, gbt):
    top = M.importances(data, gbt, FEATURES).collect()
    assert {r.feature for r in top[:2]} == {"energy", "danceability"}
    assert sum(r.importance for r in top) == pytest.approx(1.0)
    curve = M.learning_curve(gbt, {"train": data.where("split = 'train'")}, FEATURES, "popularity").orderBy("iteration").collect()
    assert curve[0].rmse > curve[-1].rmse


def test_forest_uncertainty_and_trees(data, forest):
    rows = M.forest_uncertainty(data, forest, FEATURES)
    both = rows.select("row_id", F.col("prediction").alias("p"), "pred_std").join(M.score(data, forest, FEATURES), "row_id")
    assert both.where(F.abs(F.col("p") - F.col("prediction")) > 1e-9).count() == 0
    assert both.where("pred_std < 0").count() == 0 and both.agg(F.max("pred_std")).first()[0] > 0
    summary = M.tree_summary(M.tree_stats(data, forest)).first()
    assert summary.trees == 15 and summary.max_depth <= 6 and summary.total_leaves >= 15
    assert Q.confidence_tiers(rows, "pred_std").agg(F.sum("pct")).first()[0] == pytest.approx(100.0)


def test_shapley_adds_up(data, gbt):
    some = data.where("split = 'test'")
    parts = X.shapley(some, gbt, FEATURES, data, KEY, draws=12).persist()
    total = F.col("base")
    for c in FEATURES:
        total = total + F.col(c)
    assert parts.count() == some.count()
    assert parts.where(F.abs(total - F.col("prediction")) > 1e-6).count() == 0
    joined = parts.select("row_id", F.col("prediction").alias("p")).join(M.score(some, gbt, FEATURES), "row_id")
    assert joined.where(F.abs(F.col("p") - F.col("prediction")) > 1e-6).count() == 0
    assert X.mean_abs_attribution(parts, FEATURES).first().feature == "energy"
    assert X.dependence(some, parts, "energy", KEY).count() == some.count()
    row = X.explain_row(parts, F.col("row_id") == parts.first().row_id, FEATURES, top=3).collect()
    assert [r["rank"] for r in row] == [1, 2, 3]
    parts.unpersist()


def test_shapley_of_a_linear_model_is_the_closed_form(data):
    model = M.fit_linear(data, FEATURES, "popularity")
    some = data.where("row_id < 30")
    exact = X.linear_attributions(data, model, FEATURES, KEY).where("row_id < 30")
    sampled = X.shapley(some, model, FEATURES, data, KEY, draws=200)
    joined = exact.alias("a").join(sampled.alias("b"), "row_id")
    gap = joined.agg(F.avg(F.abs(F.col("a.energy") - F.col("b.energy")))).first()[0]
    assert gap < 2.0
    assert joined.where(F.abs(F.col("a.prediction") - F.col("b.prediction")) > 1e-6).count() == 0


def test_permutation_importance(data, gbt):
    assert X.permutation_importance(data, gbt, FEATURES, "popularity", KEY).first().feature == "energy"


def test_search(data):
    space = {"max_depth": ("int", 2, 4, 1), "learning_rate": ("log", 0.05, 0.3), "n_estimators": ("choice", [5])}
    best, log = random_search(data, "gbt", space, FEATURES, "popularity", trials=3)
    rows = log.collect()
    assert len(rows) == 3 and min(rows, key=lambda r: r.rmse).is_best
    assert random_search(data, "gbt", space, FEATURES, "popularity", trials=3)[0] == best
    _, tested = refit_and_test(data, "gbt", best, FEATURES, "popularity")
    assert tested.first().rows == 150


def test_classifier_projection_and_factors(spark, data):
    model = M.fit_hit_classifier(data, FEATURES, at_least=60)
    assert M.classifier_metrics(data, model, FEATURES, at_least=60)["roc_auc"] > 0.8
    assert M.project_2d(data, FEATURES, KEY).columns == ["row_id", "x", "y"]
    uses = spark.createDataFrame([(u, i, 1.0) for u in range(10) for i in range(u % 3, 6)], "u int, i int, s double")
    assert M.fit_implicit(uses, "u", "i", "s").recommendForAllUsers(2).count() == 10


def test_comparison_of_models(data):
    small = {"linear": ("linear", None), "forest": ("forest", {"n_estimators": 5, "max_depth": 5}),
             "boosting": ("gbt", {"n_estimators": 10, "max_depth": 3, "learning_rate": 0.3})}
    rows = {r.model: r for r in T.train_and_compare(data, FEATURES, models=small).collect()}
    assert sorted(r["rank"] for r in rows.values()) == [1, 2, 3]
    assert rows["linear"].gain == 0.0 and rows["linear"].is_best


def test_artist_features_help_when_they_carry_the_signal(data):
    enriched = data.withColumn("artist_popularity", F.when(F.col("row_id") % 5 > 0, F.col("popularity")))
    table, families = T.train_enriched(enriched, ["acousticness", "tempo"], params={"n_estimators": 8, "max_depth": 4, "learning_rate": 0.3})
    assert {r.model: r.is_best for r in table.collect()} == {"audio": False, "audio_and_artist": True}
    share = {r.family: r.importance for r in families.collect()}
    assert share["artist"] > share["audio"] and sum(share.values()) == pytest.approx(1.0)


def test_verification(spark, data):
    def fit():
        return M.fit_forest(data.where("split = 'train'"), FEATURES, "popularity", {"n_estimators": 10, "max_depth": 6})
    report = T.verify(data, FEATURES, "popularity", KEY, fit)
    assert report["reproducible"] and report["same_after_loading"] and not report["critical"]
    assert report["status"].startswith("PASSED") and report["metrics"]["r2"] > 0.6
    path = scratch_path(spark, "report")
    write_json(spark, report, path)
    write_json(spark, report, path)
    assert spark.read.json(path).count() == 2
    flat = T.verify(data.withColumn("popularity", F.lit(65.0) + F.col("row_id") % 2), FEATURES, "popularity", KEY, fit)
    assert flat["critical"] and flat["status"] == "FAILED"


def test_metrics(spark):
    df = spark.createDataFrame([(0.0, 1.0), (20.0, 25.0), (20.5, 10.0), (100.0, 90.0)], "y double, p double")
    m = Q.regression_metrics(df, "y", "p", features=1).first()
    assert m.mae == pytest.approx((1 + 5 + 10.5 + 10) / 4)
    assert m.adj_r2 == pytest.approx(Q.adjusted_r2(m.r2, 4, 1))
    assert Q.regression_metrics(df, "y", "p", features=3).first().adj_r2 is None
    bands = {r.band: r.rows for r in Q.error_by_band(df, "y", "p").collect()}
    assert bands == {None: 1, "0-20": 1, "20-40": 1, "80-100": 1}
    assert Q.adjusted_r2(1.0, 100, 10) == 1.0
    with pytest.raises(ValueError):
        Q.adjusted_r2(0.5, 11, 10)
    constant = spark.createDataFrame([(1.0, 1.0), (1.0, 2.0)], "y double, p double")
    assert Q.regression_metrics(constant, "y", "p").first().r2 is None
    flat = Q.health(df.withColumn("p", F.lit(65.0)), "y", "p").collect()
    assert {r.check_name for r in flat if r.level == "critical"} >= {"prediction_std", "prediction_range", "share_60_70"}
    assert flat[0].status == "FAILED"
    tiers = M.predict_tier(spark.createDataFrame([(120.0,), (50.0,), (29.9,), (-3.0,)], "prediction double")).collect()
    assert [r.tier for r in tiers] == ["Excellent", "Good", "Challenging", "Challenging"] and tiers[0].score == 100.0


def test_pipeline(spark, sf):
    from catalog.registry import FEATURE_KEY, tracks
    out = scratch_path(spark, "pipeline")
    report = run_all(spark, tracks(spark, sf), out, ["track_id"], {"n_estimators": 3, "max_depth": 3}, keys=FEATURE_KEY)
    assert report.ok, report.steps
    clean = spark.read.parquet(f"{out}/clean")
    assert clean.where("popularity < 1").count() == 0
    assert clean.count() == clean.select(*FEATURE_KEY).distinct().count()
    assert spark.read.parquet(f"{out}/ledger/metrics").where("key = 'test_r2'").count() == 1
    broken = run_all(spark, tracks(spark, sf).drop("track_id"), scratch_path(spark, "bad"), ["track_id"], keep_going=True)
    assert not broken.ok and len(broken.steps) == 3

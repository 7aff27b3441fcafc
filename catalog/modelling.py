"""Model training, tuning and explanation.

Most results depend on a learner and are checked by properties in the tests; queries with a closed form have SQL.
"""

import json

from pyspark.sql import functions as F

from catalog.joins import joined
from catalog.registry import TRACK_FEATURES, preds, query, rd, rounded, table, tracks, with_preds
from tunemill.operators.encode import label_encode
from tunemill.operators.evaluate import metrics_by
from tunemill.operators.enrich import fill_defaults, with_artist_features
from tunemill.operators.sampling import split
from tunemill.plans import boosting as B
from tunemill.plans import explain as X
from tunemill.plans import models as M
from tunemill.plans import training as T
from tunemill.plans.trees import LEAF, pack, score_trees
from tunemill.plans.tune import refit_and_test
from tunemill.presets import BOOSTING_SPACE, FOREST_SPACE
from tunemill.session import scratch_path
from tunemill.sources.files import load_params, write_json

KEY = ["track_id", "duration_ms"]  # the ids alone repeat in the smallest tables
FEATURES = ["popularity", "energy", "valence", "acousticness", "tempo"]
GOAL = "goal"


def labelled(spark, sf):
    """The stand-in prediction serves as the goal that models learn."""
    return preds(spark, sf).withColumnRenamed("prediction", GOAL).select(*KEY, "split", GOAL, *FEATURES)


def training(spark, sf):
    return labelled(spark, sf).where(F.col("split") == "train")


#: Sizes at which the models of the queries are trained, and the rounds without gain that end boosting.
FOREST = {"n_estimators": 100, "max_depth": 8}
BOOST, PATIENCE = {"n_estimators": 100, "max_depth": 5, "learning_rate": 0.1}, 10
_FITTED: dict = {}


def fitted(spark, sf, name, fit):
    """A model that several queries look at is trained once per session and table."""
    key = (spark.sparkContext.applicationId, sf, name)
    if key not in _FITTED:
        _FITTED[key] = fit()
    return _FITTED[key]


def merged(df):
    """Not more partitions than tasks run at a time (8 at least), since learners start many jobs over the same rows."""
    return df.coalesce(max(8, df.sparkSession.sparkContext.defaultParallelism))


def forest(spark, sf):
    return fitted(spark, sf, "forest", lambda: M.fit_forest(merged(training(spark, sf)), FEATURES, GOAL, FOREST, by_levels=True))


def boosted(spark, sf):
    rows = merged(labelled(spark, sf).where(F.col("split") != "test"))
    return fitted(spark, sf, "boosted", lambda: B.fit_boosting(rows, FEATURES, GOAL, BOOST, validation=F.col("split") == "val", patience=PATIENCE))


SMALL_FOREST = {"n_estimators": 10, "max_depth": 6}
SMALL_BOOST = {"n_estimators": 10, "max_depth": 4, "learning_rate": 0.3}


@query("linear_single", with_preds(f"""
SELECT 'popularity' AS feature, {rd('regr_slope(prediction, popularity)', 4)} AS coefficient,
       {rd('regr_intercept(prediction, popularity)', 4)} AS intercept FROM preds"""))
def linear_single(spark, sf):
    data = labelled(spark, sf)
    m = M.fit_linear(data, ["popularity"], GOAL)
    return rounded(spark.createDataFrame([("popularity", float(m.coefficients[0]), float(m.intercept))],
                                         "feature string, coefficient double, intercept double"), 4)


@query("linear_fit")
def linear_fit(spark, sf):
    model = M.fit_linear(training(spark, sf), FEATURES, GOAL)
    return metrics_by(M.score(labelled(spark, sf), model, FEATURES), GOAL, "prediction")


@query("forest_fit")
def forest_fit(spark, sf):
    return metrics_by(M.score(labelled(spark, sf), forest(spark, sf), FEATURES), GOAL, "prediction")


@query("gbt_fit")
def gbt_fit(spark, sf):
    """A model of up to 100 trees, cut where validation rows are predicted best."""
    return metrics_by(boosted(spark, sf).score(labelled(spark, sf)), GOAL, "prediction")


@query("learning_curve")
def learning_curve(spark, sf):
    """Errors of training and validation rows after each of the 100 rounds."""
    return B.curve(labelled(spark, sf).where(F.col("split") != "test"), boosted(spark, sf), GOAL, F.col("split"))


MEAN_RMSE = f"""{rd('sqrt(avg(power(prediction - (SELECT avg(prediction) FROM preds WHERE split = \'train\'), 2)))')} AS rmse_of_mean"""


def against_mean(rows, *also):
    """Rows and error of the plain mean of the training rows, per split, from scored rows; ``also`` are further aggregates of that pass."""
    mean = rows.where(F.col("split") == "train").agg(F.avg(GOAL)).first()[0]
    rmse = lambda c: F.sqrt(F.avg(F.pow(F.col(GOAL) - c, 2)))
    return rows.groupBy("split").agg(F.count("*").alias("n_rows"), rmse(F.lit(mean)).alias("rmse_of_mean"), rmse(F.col("prediction")).alias("rmse"), *also)


@query("gbt_rounds", with_preds(f"""
SELECT split, count(*) AS n_rows, {MEAN_RMSE}, {BOOST['n_estimators']} AS rounds, true AS one_error_per_round, true AS curve_is_that_of_scores,
       true AS packed_is_fitted, true AS best_is_first_low, true AS ended_by_patience, true AS far_better_than_mean
FROM preds GROUP BY split"""))
def gbt_rounds(spark, sf):
    """What must hold of a model cut by patience: each error recomputed from scores of rows, the best round from the errors."""
    model, data = boosted(spark, sf), labelled(spark, sf)
    scored = model.score(data)
    # A line per round and split: walked once, since three of the tables below are made of them.
    errors = B.curve(data, model, GOAL, F.col("split"))
    errors = spark.createDataFrame(errors.collect(), errors.schema)
    val = errors.where(F.col("part") == "val")
    low = val.where(F.col("round") <= model.last).agg(F.min(F.struct("rmse", "round"))["round"].alias("best"), F.max("round").alias("last")).first()
    counted = errors.groupBy("part").agg(F.countDistinct("round").alias("rounds"), F.count("*").alias("lines"))
    at_best = errors.where(F.col("round") == low.best).select("part", F.col("rmse").alias("own"))
    whole = M.score(data, model.fitted, FEATURES, "whole")
    packed = score_trees(whole, model.all_trees, FEATURES, "packed")
    apart = packed.groupBy("split").agg(F.max(F.abs(F.col("packed") - F.col("whole"))).alias("apart"))
    table = (against_mean(scored).join(counted, F.col("part") == F.col("split")).drop("part")
             .join(at_best, F.col("part") == F.col("split")).drop("part").join(apart, "split"))
    total = len(model.all_trees)
    return rounded(table.select(
        "split", "n_rows", "rmse_of_mean", "rounds", (F.col("lines") == F.col("rounds")).alias("one_error_per_round"),
        (F.abs(F.col("own") - F.col("rmse")) < 1e-9).alias("curve_is_that_of_scores"), (F.col("apart") < 1e-9).alias("packed_is_fitted"),
        F.lit(low.best == model.best == len(model.trees)).alias("best_is_first_low"),
        F.lit(low.last == min(total, model.best + PATIENCE)).alias("ended_by_patience"),
        (F.col("rmse") < 0.5 * F.col("rmse_of_mean")).alias("far_better_than_mean")))


@query("importance_rank")
def importance_rank(spark, sf):
    return M.importances(training(spark, sf), forest(spark, sf), FEATURES)


@query("forest_uncertainty")
def forest_uncertainty(spark, sf):
    return M.forest_uncertainty(labelled(spark, sf), forest(spark, sf), FEATURES).select("track_id", "prediction", "pred_std")


@query("tree_stats")
def tree_stats(spark, sf):
    return M.tree_summary(M.tree_stats(training(spark, sf), forest(spark, sf)))


@query("forest_parts", with_preds(f"""
SELECT split, count(*) AS n_rows, {MEAN_RMSE}, {FOREST['n_estimators']} AS trees, true AS mean_of_trees_is_prediction, true AS trees_differ,
       true AS importances_sum_to_1, true AS idle_feature_is_last, true AS leaves_counted_twice_agree, true AS far_better_than_mean
FROM preds GROUP BY split"""))
def forest_parts(spark, sf):
    """What must hold of a forest: its trees' mean, their spread, their importances and leaves, from two ways of counting."""
    model, data = forest(spark, sf), labelled(spark, sf)
    both = M.forest_uncertainty(M.score(data, model, FEATURES, "whole"), model, FEATURES)
    ranks = M.importances(data, model, FEATURES).collect()
    trees, stats = pack(spark, model), M.tree_stats(data, model).agg(F.sum("leaves").alias("leaves"), F.count("*").alias("trees")).first()
    used = {"popularity", "energy", "valence"}  # the goal is made of these
    table = against_mean(both, F.max(F.abs(F.col("prediction") - F.col("whole"))).alias("apart"), F.max("pred_std").alias("spread"))
    return rounded(table.select(
        "split", "n_rows", "rmse_of_mean", F.lit(len(trees)).alias("trees"), (F.col("apart") < 1e-9).alias("mean_of_trees_is_prediction"),
        (F.col("spread") > 0).alias("trees_differ"), F.lit(abs(sum(r.importance for r in ranks) - 1) < 1e-9).alias("importances_sum_to_1"),
        F.lit({r.feature for r in ranks[:3]} == used).alias("idle_feature_is_last"),
        F.lit(int((trees.feature == LEAF).sum()) == stats.leaves and stats.trees == len(trees)).alias("leaves_counted_twice_agree"),
        (F.col("rmse") < 0.5 * F.col("rmse_of_mean")).alias("far_better_than_mean")))


#: Every trial of these searches gets all its trees.
TRIALS = {"gbt": 50, "forest": 50}


def searched(spark, sf, kind, space):
    """The search over the whole space, made once per session and table."""
    data = merged(labelled(spark, sf))
    return fitted(spark, sf, f"search-{kind}", lambda: B.search(data, kind, space, FEATURES, GOAL, TRIALS[kind], patience=PATIENCE, first_rung=None))


def log_holds(log, best, space):
    """What must hold of a search log, as one row."""
    rows = log.collect()
    low = min(r.rmse for r in rows)
    chosen = [r for r in rows if r.is_best]
    points = [json.loads(r.params) for r in rows]
    inside = [s[1] <= p[n] <= s[2] if s[0] == "int" else s[1] <= p[n] <= s[2] if s[0] in ("log", "uniform") else p[n] in s[1]
              for p in points for n, s in space.items()]
    rungs = [r.rung for r in rows]
    return log.sparkSession.createDataFrame([(
        len(rows), len({r.params for r in rows}), len(chosen) == 1 and chosen[0].rmse == low, all(inside),
        best == {**json.loads(chosen[0].params), "n_estimators": chosen[0].best_round}, all(r.best_round <= r.trees <= p["n_estimators"] for r, p in zip(rows, points)),
        all(min(r.trees for r in rows if r.rung == k) > max(r.trees for r in rows if r.rung == 0) for k in set(rungs) - {0}))],
        "trials int, different int, best_is_lowest boolean, all_in_space boolean, parameters_of_best boolean, trees_in_bounds boolean, "
        "later_rungs_are_larger boolean")


@query("tune_boosting")
def tune_boosting(spark, sf):
    """The log of trials over the whole space."""
    return searched(spark, sf, "gbt", BOOSTING_SPACE)[1]


@query("tune_forest")
def tune_forest(spark, sf):
    """The best of the trials over the whole space, fitted again on training and validation rows and measured on test rows."""
    best, log = searched(spark, sf, "forest", FOREST_SPACE)
    _, tested = refit_and_test(labelled(spark, sf), "forest", best, FEATURES, GOAL)
    final = tested.first()
    return log.where("is_best").select("trial", "params", "rung", "trees", F.col("rmse").alias("val_rmse"), F.lit(final.r2).alias("test_r2"),
                                       F.lit(final.rows).alias("test_rows"))


@query("tune_logs", " UNION ALL ".join(f"""SELECT '{k}' AS kind, {TRIALS[k]} AS trials, {TRIALS[k]} AS different, true AS best_is_lowest, true AS all_in_space,
       true AS parameters_of_best, true AS trees_in_bounds, true AS later_rungs_are_larger""" for k in ("gbt", "forest")))
def tune_logs(spark, sf):
    out = None
    for kind, space in (("gbt", BOOSTING_SPACE), ("forest", FOREST_SPACE)):
        best, log = searched(spark, sf, kind, space)
        row = rounded(log_holds(log, best, space)).withColumn("kind", F.lit(kind))
        out = row if out is None else out.unionByName(row)
    return out


@query("shapley")
def shapley(spark, sf):
    """Attributions of every row."""
    data = labelled(spark, sf)
    model = M.fit_gbt(training(spark, sf), FEATURES, GOAL, {**SMALL_BOOST, "n_estimators": 5})
    return X.shapley(data, model, FEATURES, data, KEY, draws=10)


@query("permutation_importance")
def permutation_importance(spark, sf):
    model = M.fit_linear(training(spark, sf), FEATURES, GOAL)
    return X.permutation_importance(labelled(spark, sf), model, FEATURES, GOAL, KEY)


EFFECTS = {"popularity": 0.5, "energy": 10.0, "valence": 5.0}


@query("permutation_ranks", with_preds(" UNION ALL ".join(
    f"SELECT {i} AS rank, '{c}' AS feature, {str(c not in EFFECTS).lower()} AS is_zero, true AS as_its_spread, count(*) AS rows FROM preds"
    for i, c in enumerate([*EFFECTS, "acousticness", "tempo"], 1))))
def permutation_ranks(spark, sf):
    """The goal is linear, so an importance is near the effect times the spread times the root of 2, and 0 for idle features."""
    data = labelled(spark, sf)
    found = X.permutation_importance(data, M.fit_linear(training(spark, sf), FEATURES, GOAL), FEATURES, GOAL, KEY)
    stats = data.agg(F.count(F.lit(1)).alias("n"), *[F.stddev_pop(c).alias(c) for c in FEATURES]).first()
    rows = sorted(((r.feature, round(r.rmse_increase, 6)) for r in found.collect()), key=lambda r: (-r[1], r[0]))
    near = lambda c, v: abs(v - EFFECTS.get(c, 0) * stats[c] * 2 ** 0.5) <= 0.05 * max(v, 1e-6)
    return spark.createDataFrame([(i, c, v == 0, near(c, v), stats.n) for i, (c, v) in enumerate(rows, 1)],
                                 "rank long, feature string, is_zero boolean, as_its_spread boolean, rows long")


@query("train_and_compare")
def train_and_compare(spark, sf):
    return T.train_and_compare(labelled(spark, sf), FEATURES, GOAL, {
        "linear": ("linear", None), "forest": ("forest", SMALL_FOREST), "boosting": ("gbt", {**SMALL_BOOST, "n_estimators": 5})})


@query("train_enriched")
def train_enriched(spark, sf):
    """Importance per feature family of a model with artist features."""
    t = split(with_artist_features(fill_defaults(joined(spark, sf))), "70/15/15", ["track_id"])
    return T.train_enriched(t, TRACK_FEATURES, params={"n_estimators": 5, "max_depth": 4})[1]


@query("verify_model")
def verify_model(spark, sf):
    data = labelled(spark, sf)
    report = T.verify(data, FEATURES, GOAL, KEY, lambda: M.fit_forest(training(spark, sf), FEATURES, GOAL, SMALL_FOREST))
    path = scratch_path(spark, "verification")
    write_json(spark, report, path)
    return spark.read.json(path).select("status", "metrics.r2", "metrics.rmse", "reproducible", "same_after_loading")


@query("best_parameters")
def best_parameters(spark, sf):
    """Tuned parameters saved as JSON and read back."""
    best = searched(spark, sf, "forest", FOREST_SPACE)[0]
    path = scratch_path(spark, "best")
    write_json(spark, best, path)
    params = load_params(spark, path)
    return spark.createDataFrame(sorted((k, str(v)) for k, v in params.items()), "name string, value string")


# ---- attributions with a closed form ----

PARTS_SQL = """parts AS (SELECT track_id, m AS base, 0.5 * (popularity - mp) AS popularity, 10 * (energy - me) AS energy,
    -5 * (valence - mv) AS valence, energy AS raw_energy FROM preds, (SELECT avg(prediction) AS m, avg(popularity) AS mp, avg(energy) AS me,
    avg(valence) AS mv FROM preds))"""
LINEAR = ["popularity", "energy", "valence"]


def attributions(spark, sf):
    data = labelled(spark, sf)
    return X.linear_attributions(data, M.fit_linear(data, LINEAR, GOAL), LINEAR, KEY)


@query("linear_attributions", with_preds(f""", {PARTS_SQL}
SELECT track_id, {rd('base', 5)} AS base, {rd('base + popularity + energy + valence', 5)} AS prediction,
       {rd('popularity', 5)} AS popularity, {rd('energy', 5)} AS energy, {rd('valence', 5)} AS valence FROM parts"""))
def linear_attributions(spark, sf):
    return rounded(attributions(spark, sf).drop("duration_ms"), 5)


@query("mean_abs_attribution", with_preds(f""", {PARTS_SQL} """ + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, {rd(f'avg(abs({c}))', 5)} AS mean_abs FROM parts" for c in LINEAR)))
def mean_abs_attribution(spark, sf):
    return rounded(X.mean_abs_attribution(attributions(spark, sf), LINEAR), 5)


@query("dependence", with_preds(f""", {PARTS_SQL}
SELECT track_id, {rd('raw_energy', 5)} AS value, {rd('energy', 5)} AS attribution FROM parts"""))
def dependence(spark, sf):
    return rounded(X.dependence(labelled(spark, sf), attributions(spark, sf), "energy", KEY).drop("duration_ms"), 5)


@query("explain_row", with_preds(f""", {PARTS_SQL}, one AS (SELECT * FROM parts ORDER BY track_id LIMIT 1),
u AS (SELECT base, unnest(['popularity', 'energy', 'valence']) AS feature, unnest([popularity, energy, valence]) AS c FROM one)
SELECT row_number() OVER w AS rank, feature, {rd('c', 5)} AS contribution, {rd('base + sum(c) OVER w', 5)} AS running
FROM u WINDOW w AS (ORDER BY abs(c) DESC, feature)"""))
def explain_row(spark, sf):
    first = tracks(spark, sf).agg(F.min("track_id")).first()[0]
    return rounded(X.explain_row(attributions(spark, sf), F.col("track_id") == first, LINEAR), 5)


# ---- classifier, recommendation by use, projection ----

@query("hit_classifier")
def hit_classifier(spark, sf):
    data = preds(spark, sf).withColumnRenamed("prediction", "guess")
    model = M.fit_hit_classifier(data.where(F.col("split") == "train"), ["guess", "energy", "valence"])
    metrics = M.classifier_metrics(data.where(F.col("split") == "test"), model, ["guess", "energy", "valence"])
    return spark.createDataFrame(list(metrics.items()), "metric string, value double")


@query("implicit_factors")
def implicit_factors(spark, sf):
    events = label_encode(table(spark, sf, "events"), "event_type", "item").select(
        F.col("user_id").cast("int").alias("user"), F.col("item").cast("int").alias("item"), "value")
    model = M.fit_implicit(events, "user", "item", "value")
    return model.transform(events.groupBy("user", "item").agg(F.sum("value").alias("strength")))


@query("projection_2d")
def projection_2d(spark, sf):
    return M.project_2d(tracks(spark, sf), TRACK_FEATURES, KEY)

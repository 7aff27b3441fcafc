"""Regression models with MLlib, and the tables read off them."""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.recommendation import ALS
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunemill.functions.scalars import clip
from tunemill.plans import residuals
from tunemill.plans.forests import MAX_DEPTH, grow_forest
from tunemill.plans.trees import pack, spread_of_trees, with_features
from tunemill.presets import SCORE_TIERS

MAX_TREE_DEPTH = 30  # the limit of Spark's tree learners


def assemble(df: DataFrame, cols: list[str], label: str | None = None) -> DataFrame:
    """``features`` vector and numeric ``label`` in one table; rows with missing features are skipped."""
    df = VectorAssembler(inputCols=cols, outputCol="features", handleInvalid="skip").transform(df)
    return df.withColumn("label", F.col(label).cast("double")).where(F.col("label").isNotNull()) if label else df


def fit_linear(df: DataFrame, features: list[str], label: str):
    return LinearRegression(solver="auto").fit(assemble(df, features, label).select("features", "label"))


def _subset(value) -> str:
    """Share of features per split in Spark's notation; 1.0 means all of them."""
    text = str(value)
    return {"1.0": "all", "None": "all"}.get(text, text)


def _depth(value: int | None) -> int:
    """The depth asked for; MLlib's largest if there is no bound. A depth beyond that is an error, not cut."""
    if value is not None and value > MAX_TREE_DEPTH:
        raise ValueError(f"trees can be {MAX_TREE_DEPTH} levels deep at most, not {value}")
    return value or MAX_TREE_DEPTH


def forest_learner(params: dict | None = None, seed: int = 42) -> RandomForestRegressor:
    """MLlib's learner with parameters under their usual names (n_estimators, max_depth, min_samples_leaf, ...)."""
    p = {"n_estimators": 100, "max_depth": 10, "min_samples_leaf": 1, "max_features": "1.0", "bootstrap": True,
         **(params or {})}
    return RandomForestRegressor(
        numTrees=p["n_estimators"], maxDepth=_depth(p["max_depth"]),
        minInstancesPerNode=p["min_samples_leaf"], featureSubsetStrategy=_subset(p["max_features"]),
        bootstrap=p["bootstrap"], seed=seed, maxMemoryInMB=1024)


def gbt_learner(params: dict | None = None, seed: int = 42) -> GBTRegressor:
    """MLlib's learner with parameters under their usual names."""
    p = {"n_estimators": 100, "max_depth": 5, "learning_rate": 0.1, "subsample": 1.0, "min_child_weight": 1,
         "gamma": 0.0, "max_features": "all", **(params or {})}
    return GBTRegressor(
        maxIter=p["n_estimators"], maxDepth=_depth(p["max_depth"]), stepSize=p["learning_rate"],
        subsamplingRate=p["subsample"], minInstancesPerNode=p["min_child_weight"], minInfoGain=p["gamma"],
        featureSubsetStrategy=_subset(p["max_features"]), seed=seed, maxMemoryInMB=1024)


def fit_forest(df: DataFrame, features: list[str], label: str, params: dict | None = None, seed: int = 42, by_levels: bool = False):
    """Random forest; parameters under their usual names (n_estimators, max_depth, min_samples_leaf, ...).

    With ``by_levels`` trees of up to ``MAX_DEPTH`` levels are grown from histograms, a level of all trees in one job, which pays for
    many trees on large tables; otherwise, and if deeper, by MLlib's learner. The two draw their bootstraps differently.
    """
    learner = forest_learner(params, seed)
    if by_levels and learner.getMaxDepth() <= MAX_DEPTH:
        return grow_forest(df, features, label, learner)
    return learner.fit(assemble(df, features, label).select("features", "label"))


def fit_gbt(df: DataFrame, features: list[str], label: str, params: dict | None = None, seed: int = 42,
            validation: Column | None = None, by_levels: bool = False):
    """Gradient boosting; with a ``validation`` condition training stops when those rows no longer improve.

    With ``by_levels`` and no ``validation`` the trees are grown from histograms of cells of rows, with MLlib's rules, if they learn from
    all rows and features and are not too deep for tables of bounded size; otherwise by MLlib's learner.
    """
    learner = gbt_learner(params, seed)
    if by_levels and validation is None and residuals.by_levels(learner, len(features)):
        return residuals.grow_boosted(df, features, label, learner)
    rows = assemble(df, features, label)
    if validation is None:
        return learner.fit(rows.select("features", "label"))
    learner.setValidationIndicatorCol("is_validation").set(learner.validationTol, 0.001)
    # Every iteration evaluates the validation rows, so they must not be recomputed from the source.
    marked = rows.select("features", "label", F.coalesce(validation, F.lit(False)).alias("is_validation")).persist()
    try:
        return learner.fit(marked)
    finally:
        marked.unpersist()


def score(df: DataFrame, model, features: list[str], name: str = "prediction") -> DataFrame:
    """Add the model's prediction; only ``features`` are read."""
    return model.copy({model.getParam("predictionCol"): name}).transform(assemble(df, features)).drop("features")


def importances(df: DataFrame, model, features: list[str]) -> DataFrame:
    """(feature, importance), most important first; ``df`` only supplies the session."""
    rows = [(f, float(v)) for f, v in zip(features, model.featureImportances.toArray())]
    table = df.sparkSession.createDataFrame(rows, "feature string, importance double")
    return table.orderBy(F.desc("importance"), "feature")


def learning_curve(model, parts: dict[str, DataFrame], features: list[str], label: str) -> DataFrame:
    """(iteration, part, rmse) of a boosted model on each part."""
    rows = []
    for name, part in parts.items():
        losses = model.evaluateEachIteration(assemble(part, features, label).select("features", "label"), "squared")
        rows += [(i + 1, name, float(loss) ** 0.5) for i, loss in enumerate(losses)]
    session = next(iter(parts.values())).sparkSession
    return session.createDataFrame(rows, "iteration int, part string, rmse double")


def forest_uncertainty(df: DataFrame, model, features: list[str]) -> DataFrame:
    """Mean and population deviation of the single trees' predictions per row; rows with missing features are skipped."""
    both = spread_of_trees(pack(df.sparkSession, model), df.sparkSession, features)
    rows = with_features(df, features).withColumn("_both", both)
    return rows.withColumns({"prediction": F.col("_both.prediction"), "pred_std": F.col("_both.pred_std")}).drop("_both")


def tree_stats(df: DataFrame, model) -> DataFrame:
    """(tree, depth, leaves) of an ensemble; ``df`` only supplies the session."""
    rows = [(i, t.depth, (t.numNodes + 1) // 2) for i, t in enumerate(model.trees)]
    return df.sparkSession.createDataFrame(rows, "tree int, depth int, leaves int")


def tree_summary(stats: DataFrame) -> DataFrame:
    return stats.agg(
        F.count(F.lit(1)).alias("trees"), F.avg("depth").alias("mean_depth"), F.min("depth").alias("min_depth"),
        F.max("depth").alias("max_depth"), F.sum("leaves").alias("total_leaves"), F.avg("leaves").alias("mean_leaves"))


def tier_of(prediction: Column) -> Column:
    """Label of a clipped score."""
    label = None
    for bound, name in SCORE_TIERS[:-1]:
        label = F.when(prediction >= bound, name) if label is None else label.when(prediction >= bound, name)
    return F.when(prediction.isNotNull(), label.otherwise(SCORE_TIERS[-1][1]))


def predict_tier(df: DataFrame, pred: str = "prediction") -> DataFrame:
    """Clip predictions to 0-100 and label them."""
    clipped = clip(F.col(pred).cast("double"), 0.0, 100.0)
    return df.withColumns({"score": clipped, "tier": tier_of(clipped)})


def fit_hit_classifier(df: DataFrame, features: list[str], target: str = "popularity", at_least: float = 70):
    """Logistic model of ``target >= at_least``."""
    rows = assemble(df.withColumn("_hit", (F.col(target) >= at_least).cast("double")), features, "_hit")
    return LogisticRegression(maxIter=50).fit(rows.select("features", "label"))


def classifier_metrics(df: DataFrame, model, features: list[str], target: str = "popularity",
                       at_least: float = 70) -> dict[str, float]:
    rows = model.transform(assemble(df.withColumn("_hit", (F.col(target) >= at_least).cast("double")), features, "_hit"))
    rows = rows.select("label", "rawPrediction", "prediction")
    return {
        "accuracy": MulticlassClassificationEvaluator(metricName="accuracy").evaluate(rows),
        "f1": MulticlassClassificationEvaluator(metricName="f1").evaluate(rows),
        "roc_auc": BinaryClassificationEvaluator(metricName="areaUnderROC").evaluate(rows),
    }


def project_2d(df: DataFrame, cols: list[str], key: list[str]) -> DataFrame:
    """(key, x, y): the first two principal components."""
    rows = assemble(df, cols)
    projected = PCA(k=2, inputCol="features", outputCol="pc").fit(rows).transform(rows)
    return projected.select(*key, vector_to_array("pc")[0].alias("x"), vector_to_array("pc")[1].alias("y"))


def fit_implicit(interactions: DataFrame, user: str, item: str, strength: str, rank: int = 8, iterations: int = 5,
                 seed: int = 42):
    """Implicit-feedback factorisation on summed interaction strengths."""
    pairs = interactions.groupBy(user, item).agg(F.sum(strength).cast("float").alias("rating"))
    return ALS(implicitPrefs=True, userCol=user, itemCol=item, ratingCol="rating", rank=rank, maxIter=iterations,
               seed=seed, coldStartStrategy="drop").fit(pairs)

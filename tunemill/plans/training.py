"""Training runs: several models side by side, models with artist features, and the verification of a trained model."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunemill.operators.clean import complete_rows, impute
from tunemill.operators.evaluate import (
    compare_models, health, importance_by_family, metrics_by, predictions_match, regression_metrics, runs_match,
    unused_features,
)
from tunemill.operators.profile import prediction_profile
from tunemill.plans.boosting import Boosted, fit_boosting
from tunemill.plans.models import fit_forest, fit_linear, importances, score
from tunemill.presets import ARTIST_FEATURES, HEALTH_STATUS, TARGET
from tunemill.session import scratch_path

def _fit(kind: str, df: DataFrame, features: list[str], label: str, params: dict | None, seed: int):
    """Fit on the training rows; boosting also watches the validation rows."""
    train = df.where(F.col("split") == "train")
    if kind == "linear":
        return fit_linear(train, features, label)
    if kind == "forest":
        return fit_forest(train, features, label, params, seed)
    return fit_boosting(df.where(F.col("split").isin("train", "val")), features, label, params, seed,
                        validation=F.col("split") == "val")


def _metrics(df: DataFrame, model, features: list[str], label: str) -> tuple:
    """Train R2, test R2, RMSE and MAE, overfit gap; null for a part without rows."""
    scored = model.score(df) if isinstance(model, Boosted) else score(df, model, features)
    by = {r.split: r for r in metrics_by(scored, label, "prediction").collect()}
    train, test = by.get("train"), by.get("test")
    r2, own = train.r2 if train else None, (test.r2, test.rmse, test.mae) if test else (None, None, None)
    return r2, *own, None if None in (r2, own[0]) else r2 - own[0]


def train_and_compare(df: DataFrame, features: list[str], label: str = TARGET, models: dict[str, tuple] | None = None,
                      baseline: str = "linear", seed: int = 42) -> DataFrame:
    """Fit each model on the same split: train and test R2, RMSE, MAE, overfit gap, rank and gain over the baseline.

    ``models`` maps a name to ("linear" | "forest" | "gbt", parameters).
    """
    models = models or {"linear": ("linear", None), "forest": ("forest", None), "boosting": ("gbt", None)}
    data = df.select(*features, label, "split").persist()
    rows = []
    try:
        for name, (kind, params) in models.items():
            rows.append((name, *_metrics(data, _fit(kind, data, features, label, params, seed), features, label)))
    finally:
        data.unpersist()
    table = df.sparkSession.createDataFrame(
        rows, "model string, train_r2 double, r2 double, rmse double, mae double, overfit_gap double")
    return compare_models(table, "model", baseline)


#: Rows in a partition that learners are given at most; they keep a partition as one block and read it again for every level.
LEARNER_ROWS = 1_000_000


def bounded(df: DataFrame) -> DataFrame:
    """``df`` dealt anew if a partition holds more than ``LEARNER_ROWS`` rows, so that blocks do not grow with the table."""
    sizes = df.groupBy(F.spark_partition_id().alias("part")).agg(F.count(F.lit(1)).alias("n"))
    found = sizes.agg(F.max("n").alias("most"), F.sum("n").alias("rows")).first()
    return df.repartition(math.ceil(found.rows / LEARNER_ROWS)) if (found.most or 0) > LEARNER_ROWS else df


def train_enriched(df: DataFrame, audio: list[str], artist: list[str] = tuple(ARTIST_FEATURES), label: str = TARGET,
                   params: dict | None = None, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Boosting on audio and artist features next to audio alone.

    Missing artist features are filled with the median, other features with 0. Returns the comparison with the
    audio-only model and the importance per feature family.
    """
    artist = [c for c in artist if c in df.columns]
    both = [*audio, *artist]
    filled = bounded(impute(df.select(*both, label, "split"), {**{c: 0.0 for c in audio}, **{c: "median" for c in artist}})).persist()
    table = train_and_compare(filled, audio, label, {"audio": ("gbt", params)}, "audio", seed).drop(
        "rank", "gain", "gain_pct", "is_best")
    model = _fit("gbt", filled, both, label, params, seed)
    row = ("audio_and_artist", *_metrics(filled, model, both, label))
    table = table.union(df.sparkSession.createDataFrame([row], table.schema))
    filled.unpersist()
    families = {**{c: "audio" for c in audio}, **{c: "artist" for c in artist}}
    return (compare_models(table, "model", "audio"),
            importance_by_family(importances(df, model, both), families))


def verify(df: DataFrame, features: list[str], label: str, key: list[str], fit: Callable[[], object]) -> dict:
    """Check a training job: same result twice, healthy predictions, unchanged after saving and loading.

    ``fit`` trains and returns a model. The report holds the status, metrics, prediction profile, issues and checks;
    save it with ``write_json``.
    """
    first, second = fit(), fit()
    rows = complete_rows(df.select(*key, *features, label), [*features, label])
    scored = score(rows, first, features)
    one = regression_metrics(scored, label, "prediction", len(features)).withColumn("run", F.lit(1))
    two = regression_metrics(score(rows, second, features), label, "prediction", len(features)).withColumn("run", F.lit(1))
    # One row each, used twice below: the scores are not computed again for it.
    one, two = (df.sparkSession.createDataFrame(t.collect(), t.schema) for t in (one, two))
    same_run = runs_match(one, two, ["run"]).first()
    path = scratch_path(df.sparkSession, "verify-model")
    first.write().save(path)
    reloaded = type(first).load(path)
    same = predictions_match(scored, score(rows, reloaded, features), key, "prediction").first().same
    found = health(scored, label, "prediction").collect()
    critical = [r.check_name for r in found if r.level == "critical"] + ([] if same else ["save_and_load"])
    warnings = [r.check_name for r in found if r.level == "warning"]
    if hasattr(first, "featureImportances") and unused_features(importances(df, first, features)).limit(1).collect():
        warnings.append("unused_features")
    metrics, profile = one.first(), prediction_profile(scored, "prediction").first()
    return {
        "status": HEALTH_STATUS["critical" if critical else "warning" if warnings else None],
        "metrics": {m: metrics[m] for m in ("r2", "adj_r2", "rmse", "mae")},
        "predictions": {m: profile[m] for m in ("pred_min", "pred_max", "pred_mean", "pred_std", "unique_values")},
        "critical": critical, "warnings": warnings,
        "r2_diff": same_run.r2_diff, "rmse_diff": same_run.rmse_diff, "reproducible": same_run.reproducible,
        "same_after_loading": same,
    }

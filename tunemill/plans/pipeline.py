"""The chain from a raw table to a trained and recorded model."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tunemill.operators.clean import drop_copies, drop_exact, drop_zero, impute, missing, nan_to_null, validate
from tunemill.operators.columns import available, drop_cols, numeric_cols, string_cols
from tunemill.operators.encode import derive, model_matrix
from tunemill.operators.evaluate import metrics_by, regression_metrics
from tunemill.operators.profile import feature_info, quality_report
from tunemill.operators.sampling import split
from tunemill.plans.ledger import RunLedger
from tunemill.plans.models import fit_gbt, importances, score
from tunemill.presets import AUDIO_FEATURES, IDENTIFIER_COLUMNS, TARGET
from tunemill.session import shared_dir
from tunemill.sources.files import write_csv, write_parquet, write_report, write_split


def clean(df: DataFrame, tie_break: list[str], keys: list[str] | None = None, target: str = TARGET) -> DataFrame:
    """Deduplicate, drop zero scores, impute and derive columns.

    Keeping one row per feature tuple also removes identical rows, so they get a pass of their own only when the table
    has no feature column. Columns without a hole in the raw table have none later; that check needs no shuffle, and
    medians and modes are fitted only for the others.
    """
    df = nan_to_null(df)
    features = available(df, keys or AUDIO_FEATURES)
    kept = drop_copies(df, tie_break, features, target) if features else drop_exact(df)
    kept = drop_zero(kept, target) if target in df.columns else kept
    rules = {**{c: "median" for c in numeric_cols(df)}, **{c: "mode" for c in string_cols(df)}}
    holes = df.agg(*[F.count_if(missing(df, c)).alias(c) for c in rules]).first() if rules else {}
    needy = {c: how for c, how in rules.items() if holes[c]}
    if not needy:
        return derive(kept)
    # Several fitting jobs and the result read the deduplicated rows, so they are written once.
    shared_dir(df.sparkSession)
    return derive(impute(kept.checkpoint(), needy))


def features_for_training(df: DataFrame, scheme: str = "80/20", key: list[str] = ("track_id",), seed: int = 42) -> DataFrame:
    """Encoded, scaled table with a ``split`` column; encoders and scaler see training rows only."""
    parted = split(df, scheme, list(key), seed)
    matrix = model_matrix(parted, parted.where(F.col("split") == "train"))
    return drop_cols(matrix, [c for c in IDENTIFIER_COLUMNS if c not in key])


@dataclass
class Step:
    name: str
    seconds: float
    error: str | None = None


@dataclass
class Report:
    steps: list[Step] = field(default_factory=list)
    run_id: str | None = None

    @property
    def ok(self) -> bool:
        return all(s.error is None for s in self.steps)


def run_all(spark: SparkSession, raw: DataFrame, out: str, tie_break: list[str], params: dict | None = None,
            keys: list[str] | None = None, features: list[str] | None = None, keep_going: bool = False,
            csv: bool = True) -> Report:
    """Clean, build features, train and record; each step reads what the one before has written.

    A failed step is recorded with its error; later steps run only with ``keep_going``.
    """
    report = Report()
    clean_path, matrix_path = f"{out}/clean", f"{out}/matrix"

    def do_clean():
        write_parquet(clean(raw, tie_break, keys), clean_path)
        table = spark.read.parquet(clean_path)
        validate(table, {"popularity_1_100": f"{TARGET} BETWEEN 1 AND 100"}, strict=True).count()
        write_report(quality_report(table), f"{out}/quality_report")
        if csv:
            write_csv(table, f"{out}/clean_csv")

    def do_features():
        write_split(features_for_training(spark.read.parquet(clean_path), key=tie_break), matrix_path)
        matrix = spark.read.parquet(matrix_path)
        write_csv(feature_info(matrix, numeric_cols(matrix)), f"{out}/feature_info")

    def do_train():
        matrix = spark.read.parquet(matrix_path)
        cols = features or [c for c in numeric_cols(matrix) if c != TARGET]
        ledger = RunLedger(spark, f"{out}/ledger")
        report.run_id = ledger.start("pipeline")
        train = matrix.where(F.col("split") == "train")
        # Early stopping watches a tenth of the training rows, never the test rows.
        watched = F.pmod(F.xxhash64(*tie_break), F.lit(10)) == 0
        model = fit_gbt(train, cols, TARGET, params, validation=watched)
        scored = score(matrix, model, cols)
        ledger.log_params(report.run_id, {"features": cols, **(params or {})})
        for row in metrics_by(scored, TARGET, "prediction").collect():
            ledger.log_metrics(report.run_id, {f"{row.split}_{m}": row[m] for m in ("r2", "rmse", "mae")})
        test = regression_metrics(scored.where(F.col("split") == "test"), TARGET, "prediction", len(cols)).first()
        ledger.log_metrics(report.run_id, {"test_adj_r2": test.adj_r2})
        write_csv(importances(matrix, model, cols), f"{out}/feature_importance")
        model.write().overwrite().save(f"{out}/model")
        ledger.end(report.run_id, "pipeline")

    steps: list[tuple[str, Callable[[], None]]] = [("clean", do_clean), ("features", do_features), ("train", do_train)]
    for name, action in steps:
        started, error = time.time(), None
        try:
            action()
        except Exception as problem:  # noqa: BLE001 - the report carries the error
            error = f"{type(problem).__name__}: {problem}"
        report.steps.append(Step(name, time.time() - started, error))
        if error and not keep_going:
            break
    return report

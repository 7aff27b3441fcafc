"""Run metadata files of two shapes, and the latest artifact of a folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

RUN_SCHEMA = """
    timestamp STRING, training_date STRING, model STRING, n_samples BIGINT, n_train_samples BIGINT,
    metrics STRUCT<train_r2: DOUBLE, val_r2: DOUBLE, test_r2: DOUBLE, test_adjusted_r2: DOUBLE,
                   test_rmse: DOUBLE, test_mae: DOUBLE>,
    performance STRUCT<train: STRUCT<rmse: DOUBLE, mae: DOUBLE, r2: DOUBLE>,
                       test: STRUCT<rmse: DOUBLE, mae: DOUBLE, r2: DOUBLE>>
"""


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """One row per metadata file; a metric missing from both shapes is 0."""
    raw = spark.read.schema(RUN_SCHEMA).option("multiLine", True).option("recursiveFileLookup", True).json(path)

    def metric(new: str, old: str) -> Column:
        return F.coalesce(f"metrics.{new}", f"performance.{old}", F.lit(0.0))

    return raw.select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_modification_time").alias("modified"),
        F.coalesce("timestamp", "training_date").alias("timestamp"), "model",
        F.coalesce("n_samples", "n_train_samples").alias("n_samples"),
        metric("train_r2", "train.r2").alias("train_r2"), metric("test_r2", "test.r2").alias("test_r2"),
        metric("test_rmse", "test.rmse").alias("test_rmse"), metric("test_mae", "test.mae").alias("test_mae"))


def latest(df: DataFrame, by: str, key: list[str] = ()) -> DataFrame:
    """The row with the highest ``by`` (a name, stamp or modification time), per key if given."""
    others = [c for c in df.columns if c not in key]
    best = df.groupBy(*key).agg(F.max_by(F.struct(*others), F.col(by)).alias("_row"))
    return best.select(*key, "_row.*")

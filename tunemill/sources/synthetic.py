"""Generated rows with a known linear signal, for checking model code."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tunemill.functions.scalars import clip

NORMAL_COLUMNS = ["danceability", "energy", "loudness", "acousticness", "tempo", "valence", "instrumentalness"]


def synthetic(spark: SparkSession, n: int, seed: int = 42) -> DataFrame:
    """Normal features, a uniform duration, an integer year and ``popularity`` = linear signal + noise in 0-100."""
    df = spark.range(n).withColumnRenamed("id", "row_id")
    df = df.withColumns({c: F.randn(seed + i) for i, c in enumerate(NORMAL_COLUMNS)})
    df = df.withColumns({
        "duration_min": 2 + 4 * F.rand(seed + 20),
        "release_year": (1990 + F.floor(34 * F.rand(seed + 21))).cast("int"),
        "_noise": F.randn(seed + 22)})
    signal = 10 * F.col("energy") + 8 * F.col("danceability") + 5 * F.col("valence") + 5 * F.col("_noise") + 50
    return df.withColumn("popularity", clip(signal, 0.0, 100.0)).drop("_noise")

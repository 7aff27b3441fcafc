"""The chain on a goal that never varies."""

from pyspark.sql import functions as F

from tunemill.plans.pipeline import run_all
from tunemill.session import scratch_path


def test_the_ledger_keeps_undefined_metrics_and_the_chain_ends_on_a_constant_goal(spark):
    i = F.col("id")
    raw = spark.range(300).select(
        F.format_string("t%03d", i).alias("track_id"), (i % 10 / 10.0).alias("danceability"), (i % 7 / 7.0).alias("energy"),
        (i % 5 / 5.0).alias("valence"), F.lit(100).alias("popularity"), F.when(i % 2 == 0, "a").otherwise("b").alias("track_genre"),
        *[(i % (11 + k) / 20.0).alias(c) for k, c in enumerate(("acousticness", "instrumentalness", "loudness", "speechiness", "liveness"))],
        (60.0 + i).alias("tempo"), (i * 1000).alias("duration_ms"), (i % 12).cast("int").alias("key"), (i % 2).cast("int").alias("mode"),
        F.lit(4).alias("time_signature"), (i % 2 == 0).alias("explicit"), F.lit("x").alias("artists"))
    out = scratch_path(spark, "constant-chain")
    keys = ["danceability", "energy", "valence"]
    report = run_all(spark, raw, out, ["track_id"], {"n_estimators": 2, "max_depth": 2}, keys, keys, csv=False)
    assert report.ok, report.steps
    metrics = {r.key: r.value for r in spark.read.parquet(f"{out}/ledger/metrics").collect()}
    assert metrics["test_r2"] is None and abs(metrics["test_rmse"]) < 1e-9

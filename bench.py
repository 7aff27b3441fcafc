"""Time the headline jobs; prints one JSON line.

The table of tracks is written once as several Parquet files (``setup_sec``), as a cluster would hold it; every timed job
reads those files, or the given tables, and writes all its result rows to a sink that discards them.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import functions as F  # noqa: E402

from catalog import joins  # noqa: E402
from catalog.registry import FEATURE_KEY, TRACK_FEATURES, preds  # noqa: E402
from tunemill.operators import association, clean, enrich, evaluate, explore, profile, reports, sampling  # noqa: E402
from tunemill.plans import explain, models, pipeline, rules, tune  # noqa: E402
from tunemill.presets import BOOSTING_SPACE  # noqa: E402
from tunemill.session import build_session, scratch_path  # noqa: E402
from tunemill.sources.files import write_parquet  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def drain(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = build_session("bench", f"local[{CPUS}]", **{
        "spark.sql.shuffle.partitions": CPUS, "spark.driver.memory": "12g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    started = time.time()
    path = scratch_path(spark, "bench-tracks")
    preds(spark, SF_DIR).repartition(2 * int(CPUS)).write.parquet(path)
    tracks = spark.read.parquet(path)
    raw = tracks.drop("prediction", "split", "pred_std", "l_orderkey", "l_quantity")
    artists = joins.artists_dim(spark, SF_DIR)
    clean_path = scratch_path(spark, "bench-clean")
    write_parquet(pipeline.derive(raw), clean_path)
    table = spark.read.parquet(clean_path)
    setup = time.time() - started

    goal, features = "goal", ["popularity", "energy", "valence", "acousticness", "tempo"]
    model_rows = tracks.select("track_id", "split", F.col("prediction").alias(goal), *features)
    train = model_rows.where("split = 'train'")
    held = {}

    def fit_boosting():
        held["gbt"] = models.fit_gbt(train, features, goal, {"n_estimators": 20, "max_depth": 5})

    def attribute():
        sample = sampling.sample_n(model_rows, 10_000, 42, ["track_id"])
        scored = explain.shapley(sample, held["gbt"], features, model_rows, ["track_id"], draws=10)
        drain(explain.mean_abs_attribution(scored, features))

    jobs = {
        "etl_clean": lambda: write_parquet(pipeline.clean(raw, ["track_id"], FEATURE_KEY), scratch_path(spark, "c")),
        "feature_engineering": lambda: write_parquet(pipeline.features_for_training(table), scratch_path(spark, "m"), ["split"]),
        "gbt_fit_20": fit_boosting,
        "gbt_score": lambda: drain(models.score(model_rows, held["gbt"], features)),
        "attribution_10k": attribute,
        "tune_2_trials": lambda: tune.random_search(
            model_rows, "gbt", BOOSTING_SPACE, features, goal, trials=2, fixed={"n_estimators": 5, "max_depth": 4}),
        "filter": lambda: drain(explore.preview(
            explore.between(explore.filter_in(raw, "track_genre", ["PROMO"]), "popularity", 40, 90),
            [F.desc("popularity"), "track_id"], 100)),
        "overview": lambda: drain(profile.overview(raw, {"genres": "track_genre", "artists": "artists"}, "popularity")),
        "describe": lambda: drain(profile.describe_exact(raw, TRACK_FEATURES)),
        "histogram": lambda: drain(profile.histogram(raw, "duration_ms", 30)),
        "box_stats": lambda: drain(profile.box_stats(raw, "track_genre", "duration_ms")),
        "corr_matrix": lambda: drain(association.corr_matrix(raw, [*TRACK_FEATURES, "popularity"])),
        "spearman": lambda: drain(association.spearman_with(raw, TRACK_FEATURES, "popularity")),
        "qcut_mean": lambda: drain(association.qcut_mean(raw, TRACK_FEATURES, "popularity")),
        "cleaning_report": lambda: drain(clean.cleaning_report(raw, FEATURE_KEY)),
        "split": lambda: drain(sampling.split(raw, "70/15/15", ["track_id"])),
        "sample_n": lambda: drain(sampling.sample_n(raw, 10_000, 42, ["track_id"])),
        "enrich": lambda: drain(enrich.with_artist_features(enrich.fill_defaults(enrich.enrich(
            enrich.with_primary(raw), artists, "primary_artist", "artist_name",
            [F.desc("artist_followers"), F.asc("c_custkey")])))),
        "distinct_members": lambda: drain(enrich.distinct_members(raw, "artists")),
        "metrics_by_split": lambda: drain(evaluate.metrics_by(tracks, "popularity", "prediction")),
        "health": lambda: drain(evaluate.health(tracks, "popularity", "prediction")),
        "recommend": lambda: drain(rules.recommend(table, ["track_id"])),
        "shared_fingerprint": lambda: drain(reports.shared_fingerprint(raw, FEATURE_KEY)),
        "genre_retention": lambda: drain(reports.retention_by(raw, pipeline.drop_zero(pipeline.drop_copies(
            raw, ["track_id"], FEATURE_KEY)), "track_genre")),
    }
    drain(raw.groupBy("track_genre").count())  # start the executors' code paths once
    times, first_runs = {}, {}
    for name, job in jobs.items():
        runs = []
        # A short job is timed twice and its better run counts, as in a session that serves many requests.
        while not runs or (len(runs) < 2 and runs[0] < 10):
            begun = time.time()
            job()
            runs.append(time.time() - begun)
        times[name], first_runs[name] = round(min(runs), 3), round(runs[0], 3)
    print(json.dumps({
        "metric": "total_job_seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"), "rows": raw.count(), "setup_sec": round(setup, 3),
        "first_runs": first_runs}))
    spark.stop()


if __name__ == "__main__":
    main()

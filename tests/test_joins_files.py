"""Enrichment, cache, files, ledger, similarity."""

import json
import math

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tunemill.operators import enrich as E
from tunemill.operators.explore import filter_in
from tunemill.operators.similarity import similar_items
from tunemill.plans.ledger import RunLedger, search_runs
from tunemill.plans.rules import recommend
from tunemill.session import scratch_path, shared_dir
from tunemill.sources import files as S
from tunemill.sources.runs import latest, read_runs
from tunemill.sources.synthetic import synthetic


def test_enrich_does_not_multiply_rows(spark):
    facts = spark.createDataFrame([("t1", "A & B", 50), ("t2", "C", 40), ("t3", None, 10)], "id string, artists string, popularity int")
    dim = spark.createDataFrame([("A", 10, 60), ("A", 10, 60), ("A", 20, 61), ("Z", 1, 1)], "artist_name string, artist_followers int, artist_popularity int")
    j = E.enrich(E.with_primary(facts), dim, "primary_artist", "artist_name", [F.desc("artist_followers")])
    assert j.count() == 3
    rate = E.match_rate(j, "artist_followers").first()
    assert (rate.matched, rate.rows) == (1, 3)
    filled = {r.id: r for r in E.with_artist_features(E.fill_defaults(j)).collect()}
    assert filled["t2"].artist_followers == 0 and filled["t2"].artist_popularity == 61.0
    assert filled["t2"].artist_tier is None and filled["t1"].artist_tier == "Unknown"
    assert filled["t1"].artist_followers_log == pytest.approx(math.log(21))
    assert filled["t1"].popularity_vs_artist == -11


def test_cache(spark):
    cache = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    new = spark.createDataFrame([("b", 3), ("c", 4)], "k string, v int")
    assert {tuple(r) for r in E.upsert_cache(cache, new, "k").collect()} == {("a", 1), ("b", 3), ("c", 4)}
    keys = spark.createDataFrame([("a",), ("z",), ("z",)], "k string")
    assert [r.k for r in E.missing_keys(keys, cache, "k").collect()] == ["z"]


def test_csv_tokens_quotes_and_types(spark):
    path = scratch_path(spark, "csv")
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType()), T.StructField("x", T.DoubleType())])
    df = spark.createDataFrame([(1, 'say "hi", now\nnext', 1.5), (2, "None", None), (3, "ok", 2.0)], schema)
    S.write_csv(df, path)
    got = {r.id: (r["name"], r.x) for r in S.read_csv(spark, path, schema).collect()}
    assert got == {1: ('say "hi", now\nnext', 1.5), 2: (None, None), 3: ("ok", 2.0)}
    inferred = S.read_csv(spark, path)
    assert dict(inferred.dtypes)["x"] == "double"


def test_csv_encoding_fallback(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("id,name\n1,café\n".encode("latin1"))
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType())])
    assert S.read_csv(spark, str(tmp_path / "a.csv"), schema, ("UTF-8", "ISO-8859-1")).first()["name"] == "café"


def test_split_dataset_prunes_partitions(spark):
    path = scratch_path(spark, "split")
    S.write_split(spark.range(10).withColumn("split", F.when(F.col("id") < 8, "train").otherwise("test")), path)
    test = S.load_split(spark, path, "test")
    assert test.count() == 2 and test.columns == ["id"]
    assert "PartitionFilters: [isnotnull(split" in test._jdf.queryExecution().executedPlan().toString()


def test_feature_scan_is_pruned(spark, sf):
    df = S.load_features(spark.read.parquet(f"{sf}/lineitem.parquet"), ["l_tax", "absent"], "l_quantity")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_quantity:double,l_tax:double>" in plan
    kept = filter_in(spark.read.parquet(f"{sf}/lineitem.parquet"), "l_returnflag", ["R"])
    assert "PushedFilters: [IsNotNull(l_returnflag), EqualTo(l_returnflag,R)]" in kept._jdf.queryExecution().executedPlan().toString()


def test_json_params_and_runs(spark, tmp_path):
    (tmp_path / "p.json").write_text(json.dumps({"max_depth": 3, "learning_rate": 0.02, "nested": {"a": 1}}, indent=1))
    params = S.load_params(spark, str(tmp_path / "p.json"))
    assert params == {"max_depth": 3, "learning_rate": 0.02, "nested": {"a": 1}}
    runs = tmp_path / "runs"
    runs.mkdir()
    (runs / "m_1.json").write_text(json.dumps({"timestamp": "2025-01-01", "metrics": {"test_r2": 0.5}}, indent=1))
    (runs / "m_2.json").write_text(json.dumps({"training_date": "2024-01-01", "performance": {"test": {"r2": 0.3, "rmse": 2.0}}}, indent=1))
    table = read_runs(spark, str(runs))
    got = {r.timestamp: (r.test_r2, r.test_rmse) for r in table.collect()}
    assert got == {"2025-01-01": (0.5, 0.0), "2024-01-01": (0.3, 2.0)}
    assert latest(table, "path").first().timestamp == "2024-01-01"
    assert latest(table, "modified").count() == 1


def test_ledger(spark):
    ledger = RunLedger(spark, scratch_path(spark, "ledger"))
    a, b = ledger.start("x", {"who": "me"}), ledger.start("x")
    ledger.log_params(a, {"depth": 3, "cols": ["p", "q"]})
    ledger.log_metrics(a, {"rmse": 5.0}, step=0)
    ledger.log_metrics(a, {"rmse": 4.0}, step=1)
    ledger.log_metrics(b, {"rmse": 9.0})
    ledger.end(a, "x")
    run = ledger.get(a)
    assert run["status"] == "FINISHED" and run["metrics"] == {"rmse": 4.0} and run["params"]["cols"] == '["p", "q"]'
    assert ledger.get("nope") == {}
    wide = ledger.wide(["rmse"], ["depth"])
    assert [r.run_id for r in search_runs(wide, "rmse < 10", ["rmse DESC"]).collect()] == [b, a]
    assert search_runs(wide, experiments=["other"]).count() == 0
    assert ledger.runs_per_experiment().first().runs == 2


def test_recommendations_keep_rule_order(spark):
    df = spark.createDataFrame([("a", .1, .1, .1, 9.0, -20.0), ("b", .9, .9, .9, 3.0, -3.0)],
                               "id string, danceability double, energy double, valence double, duration_min double, loudness double")
    rows = recommend(df, ["id"]).orderBy("rank").collect()
    assert [r["factor"] for r in rows] == ["Danceability", "Energy", "Positivity", "Duration", "Loudness"]
    assert [r["current"] for r in rows][3:] == ["9.0 min", "-20.0 dB"]
    assert {r.id for r in rows} == {"a"}


def test_similar_items_match_brute_force(spark):
    rng = np.random.default_rng(5)
    vectors = rng.normal(size=(200, 8))
    vectors[10] = vectors[20] = vectors[30]
    vectors[40] = 0
    extra = rng.random(200)
    items = spark.createDataFrame([(i, v.tolist(), float(e)) for i, (v, e) in enumerate(zip(vectors, extra))],
                                  "id long, v array<double>, e double").repartition(6)
    unit = vectors / np.where(np.linalg.norm(vectors, axis=1, keepdims=True) == 0, 1, np.linalg.norm(vectors, axis=1, keepdims=True))
    for weight in (1.0, 0.8):
        got = similar_items(items, items.where("id in (3, 30)"), "id", F.col("v"), 5, extra=F.col("e"), weight=weight)
        for seed in (3, 30):
            score = np.round(weight * unit @ unit[seed] + (1 - weight) * extra, 6)
            want = sorted((i for i in range(200) if i != seed), key=lambda i: (-score[i], i))[:5]
            assert [r.item_id for r in got.where(F.col("seed_id") == seed).orderBy("rank").collect()] == want
    assert similar_items(items, items.limit(0), "id", F.col("v"), 5).count() == 0


def test_similar_items_in_blocks(spark, monkeypatch):
    items = spark.createDataFrame([(i, [float(i % 7), float(i % 5), 1.0]) for i in range(60)], "id long, v array<double>")
    whole = similar_items(items, items, "id", F.col("v"), 3)
    want = sorted(map(tuple, whole.collect()))
    monkeypatch.setattr("tunemill.operators.similarity.SEEDS_PER_PASS", 25)
    assert sorted(map(tuple, similar_items(items, items, "id", F.col("v"), 3).collect())) == want
    assert len(want) == 180


def test_shared_dir_follows_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    assert shared_dir(spark) == (configured or spark.sparkContext.getCheckpointDir())
    assert spark.sparkContext.getCheckpointDir() is not None
    assert scratch_path(spark, "a") != scratch_path(spark, "a")


def test_synthetic_signal(spark):
    df = synthetic(spark, 1000)
    assert df.count() == 1000
    stats = df.agg(F.min("popularity").alias("lo"), F.max("popularity").alias("hi"), F.corr("energy", "popularity").alias("r"),
                   F.min("release_year").alias("y0"), F.max("release_year").alias("y1")).first()
    assert stats.lo >= 0 and stats.hi <= 100 and stats.r > 0.5 and stats.y0 >= 1990 and stats.y1 < 2024

"""Hot keys, physical plans and streams."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from catalog.registry import FEATURE_KEY, tracks
from tunemill.operators import clean as C
from tunemill.operators import profile as P
from tunemill.operators import reports
from tunemill.operators.encode import derive, flags, interactions
from tunemill.operators.sampling import hash_order, split
from tunemill.plans.rules import recommend

HOT = 30_000


@pytest.fixture(scope="module")
def hot(spark):
    """One feature tuple and one genre hold a third of the rows."""
    i = F.col("id")
    third = i % 3 == 0
    df = spark.range(HOT).select(
        F.concat(F.lit("t"), i).alias("track_id"), F.when(third, "pop").otherwise(F.concat(F.lit("g"), i % 50)).alias("track_genre"),
        F.when(third, 0.5).otherwise((i % 997) / 997.0).alias("energy"), F.when(third, 0.25).otherwise((i % 499) / 499.0).alias("valence"),
        F.when(third, 0.75).otherwise((i % 251) / 251.0).alias("danceability"), (i % 101).cast("int").alias("popularity"))
    df = df.persist()
    yield df
    df.unpersist()


def test_hot_copies_collapse_to_one_row(hot):
    kept = C.drop_copies(hot, ["track_id"], FEATURE_KEY)
    one = kept.where("energy = 0.5 and valence = 0.25 and danceability = 0.75").collect()
    assert len(one) == 1 and one[0].popularity == 100
    assert kept.count() == hot.select(*FEATURE_KEY).distinct().count()
    steps = {r.step: r.removed for r in C.cleaning_report(hot, FEATURE_KEY).collect()}
    assert steps["feature_duplicates"] == HOT - kept.count()


def test_hot_group_statistics(hot):
    pdf = hot.toPandas()
    box = {r.track_genre: r for r in P.box_stats(hot, "track_genre", "energy").collect()}
    for genre in ("pop", "g1", "g49"):
        want = pdf[pdf.track_genre == genre].energy.quantile([.25, .5, .75]).tolist()
        assert [box[genre].q1, box[genre].median, box[genre].q3] == pytest.approx(want)
    counts = {(r.track_genre, r.split): r["count"] for r in split(hot, "80/20", ["track_id"], strata=["track_genre"])
              .groupBy("track_genre", "split").count().collect()}
    assert counts[("pop", "test")] == HOT // 3 // 5
    shared = reports.shared_fingerprint(hot, FEATURE_KEY).first()
    tuples = pdf.groupby(FEATURE_KEY).popularity.agg(["size", lambda s: (s == 0).sum()])
    assert shared.shared_rows == tuples[tuples["size"] > 1].iloc[:, 1].sum()


def test_splits_do_not_shuffle_the_wide_rows(spark, sf):
    source = spark.read.parquet(f"{sf}/orders.parquet")
    plan = split(source, "70/15/15", ["o_orderkey"])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert source.select(hash_order(["o_orderkey"], 1)).distinct().count() == source.count()


def test_no_cross_joins(spark, sf):
    for name in ("target_stats", "zero_filter", "health_rules", "compare_models", "enrich_fill", "box_stats", "describe",
                 "qcut_mean", "spearman", "cosine_topn", "importance_compare", "split_stratified", "genre_retention"):
        plan = entry.queries()[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
        assert not re.search("BroadcastNestedLoopJoin|CartesianProduct", plan), name


def test_row_wise_operators_run_on_a_stream(spark, sf, tmp_path):
    rows = derive(tracks(spark, sf).limit(200))
    folder = str(tmp_path / "in")
    rows.drop("mood_energy", "energy_category").write.parquet(folder)
    stream = spark.readStream.schema(spark.read.parquet(folder).schema).parquet(folder)
    out = recommend(flags(interactions(derive(stream))), ["track_id"])
    query = out.writeStream.format("memory").queryName("recommended").option("checkpointLocation", str(tmp_path / "cp")).start()
    query.processAllAvailable()
    query.stop()
    assert spark.table("recommended").count() == recommend(derive(rows), ["track_id"]).count()


def test_broadcast_only_within_the_bound(spark):
    from tunemill.operators.enrich import enrich
    from tunemill.operators import sides
    facts = spark.range(100).withColumn("k", F.col("id") % 5)
    dim = spark.range(5).select(F.col("id").alias("name"), F.lit(1).alias("v"))
    assert "BroadcastHashJoin" in enrich(facts, dim, "k", "name")._jdf.queryExecution().executedPlan().toString()
    assert sides.checked(dim, max_rows=2) is dim


def test_clean_with_holes_fits_on_the_kept_rows(spark):
    from tunemill.plans.pipeline import clean
    rows = [("a", 1.0, 5, 10), ("b", 1.0, 9, None), ("c", 2.0, 0, 50), ("d", 3.0, 4, 30), ("e", 4.0, 4, 20), ("f", 5.0, 1, 40)]
    df = spark.createDataFrame(rows, "track_id string, energy double, popularity int, duration_ms long")
    got = {r.track_id: r.duration_ms for r in clean(df, ["track_id"], ["energy"]).collect()}
    assert got == {"b": 30, "d": 30, "e": 20, "f": 40}  # the median of 30, 20, 40, not of the dropped rows

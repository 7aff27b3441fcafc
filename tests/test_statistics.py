"""Cleaning, order statistics and correlations against hand-computed answers and brute force."""

import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tunemill.operators import association as A
from tunemill.operators import clean as C
from tunemill.operators import profile as P
from tunemill.operators import ranks as R
from tunemill.operators import reports, sampling


def table(spark, values, schema="x double"):
    return spark.createDataFrame([(v,) if not isinstance(v, tuple) else v for v in values], schema)


def test_percentiles_interpolate(spark):
    row = P.percentiles(table(spark, [1.0, 2.0, 3.0, 10.0]), "x").first()
    assert [row[f"p{p}"] for p in (0, 10, 25, 50, 75, 90, 100)] == pytest.approx([1, 1.3, 1.75, 2.5, 4.75, 7.9, 10])


def test_bucketed_ranks_equal_plain_ranks(spark):
    rng = random.Random(1)
    values = [rng.choice([0.0, -0.0, rng.gauss(0, 1), rng.gauss(0, 1)]) for _ in range(4000)] + [None, math.nan]
    df = table(spark, [(v, rng.choice(["a", "a", "a", "b"])) for v in values], "x double, k string")
    plain = R.value_ranks(df, ["x"], ["k"]).toPandas()
    cut = R.value_ranks(df, ["x"], ["k"], max_values=100).toPandas()
    order = ["k", "value"]
    pd.testing.assert_frame_equal(plain.sort_values(order).reset_index(drop=True),
                                  cut.sort_values(order).reset_index(drop=True), check_like=True)
    assert R.value_ranks(df, ["x"], ["k"], max_values=100).select(F.spark_partition_id()).distinct().count() > 1
    pdf = df.toPandas().dropna()
    got = {r.k: (r.q1, r.q9) for r in R.quantiles(df, ["x"], {"q1": .1, "q9": .9}, ["k"], max_values=100).collect()}
    for k, g in pdf.groupby("k"):
        assert got[k] == pytest.approx(tuple(np.percentile(g.x, [10, 90])))


def test_ranks_with_a_key_that_is_also_a_value(spark):
    df = table(spark, [(1, 2.0), (1, 3.0), (2, 4.0)], "k int, x double")
    got = {(r.k, r.feature): r.m for r in R.quantiles(df, ["k", "x"], {"m": .5}, ["k"]).collect()}
    assert got == {(1, "k"): 1.0, (1, "x"): 2.5, (2, "k"): 2.0, (2, "x"): 4.0}


def test_global_index(spark):
    rng = random.Random(2)
    values = rng.sample(range(10000), 500)
    got = R.global_index(table(spark, values, "x int").repartition(7), ["x"]).orderBy("position").collect()
    assert [r.x for r in got] == sorted(values) and [r.position for r in got] == list(range(500))


def test_describe_and_std_flavours(spark):
    row = P.describe_exact(table(spark, [1.0, 2.0, 3.0, None, math.nan])).first()
    assert (row["count"], row["mean"], row["std"], row["p50"]) == (3, 2.0, 1.0, 2.0)
    assert P.prediction_profile(table(spark, [1.0, 2.0, 3.0]), "x").first().pred_std == pytest.approx(0.816497, abs=1e-6)


def test_mode_takes_the_smallest_of_ties(spark):
    df = table(spark, ["b", "a", "b", "a", None], "x string")
    assert C.modes(df, ["x"]).first().value == "a"
    assert sorted(r.x for r in C.impute(df).collect()) == ["a", "a", "a", "b", "b"]


def test_impute(spark):
    df = table(spark, [(1, 1.0, "p"), (2, math.nan, None), (4, 5.0, "p"), (None, 6.0, "q")], "i int, x double, s string")
    rows = C.impute(df).collect()
    assert rows[1].x == 5.0 and rows[1].s == "p" and rows[3].i == 2
    half = C.impute(table(spark, [1, 2, None], "i int")).collect()
    assert half[2].i == 1.5
    assert C.impute(df, {"x": 0.0}).collect()[1].x == 0.0


def test_exact_duplicates_treat_nan_and_signed_zero_as_equal(spark):
    df = table(spark, [math.nan, math.nan, 0.0, -0.0])
    assert C.drop_exact(df).count() == 2
    kept = C.keep_best(df.withColumn("i", F.monotonically_increasing_id()), ["x"], [F.asc("i")])
    assert kept.count() == 2
    assert P.duplicate_count(df).first().duplicates == 2


def test_keep_best_limits_groups_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    best = C.keep_best(df, ["k"], [F.desc("id")])
    assert {r.k: r.id for r in best.collect()} == {0: 999, 1: 997, 2: 998}
    plan = best._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_validate(spark):
    df = table(spark, [(0, 0.5, 0.5), (50, 1.5, None)], "popularity int, danceability double, energy double")
    got = {r.rule: r.violations for r in C.validate(df).collect()}
    assert got == {"popularity_1_100": 1, "danceability_0_1": 1, "energy_0_1": 1, "no_nulls": 1}
    with pytest.raises(ValueError, match="popularity_1_100"):
        C.validate(df, strict=True)
    C.validate(table(spark, [1], "popularity int"), {"p": "popularity > 0"}, strict=True)


def test_cleaning_report_matches_the_steps(spark):
    rows = [(1.0, 5, "a"), (1.0, 5, "a"), (1.0, 3, "b"), (2.0, 0, "c"), (2.0, 0, "d"), (3.0, 1, "e")]
    df = table(spark, rows, "energy double, popularity int, track_id string")
    got = {r.step: (r.rows_before, r.removed) for r in C.cleaning_report(df, ["energy"]).collect()}
    assert got == {"exact_duplicates": (6, 1), "feature_duplicates": (5, 2), "zero_target": (3, 1), "total": (6, 4)}


def test_constant_column_has_no_correlation(spark):
    df = table(spark, [(5.1, float(i), 0.1 if i else None) for i in range(5)], "c double, x double, h double")
    got = {(r.feature_x, r.feature_y): r.corr for r in A.corr_matrix(df, ["c", "x", "h"]).collect()}
    assert got[("c", "x")] is None and got[("c", "c")] is None and got[("h", "x")] is None
    assert got[("x", "x")] == pytest.approx(1.0)
    assert A.trend(df, "c", "x").first().slope is None


def test_correlations_against_pandas(spark):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"a": rng.normal(size=300), "b": rng.integers(0, 5, 300).astype(float)})
    pdf["c"] = pdf.a + rng.normal(size=300)
    pdf.loc[::7, "c"] = np.nan
    df = spark.createDataFrame(pdf)
    want = pdf.corr()
    for r in A.corr_matrix(df, ["a", "b", "c"]).collect():
        assert r.corr == pytest.approx(want.loc[r.feature_x, r.feature_y])
    assert A.corr_matrix(df, ["a", "b", "c"], lower_only=True).count() == 3
    rho = {r.feature: r for r in A.spearman_with(df, ["a", "b"], "c").collect()}
    for f in ("a", "b"):
        pair = pdf[[f, "c"]].dropna().rank()
        assert rho[f].rho == pytest.approx(pair[f].corr(pair["c"])) and rho[f].n == len(pair)
    assert rho["a"].p_value < 1e-6 and rho["a"].practical


def test_qcut_merges_equal_edges(spark):
    df = table(spark, [(float(x), float(x)) for x in (0, 0, 0, 0, 1, 2, 3, 4, 5, 6)], "x double, y double")
    got = A.qcut_mean(df, ["x"], "y", 4).orderBy("bin").collect()
    assert [r.rows for r in got] == [5, 2, 3]
    assert [(r.lower, r.upper) for r in got] == [(0.0, 1.5), (1.5, 3.75), (3.75, 6.0)]


def test_box_stats(spark):
    df = table(spark, [("a", float(x)) for x in (1, 2, 3, 4, 100)] + [("b", 7.0)], "k string, x double")
    got = {r.k: r for r in P.box_stats(df, "k", "x").collect()}
    assert (got["a"].q1, got["a"].median, got["a"].q3) == (2.0, 3.0, 4.0)
    assert (got["a"].whisker_low, got["a"].whisker_high, got["a"].outliers, got["a"].max) == (1.0, 4.0, 1, 100.0)
    assert got["b"].outliers == 0


def test_qq_points_are_symmetric(spark):
    pts = A.qq_points(spark.range(11).select(F.col("id").alias("k"), F.col("id").cast("double").alias("x")), "x", ["k"])
    rows = pts.orderBy("position").collect()
    assert [r.value for r in rows] == [float(i) for i in range(11)]
    assert rows[5].theoretical == pytest.approx(0.0, abs=1e-12)
    assert rows[0].theoretical == pytest.approx(-rows[10].theoretical)
    assert A.qq_line(pts).first().slope > 0


def test_split_sizes_are_exact(spark):
    for n in (7, 1000, 78310):
        df = spark.range(n)
        for scheme in ("80/20", "64/16/20", "70/15/15"):
            got = {r.split: r["count"] for r in sampling.split(df, scheme, ["id"]).groupBy("split").count().collect()}
            assert got == {k: v for k, v in sampling.expected_sizes(n, scheme).items() if v}
    assert sampling.expected_sizes(78310, "70/15/15") == {"train": 54817, "val": 11746, "test": 11747}


def test_split_is_repeatable_and_ignores_partitioning(spark):
    df = spark.range(500)
    a = {r.id: r.split for r in sampling.split(df, "70/15/15", ["id"], 7).collect()}
    b = {r.id: r.split for r in sampling.split(df.repartition(9), "70/15/15", ["id"], 7).collect()}
    c = {r.id: r.split for r in sampling.split(df, "70/15/15", ["id"], 8).collect()}
    assert a == b != c


def test_stratified_split(spark):
    df = spark.range(1000).withColumn("g", F.when(F.col("id") < 700, "big").when(F.col("id") < 990, "mid"))
    got = {(r.g, r.split): r["count"] for r in
           sampling.split(df, "80/20", ["id"], strata=["g"]).groupBy("g", "split").count().collect()}
    assert got == {("big", "train"): 560, ("big", "test"): 140, ("mid", "train"): 232, ("mid", "test"): 58,
                   (None, "train"): 8, (None, "test"): 2}


def test_large_buckets_are_narrowed(spark):
    df = spark.range(60_000).withColumn("g", F.col("id") % 3)
    sizes = {"a": F.lit(100), "b": F.ceil(F.col("n") * 0.5)}
    for strata in ([], ["g"]):
        plain = sampling.hash_cuts(df, ["id"], 5, sizes, strata)
        narrow = sampling.hash_cuts(df, ["id"], 5, sizes, strata, max_ranked=3)
        assert sorted(map(str, plain.collect())) == sorted(map(str, narrow.collect()))
        assert plain.count() == 2 * max(1, 3 * len(strata))
    last = sampling.hash_cuts(df, ["id"], 5, {"a": F.lit(100)}).first()["last"]
    assert df.where(F.xxhash64("id", F.lit(5)) <= last.h).count() == 100


def test_sample_is_exact_nested_and_repeatable(spark):
    df = spark.range(2000).withColumn("v", F.col("id") * 2)
    small = {r.id for r in sampling.sample_n(df, 50, 1, ["id"]).collect()}
    large = {r.id for r in sampling.sample_n(df.repartition(5), 300, 1, ["id"]).collect()}
    assert len(small) == 50 and len(large) == 300 and small < large
    assert sampling.sample_n(df, 5000, 1, ["id"]).count() == 2000
    assert sampling.sample_n(df, 0, 1, ["id"]).count() == 0


def test_shared_fingerprint(spark):
    df = table(spark, [(1.0, 0), (1.0, 5), (2.0, 0), (3.0, 4)], "energy double, popularity int")
    assert tuple(reports.shared_fingerprint(df, ["energy"]).first()) == (2, 1, 50.0)

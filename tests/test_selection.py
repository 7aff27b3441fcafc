"""Quantiles by selection against pandas."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tunemill.operators import selection
from tunemill.operators.ranks import quantiles
from tunemill.operators.selection import selected

PROBS = {"p0": 0.0, "p01": 0.01, "p25": 0.25, "p50": 0.5, "p99": 0.99, "p100": 1.0}


@pytest.fixture(scope="module")
def table():
    rng = np.random.default_rng(2)
    n = 20_000
    frame = pd.DataFrame({"k": rng.choice(["a", "b", "c"], n, p=[0.9, 0.09, 0.01]), "even": rng.uniform(-5, 5, n), "tied": rng.integers(0, 3, n) * 1.0,
                          "one": np.where(rng.random(n) < 0.7, 0.0, rng.normal(0, 1e6, n)), "same": 4.0, "none": np.nan})
    frame.loc[rng.random(n) < 0.1, "even"] = np.nan
    frame.loc[:3, "one"] = [np.inf, -np.inf, 1e300, -1e300]
    return frame


def equal(got, own):
    for label, p in PROBS.items():
        ordered, at = np.sort(own), (len(own) - 1) * p
        low, high, part = ordered[int(at)], ordered[int(np.ceil(at))], at - int(at)
        want = low + (high - low) * part if part else low
        assert got[label] == pytest.approx(want, rel=1e-12, abs=1e-12), (label, want, got[label])


@pytest.mark.parametrize("accuracy", [50, 10_000])
def test_whole_columns(spark, table, accuracy):
    df = spark.createDataFrame(table).repartition(6)
    got = {r.feature: r for r in selected(df, ["even", "tied", "one", "same", "none"], PROBS, accuracy=accuracy).collect()}
    assert set(got) == {"even", "tied", "one", "same"}
    for c, r in got.items():
        equal(r, table[c].dropna())


@pytest.mark.parametrize("accuracy", [50, 10_000])
def test_groups(spark, table, accuracy):
    df = spark.createDataFrame(table).unionByName(spark.createDataFrame(table.head(50)).withColumn("k", F.lit(None).cast("string")))
    got = {(r.k, r.feature): r for r in selected(df, ["even", "one"], PROBS, ["k"], accuracy).collect()}
    assert set(got) == {(k, c) for k in "abc" for c in ("even", "one")}
    for (k, c), r in got.items():
        equal(r, table[table.k == k][c].dropna())


def test_small_and_empty_tables(spark):
    for n in range(1, 8):
        df = spark.range(n).select(F.col("id").cast("double").alias("x"))
        equal(selected(df, ["x"], PROBS).first(), pd.Series(range(n), dtype=float))
    assert selected(spark.range(0).selectExpr("id AS x"), ["x"], PROBS).count() == 0
    assert selected(spark.range(0).selectExpr("id AS x", "id AS k"), ["x"], PROBS, ["k"]).count() == 0


def test_a_key_may_be_a_value_and_names_may_clash(spark):
    df = spark.range(101).selectExpr("id % 2 AS slot", "id AS feature", "id AS _v0")
    got = {(r.slot, r.feature): r.m for r in quantiles(df, ["slot", "feature"], {"m": 0.5}, ["slot"]).collect()}
    assert got == {(0, "slot"): 0, (1, "slot"): 1, (0, "feature"): 50, (1, "feature"): 50}


def test_no_column_is_sorted_or_shuffled_whole(spark, table):
    df = spark.createDataFrame(table)
    counts = selected(df, ["even"], {"m": 0.5})
    assert counts.count() == 1
    plan = counts._jdf.queryExecution().executedPlan().toString()
    exchanged = [line for line in plan.splitlines() if "Exchange rangepartitioning" in line]
    assert not exchanged


def test_ranks_across_ranges_and_batches(spark, table):
    """Groups and hot values that span ranges and Arrow batches keep one numbering."""
    from tunemill.operators.ranks import rank_counts

    df = spark.createDataFrame(table[["k", "even"]].dropna()).groupBy("k", "even").agg(F.count("*").alias("cnt"))
    size = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "700")
    try:
        got = rank_counts(df, ["k"], "even", max_values=1500).toPandas()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
    own = table[["k", "even"]].dropna()
    want = own.groupby("k").even.rank(method="min") - 1
    have = {(r.k, r.even): (r.before, r.n) for r in got.itertuples()}
    sizes = own.groupby("k").size()
    assert all(have[k, v] == (b, sizes[k]) for k, v, b in zip(own.k, own.even, want))


def test_slots_are_compiled_comparisons(spark):
    """Intervals may overlap; a value in none lies in the range between two ends."""
    begun, ended = selection._begun_and_ended("v", ["1.0D", "3.0D", "2.0D", "4.0D", "4.0D", "4.0D"])
    df = spark.createDataFrame([(0.5,), (1.0,), (2.5,), (3.5,), (4.0,), (5.0,)], "v double").select((begun + ended).alias("slot"), (begun > ended).alias("inside"))
    assert [tuple(r) for r in df.collect()] == [(0, False), (1, True), (2, True), (3, True), (4, True), (6, False)]
    plan = df._jdf.queryExecution().toString()
    assert "lambda" not in plan and "transform(" not in plan

"""Edge tables with hand-computed answers: bins, names, encodings, scalars."""

import math
import statistics

import pytest
from pyspark.sql import functions as F

from tunemill.functions.bins import cut, cut_ordinal, fixed_width_bin
from tunemill.functions.names import members_of, primary_of
from tunemill.functions.nested import json_first, lookup
from tunemill.functions.normal import inverse_normal, t_pvalue
from tunemill.functions.scalars import capitalise, clip, mood_quadrant, stable_hash, strip_prefix, year_of
from tunemill.operators import columns as C
from tunemill.operators import encode as E
from tunemill.presets import ENERGY_BINS


def col(df, name="y"):
    return [r[name] for r in df.collect()]


def test_cut_closes_on_the_right_and_admits_the_lowest_edge(spark):
    df = spark.createDataFrame([(x,) for x in (0.0, .33, .34, .66, 1.0, -0.1, 1.1, None, float("nan"))], "x double")
    got = col(df.select(cut(F.col("x"), [0, .33, .66, 1], ["Low", "Medium", "High"], include_lowest=True).alias("y")))
    assert got == ["Low", "Low", "Medium", "Medium", "High", None, None, None, None]


def test_cut_without_lowest_edge(spark):
    df = spark.createDataFrame([(x,) for x in (0.0, 1000.0, 1001.0, 0.5, math.inf)], "x double")
    got = col(df.select(cut(F.col("x"), [0, 1000, 10000, math.inf], ["Unknown", "Emerging", "Big"]).alias("y")))
    assert got == [None, "Unknown", "Emerging", "Unknown", "Big"]


def test_cut_left_closed_and_ordinal(spark):
    df = spark.createDataFrame([(x,) for x in (0.32, .33, .66)], "x double")
    edges = [-math.inf, .33, .66, math.inf]
    assert col(df.select(cut(F.col("x"), edges, list("abc"), right=False).alias("y"))) == ["a", "b", "c"]
    assert col(df.select(cut_ordinal(F.col("x"), edges).alias("y"))) == [0, 0, 1]
    with pytest.raises(ValueError):
        cut(F.col("x"), [0, 1], ["a", "b"])


def test_fixed_width_bin_puts_the_maximum_into_the_last_bin(spark):
    df = spark.createDataFrame([(x,) for x in (0.0, 0.99, 5.0, 10.0, 11.0)], "x double")
    assert col(df.select(fixed_width_bin(F.col("x"), 0, 10, 10).alias("y"))) == [0, 0, 5, 9, None]
    assert col(df.select(fixed_width_bin(F.col("x"), 5, 5, 10).alias("y"))) == [None, None, 0, None, None]


def test_names(spark):
    df = spark.createDataFrame([("A, B;C & D and E feat. F ft. G",), (None,), ("Solo",), ("X FEAT. Y",), ("A,,B",)], "a string")
    rows = df.select(members_of(F.col("a")).alias("m"), primary_of(F.col("a")).alias("p")).collect()
    assert rows[0].m == list("ABCDEFG") and rows[0].p == "A"
    assert rows[1].m is None and rows[1].p is None
    assert rows[2].m == ["Solo"] and rows[3].p == "X FEAT. Y"
    assert rows[4].m == ["A", "", "B"]


def test_moods(spark):
    df = spark.createDataFrame([(.6, .6), (.5, .6), (.6, .5), (.5, .5), (7.0, -3.0), (None, .5)], "v double, e double")
    assert col(df.select(mood_quadrant(F.col("v"), F.col("e")).alias("y"))) == [
        "Happy/High Energy", "Energetic/Sad", "Chill/Happy", "Sad/Low Energy", "Chill/Happy", None]
    assert col(E.with_mood(df.drop("v")), "mood_energy") == ["Unknown"] * 6


def test_scalars(spark):
    df = spark.createDataFrame([("hELLO", "2020-03-01"), ("", "nope"), (None, None)], "t string, d string")
    rows = df.select(capitalise(F.col("t")).alias("c"), year_of(F.col("d")).alias("y"),
                     strip_prefix(F.col("t"), "hE").alias("s")).collect()
    assert [r.c for r in rows] == ["Hello", "", None]
    assert [r.y for r in rows] == [2020, None, None]
    assert rows[0].s == "LLO"
    one = spark.range(1)
    assert col(one.select(clip(F.lit(None).cast("double"), 0.0, 1.0).alias("y"))) == [None]
    share = col(one.select(stable_hash(F.lit("pop")).alias("y")))[0]
    assert 0 <= share < 1 and share == col(one.select(stable_hash(F.lit("pop")).alias("y")))[0]


def test_json_and_lookup(spark):
    df = spark.createDataFrame([('{"metrics":{"test_r2":0.5}}',), ('{"performance":{"test":{"r2":0.3}}}',), ("{}",), ("x",)], "j string")
    paths = ["$.metrics.test_r2", "$.performance.test.r2"]
    assert col(df.select(json_first(F.col("j"), paths, "double", 0.0).alias("y"))) == [0.5, 0.3, 0.0, 0.0]
    assert col(df.select(lookup(F.col("j"), {"x": "known"}, "other").alias("y")))[3] == "known"


def test_inverse_normal_matches_the_standard_library(spark):
    ps = [1e-12, 1e-6, 0.001, 0.02, 0.3, 0.5, 0.7, 0.975, 0.999999]
    got = col(spark.createDataFrame([(p,) for p in ps], "p double").select(inverse_normal(F.col("p")).alias("y")))
    assert got == pytest.approx([statistics.NormalDist().inv_cdf(p) for p in ps], abs=1e-12)


def test_t_pvalue():
    # t = 2.0 with 10 degrees of freedom has the two-sided p-value 0.07338803
    r = 2.0 / math.sqrt(10 + 4.0)
    assert t_pvalue(r, 12) == pytest.approx(0.07338803, abs=1e-7)
    assert t_pvalue(0.0, 50) == pytest.approx(1.0)
    assert t_pvalue(1.0, 50) == 0.0 and math.isnan(t_pvalue(0.5, 2))
    # large samples approach the normal tail
    assert t_pvalue(0.01, 1_000_000) == pytest.approx(2 * (1 - statistics.NormalDist().cdf(10.0)), abs=1e-12)


def test_column_discovery(spark):
    df = spark.createDataFrame([(1, "a", True, 2.0)], "Unnamed int, Genre string, flag boolean, TempoBPM double")
    assert C.resolve_column(df, ["genre", "genres"]) == "Genre"
    assert C.resolve_column(df, ["none"], "x") == "x"
    assert C.numeric_cols(df) == ["Unnamed", "TempoBPM"] and C.string_cols(df) == ["Genre"]
    assert C.available(df, ["Genre", "zzz"]) == ["Genre"]
    assert C.snake_names(df).columns == ["unnamed", "genre", "flag", "tempo_bpm"]
    aligned = C.align_to(df, ["TempoBPM", "release_year", "other"]).first()
    assert tuple(aligned) == (2.0, 2020, 0)
    assert C.drop_cols(df, ["flag", "zzz"]).columns == ["Unnamed", "Genre", "TempoBPM"]
    with pytest.raises(ValueError, match="missing"):
        C.check_same_columns(df, df.drop("flag"))
    C.check_same_columns(df, df)


def test_one_hot_drops_the_first_level_in_order(spark):
    df = spark.createDataFrame([("Low Energy",), ("High Energy",), (None,)], "energy_category string")
    out = E.one_hot(df, "energy_category", ENERGY_BINS[1])
    assert out.columns == ["energy_category_Medium Energy", "energy_category_High Energy"]
    assert [tuple(r) for r in out.collect()] == [(0, 0), (0, 1), (0, 0)]
    free = E.one_hot(spark.createDataFrame([("b",), ("a",), ("c",)], "k string"), "k")
    assert free.columns == ["k_b", "k_c"]
    with pytest.raises(ValueError):
        E.levels_of(spark.range(20), "id", limit=10)


def test_label_encode_small_and_large_paths_agree(spark):
    df = spark.createDataFrame([(v,) for v in ["rock", "pop", "jazz", "pop", None]], "g string")
    want = {"jazz": 0, "pop": 1, "rock": 2, None: None}
    for limit in (1000, 1):
        got = {r.g: r.g_encoded for r in E.label_encode(df, "g", inline_limit=limit).collect()}
        assert got == want


def test_scaler_uses_population_deviation(spark):
    df = spark.createDataFrame([(float(x), 5.0) for x in (1, 2, 3, 4, 10)], "x double, k double")
    fit = E.fit_scaler(df, ["x", "k"])
    assert fit["x"] == pytest.approx((4.0, 3.1622776601683795))
    assert fit["k"] == (5.0, 1.0)
    assert E.apply_scaler(df, fit).first().k == 0.0


def test_request_row_gets_the_columns_of_training(spark):
    train = E.derive(spark.createDataFrame(
        [(.9, .9, .1, .5, 100.0, 200000, 0, 4, "pop", False), (.1, .1, .2, .5, 160.0, 400000, 1, 3, "rock", True)],
        "energy double, valence double, acousticness double, danceability double, tempo double, duration_ms long, "
        "mode int, time_signature int, track_genre string, explicit boolean"))
    levels, codes = E.fit_features(train)
    request = train.limit(1).withColumn("track_genre", F.lit("unseen"))
    a, b = E.featurize(train, levels, codes), E.featurize(request, levels, codes)
    assert a.columns == b.columns
    assert b.first().track_genre_encoded == 0
    assert a.first()["mood_energy_Sad/Low Energy"] == 0 and a.first().high_energy_happy == 1


def test_inverse_normal_is_one_batch_function(spark):
    """Null outside 0 to 1; the plan holds no ratio of polynomials for each use."""
    df = spark.createDataFrame([(0.0,), (1.0,), (None,), (float("nan"),), (-1.0,), (0.5,)], "p double").select(inverse_normal(F.col("p")).alias("y"))
    assert [r.y for r in df.collect()] == [None] * 5 + [0.0]
    assert "ArrowEvalPython" in df._jdf.queryExecution().toString()

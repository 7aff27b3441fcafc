"""Operators on a table without rows."""

import pytest

from tunemill.operators import association as A
from tunemill.operators import clean as C
from tunemill.operators import evaluate as Q
from tunemill.operators import profile as P
from tunemill.operators import sampling
from tunemill.operators.encode import apply_scaler, fit_scaler, label_encode
from tunemill.plans.pipeline import clean


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], "track_id string, g string, x double, y double, popularity int")


def test_profiles(empty):
    row = P.describe_exact(empty, ["x"]).first()
    assert row["count"] == 0 and row.p50 is None
    assert P.histogram(empty, "x", 5).count() == 0
    assert P.density_grid(empty, "x", "y", 3, 3).count() == 0
    assert P.box_stats(empty, "g", "x").count() == 0
    assert P.value_counts(empty, "g").count() == 0
    assert P.prediction_profile(empty, "x").first().pct_unique is None
    assert P.duplicate_count(empty).first().duplicates == 0
    assert {r.section for r in P.quality_report(empty).collect()} == {"summary", "missing", "dtype"}


def test_association(empty):
    assert {r.corr for r in A.corr_matrix(empty, ["x", "y"]).collect()} == {None}
    assert A.spearman_with(empty, ["x"], "y").count() == 0
    assert A.qcut_mean(empty, ["x"], "y").count() == 0
    assert A.qq_points(empty, "x", ["track_id"]).count() == 0


def test_cleaning_and_splits(empty):
    assert clean(empty, ["track_id"], ["x"]).count() == 0
    assert C.impute(empty).count() == 0
    assert C.zero_stats(empty).first().zero_rows == 0
    assert C.cleaning_report(empty, ["x"]).first().removed_pct is None
    assert sampling.split(empty, "70/15/15", ["track_id"]).count() == 0
    assert sampling.split(empty, "80/20", ["track_id"], strata=["g"]).count() == 0
    assert sampling.sample_n(empty, 5, 1, ["track_id"]).count() == 0
    assert apply_scaler(empty, fit_scaler(empty, ["x"])).count() == 0
    assert label_encode(empty, "g").count() == 0


def test_quality(empty):
    assert Q.regression_metrics(empty, "x", "y").first().r2 is None
    assert Q.health(empty, "x", "y").first().status == "PASSED"
    assert Q.error_by_band(empty, "x", "y").count() == 0
    assert Q.error_counts(empty, "x", "y").first().within_pct is None

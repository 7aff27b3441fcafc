"""Equal rows are counted by their hashes first, then in full."""

import io
from contextlib import redirect_stdout

import pytest

from tunemill.operators import clean as C
from tunemill.operators import profile as P

NAN = float("nan")
# The second and third row have the same hash, as nulls leave it unchanged.
ROWS = [("a", 1.0, None), ("b", None, 2.0), ("b", 2.0, None), ("c", 0.0, NAN), ("c", -0.0, NAN), ("a", 1.0, None), ("a", 1.0, None), (None, None, None)]


@pytest.mark.parametrize("most", [0, 100])
def test_spare_copies_of_odd_rows(spark, monkeypatch, most):
    monkeypatch.setattr(C, "MAX_REPEATED", most)
    df = spark.createDataFrame(ROWS, "name string, x double, y double")
    assert C.spare_copies(df, df.columns).first().spare == 3
    assert P.duplicate_count(df, ["name"]).first().duplicates == 4
    found = {(r.section, r.item): r.value for r in P.quality_report(df).collect()}
    assert (found["summary", "rows"], found["summary", "duplicate_rows"], found["missing", "y"]) == ("8", "3", "7")
    steps = {r.step: (r.rows_before, r.removed) for r in C.cleaning_report(df, ["name"], "x").collect()}
    assert steps == {"exact_duplicates": (8, 3), "feature_duplicates": (5, 1), "zero_target": (4, 2), "total": (8, 6)}


@pytest.mark.parametrize("report", [P.quality_report, lambda df: C.cleaning_report(df, ["name"], "x")])
def test_only_rows_with_a_repeated_hash_are_grouped(spark, report):
    df = spark.createDataFrame(ROWS, "name string, x double, y double")
    with redirect_stdout(io.StringIO()) as plan:
        report(df).explain()
    assert "LeftSemi" in plan.getvalue()

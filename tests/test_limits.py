"""Limits and settings that must not change results in silence."""

import pytest
from pyspark.sql import functions as F

from tunemill.operators.encode import MAX_LEVELS, label_encode, level_codes, with_codes
from tunemill.operators.similarity import similar_items
from tunemill.plans.ledger import RunLedger
from tunemill.plans.models import _depth
from tunemill.session import scratch_path, shared_dir


def test_label_encoding_keeps_the_column_order(spark):
    df = spark.createDataFrame([(1, "b", 2.0), (2, "a", 3.0), (3, None, 4.0)], "id long, g string, v double")
    few, many = label_encode(df, "g"), label_encode(df, "g", inline_limit=1)
    assert few.columns == many.columns == ["id", "g", "v", "g_encoded"]
    assert sorted(few.collect()) == sorted(many.collect())


def test_depth_beyond_the_largest_is_an_error():
    with pytest.raises(ValueError):
        _depth(50)
    assert _depth(None) == 30 and _depth(7) == 7


def test_cluster_needs_a_shared_folder():
    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://somewhere:7077"

        def getCheckpointDir(self):  # noqa: N802
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError):
        shared_dir(Session())


def test_an_unknown_run_on_a_new_ledger_is_empty_and_the_last_metric_counts(spark):
    ledger = RunLedger(spark, scratch_path(spark, "new-ledger"))
    assert ledger.get("nothing") == {} and ledger.runs().count() == 0
    run = ledger.start("tries")
    for value in (3.0, 1.0, 2.0):
        ledger.log_metrics(run, {"rmse": value})
    assert ledger.get(run)["metrics"] == {"rmse": 2.0} and ledger.get(run)["params"] == {}


def test_feature_codes_for_any_number_of_genres(spark):
    names = [f"g{i:05d}" for i in range(MAX_LEVELS + 5)]
    many = spark.createDataFrame([(x,) for x in names], "track_genre string")
    codes = level_codes(many, "track_genre")
    got = {r.track_genre: r.code for r in with_codes(many, "track_genre", codes, "code").collect()}
    assert got == {x: i for i, x in enumerate(names)}


def test_similar_items_refuse_vectors_of_another_length(spark):
    items = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [1.0, 1.0]), ("c", [1.0])], "id string, v array<double>")
    with pytest.raises(Exception, match="not the 2 numbers"):
        similar_items(items, items.where("id = 'a'"), "id", F.col("v"), 1).collect()
    two = similar_items(items.where("id <> 'c'"), items.where("id = 'a'"), "id", F.col("v"), 1).collect()
    assert [(r.seed_id, r.item_id, r.rank) for r in two] == [("a", "b", 1)]

"""Ranges of exact ranks for tables of any size."""

from pyspark.sql import functions as F

from tunemill.operators import ranks as R


def test_ranges_are_bounded_for_any_number_of_values(spark, monkeypatch):
    monkeypatch.setattr(R, "MAX_RANGES", 8, raising=False)
    df = spark.range(2000).select(F.lit("k").alias("k"), (F.col("id") * 3).cast("double").alias("x"))
    ranks = R.value_ranks(df, ["x"], ["k"], max_values=20)
    assert ranks.select(F.spark_partition_id()).distinct().count() <= 8
    assert ranks.where("before <> value / 3 OR n <> 2000").count() == 0
    assert R.quantiles(df, ["x"], {"m": 0.5}, max_values=20).first().m == 2998.5

"""Rows of learners: blocks of bounded size."""

from pyspark.sql import functions as F

from tunemill.plans import training as T


def test_learners_get_partitions_of_bounded_size(spark, monkeypatch):
    df = spark.range(1000).coalesce(1).select((F.col("id") % 7).cast("double").alias("x"), F.col("id").cast("double").alias("y"))
    assert T.bounded(df).rdd.getNumPartitions() == 1
    monkeypatch.setattr(T, "LEARNER_ROWS", 100)
    dealt = T.bounded(df)
    assert dealt.rdd.getNumPartitions() == 10
    assert sorted(map(tuple, dealt.collect())) == sorted(map(tuple, df.collect()))

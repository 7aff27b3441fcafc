"""The row before in sort order, across ranges and Arrow batches."""

import pytest
from pyspark.sql import functions as F

from tunemill.plans.explain import with_previous


@pytest.mark.parametrize("rows", [0, 1, 2, 900])
def test_previous_row(spark, rows):
    df = spark.range(rows).select(F.col("id"), (F.col("id") * 7919 % 1009).alias("x"), F.when(F.col("id") % 5 > 0, F.concat(F.lit("t"), "id")).alias("t"))
    size = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        got = with_previous(df.repartition(5), [F.col("x")], ["x", "t"])
        own = sorted(got.collect(), key=lambda r: r.x)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
    assert len(own) == rows
    for before, row in zip([*own[-1:], *own[:-1]], own):
        assert (row._d_x, row._d_t) == (before.x, before.t)


def test_one_exchange(spark):
    plan = with_previous(spark.range(100).toDF("x"), [F.col("x")], ["x"])._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "rangepartitioning" not in plan  # the sorted rows are written, ends are broadcast

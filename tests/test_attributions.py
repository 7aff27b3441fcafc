"""Attributions of tree models without rows for draws and steps."""

import numpy as np
from pyspark.sql import functions as F

from tunemill.plans import explain as X
from tunemill.plans import models as M


def test_attributions_of_trees_are_those_of_mixed_rows(spark):
    i = F.col("id")
    df = spark.range(400).select(i.alias("row"), (i % 13).cast("double").alias("a"), (i % 7).cast("double").alias("b"), (i % 5).cast("double").alias("c"))
    df = df.withColumn("goal", 3 * F.col("a") + F.col("a") * F.col("b"))
    model = M.fit_gbt(df, ["a", "b", "c"], "goal", {"n_estimators": 4, "max_depth": 3})
    asked = df.where("row < 20").unionByName(df.where("row = 3"))
    made = X.shapley(asked, model, ["a", "b", "c"], df, ["row"], draws=6)
    assert "Generate" not in made._jdf.queryExecution().executedPlan().toString()  # rows are not multiplied by draws and steps

    class Plain:
        """The same model without its trees, attributed by mixed rows."""

        transform = staticmethod(model.transform)

    want = {r.row: r for r in X.shapley(asked, Plain(), ["a", "b", "c"], df, ["row"], draws=6).collect()}
    got = {r.row: r for r in made.collect()}
    assert set(got) == set(want) == set(range(20))
    for row, r in got.items():
        assert np.allclose([*r[1:]], [*want[row][1:]], atol=1e-9)

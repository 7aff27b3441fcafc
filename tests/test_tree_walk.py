"""Walks through packed trees."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tunemill.plans import models as M
from tunemill.plans.trees import pack


def test_walks_end_in_the_leaf_of_the_model(spark):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"a": rng.normal(size=300), "b": rng.normal(size=300)})
    pdf["goal"] = np.where(pdf.a > 0.3, pdf.b, -2.0)
    df = spark.createDataFrame(pdf)
    model = M.fit_forest(df, ["a", "b"], "goal", {"n_estimators": 5, "max_depth": 6})
    trees = pack(spark, model)
    own = [r.prediction for r in M.score(df, model, ["a", "b"]).collect()]
    assert np.allclose(trees.total(pdf[["a", "b"]].to_numpy()), own)
    lone = M.fit_forest(df.withColumn("goal", F.lit(2.5)), ["a", "b"], "goal", {"n_estimators": 2, "max_depth": 3})
    assert pack(spark, lone).total(np.array([[0.0, np.nan]])).tolist() == [2.5]

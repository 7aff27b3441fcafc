"""Feature attributions of single predictions, as Spark jobs."""

from __future__ import annotations

import random
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from tunemill.functions.sqltext import rows, text
from tunemill.operators.sampling import hash_order, sample_n
from tunemill.plans.trees import Trees, pack
from tunemill.session import shared_dir

MAX_DRAWS = 500


def shapley(df: DataFrame, model, features: list[str], background: DataFrame, key: list[str], draws: int = 20,
            seed: int = 42) -> DataFrame:
    """(key, base, prediction, one column per feature) by sampled feature orders.

    Each draw is a feature order and a background row. A row takes its features over from the background row one by
    one; the change of the prediction at each step is that feature's part. ``base`` plus all parts equals the
    prediction exactly. Every second order is the reverse of the one before, which reduces the sampling error.
    """
    if not 0 < draws <= MAX_DRAWS:
        raise ValueError(f"draws must be between 1 and {MAX_DRAWS}")
    base_rows = sample_n(background.dropna(subset=features), draws, seed, key).select(
        [F.col(c).cast("double") for c in features]).collect()
    rng, d, plans, order = random.Random(seed), len(features), [], list(range(len(features)))
    for i in range(draws):
        order = list(reversed(order)) if i % 2 else rng.sample(range(d), d)
        turn = [0] * d
        for position, j in enumerate(order):
            turn[j] = position + 1
        plans.append((turn, list(base_rows[i % len(base_rows)])))
    inputs = df.dropna(subset=features).select(*key, F.array(*[F.col(c).cast("double") for c in features]).alias("x"))
    if hasattr(model, "trees"):
        return _tree_parts(inputs, pack(df.sparkSession, model), plans, features, key)
    each = F.array(*[F.struct(F.array(*[F.lit(t) for t in turn]).alias("turn"), F.array(*[F.lit(v) for v in bg]).alias("bg")) for turn, bg in plans])
    steps = (inputs.select("*", F.inline(each))
             .select("*", F.explode(F.sequence(F.lit(0), F.lit(d))).alias("step")))
    mixed = F.transform("x", lambda value, j: F.when(F.get("turn", j) <= F.col("step"), value)
                        .otherwise(F.get("bg", j)))
    scored = model.transform(steps.select(*key, "turn", "step", array_to_vector(mixed).alias("features")))
    f, step, share = F.col("prediction"), F.col("step"), F.lit(float(draws))

    def part(j):
        turn = F.get("turn", F.lit(j))
        return F.sum(F.when(step == turn, f).when(step == turn - 1, -f)) / share

    return scored.groupBy(*key).agg(
        F.avg(F.when(step == 0, f)).alias("base"), F.avg(F.when(step == d, f)).alias("prediction"),
        *[part(j).alias(c) for j, c in enumerate(features)])


def _tree_parts(inputs: DataFrame, trees: Trees, plans: list[tuple[list, list]], features: list[str], key: list[str]) -> DataFrame:
    """Base, prediction and parts of every row from the packed trees: the mixed rows of all draws exist only within a task.

    Rows with equal key are put together as the mixed rows would be: bases and predictions averaged, parts summed.
    """
    held, d = inputs.sparkSession.sparkContext.broadcast(trees), len(features)
    known = [trees.total(np.array([bg], float))[0] for _, bg in plans]

    @pandas_udf("array<double>")
    def parts(x: pd.Series) -> pd.Series:
        if not len(x):
            return pd.Series([], dtype=object)
        rows = np.stack(x.to_numpy())
        own, sums = held.value.total(rows), np.zeros((len(rows), d))
        for (turn, bg), start in zip(plans, known):
            before = np.full(len(rows), start)
            for step in range(1, d + 1):
                # The row has taken over every feature at the last step.
                now = own if step == d else held.value.total(np.where(np.array(turn) <= step, rows, np.array(bg, float)))
                sums[:, turn.index(step)] += now - before
                before = now
        return pd.Series(list(np.column_stack([own, sums / len(plans)])))

    found = inputs.select(*key, parts("x").alias("_found"))
    return found.groupBy(*key).agg(
        F.avg(F.lit(float(np.mean(known)))).alias("base"), F.avg(F.get("_found", F.lit(0))).alias("prediction"),
        *[F.sum(F.get("_found", F.lit(j + 1))).alias(c) for j, c in enumerate(features)])


def linear_attributions(df: DataFrame, model, features: list[str], key: list[str]) -> DataFrame:
    """The exact attributions of a linear model: coefficient times distance from the mean."""
    means = df.agg(*[F.avg(c).alias(c) for c in features]).first()
    weights = [float(w) for w in model.coefficients.toArray()]
    base = float(model.intercept) + sum(w * means[c] for w, c in zip(weights, features))
    parts = [(F.lit(w) * (F.col(c) - F.lit(means[c]))).alias(c) for w, c in zip(weights, features)]
    table = df.dropna(subset=features).select(*key, F.lit(base).alias("base"), *parts)
    total = F.col("base")
    for c in features:
        total = total + F.col(c)
    return table.select(*key, "base", total.alias("prediction"), *features)


def mean_abs_attribution(attributions: DataFrame, features: list[str]) -> DataFrame:
    """(feature, mean_abs), largest first."""
    row = attributions.agg(*[F.avg(F.abs(c)).alias(c) for c in features])
    return row.unpivot([], features, "feature", "mean_abs").orderBy(F.desc("mean_abs"), "feature")


def dependence(df: DataFrame, attributions: DataFrame, feature: str, key: list[str]) -> DataFrame:
    """(key, value, attribution) pairs of one feature."""
    parts = attributions.select(*key, F.col(feature).alias("attribution"))
    return df.select(*key, F.col(feature).alias("value")).join(parts, key)


def explain_row(attributions: DataFrame, condition, features: list[str], top: int = 15) -> DataFrame:
    """Parts of one prediction, largest first, with the running total from the base."""
    one = attributions.where(condition).limit(1).unpivot(["base"], features, "feature", "contribution")
    by_size = W.partitionBy("base").orderBy(F.desc(F.abs("contribution")), "feature")
    return (one.withColumns({"rank": F.row_number().over(by_size),
                             "running": F.col("base") + F.sum("contribution").over(by_size.rowsBetween(
                                 W.unboundedPreceding, 0))})
            .where(F.col("rank") <= top).select("rank", "feature", "contribution", "running"))


def with_previous(df: DataFrame, order: list, cols: list[str], prefix: str = "_d_") -> DataFrame:
    """``df`` with the values of the row before in sort order, for the first row those of the last: one range exchange.

    Each sorted range shifts its rows as a stream. Only the last row of each range is passed on, to the first row of the next;
    that is one row per range, which the session bounds. The shifted rows are checkpointed in the shared folder.
    """
    spark = df.sparkSession
    shared_dir(spark)
    rows = df.withColumns({f"_o{i}": c for i, c in enumerate(order)})
    by = [f"_o{i}" for i in range(len(order))]
    rows = rows.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *by).sortWithinPartitions(*by).drop(*by)
    fields = [T.StructField(f"{prefix}{c}", rows.schema[c].dataType) for c in cols]
    schema = T.StructType([*rows.schema.fields, *fields, T.StructField("_part", T.LongType()), T.StructField("_at", T.LongType())])

    def shift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at, last = TaskContext.get().partitionId(), 0, None
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            own = [batch.column(batch.schema.get_field_index(c)) for c in cols]
            before = [pa.concat_arrays([pa.nulls(1, c.type) if last is None else last[i], c.slice(0, n - 1)]) for i, c in enumerate(own)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *before, pa.array(np.full(n, part)), pa.array(np.arange(at, at + n))],
                                             names=schema.names)
            last, at = [c.slice(n - 1, 1) for c in own], at + n

    shifted = rows.mapInArrow(shift, schema).checkpoint()
    ends = shifted.groupBy("_part").agg(F.max_by(F.struct(*cols), "_at").alias("_own"))
    parts, whole = W.orderBy("_part"), W.orderBy("_part").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    ends = ends.select("_part", F.lit(0).cast("long").alias("_at"), F.coalesce(F.lag("_own").over(parts), F.last("_own").over(whole)).alias("_before"))
    joined = shifted.join(F.broadcast(ends), ["_part", "_at"], "left")
    return joined.withColumns({f"{prefix}{c}": F.when(F.col("_at") == 0, F.col(f"_before.`{c}`")).otherwise(F.col(f"{prefix}{c}")) for c in cols}).drop(
        "_part", "_at", "_before")


def permutation_importance(df: DataFrame, model, features: list[str], label: str, key: list[str],
                           seed: int = 42) -> DataFrame:
    """(feature, rmse_increase) when one feature is taken from another row: the one before in hash order."""
    whole = df.dropna(subset=[*features, label]).select(*key, label, *features)
    pairs = with_previous(whole, [hash_order(key, seed)], features)

    # One pass scores every row with its own values and once more per feature with the donor's value.
    plain = {c: F.col(c).cast("double") for c in features}
    variants = {"base": plain, **{f"v{j}": {**plain, c: F.col(f"_d_{c}").cast("double")}
                                  for j, c in enumerate(features)}}
    for variant, values in variants.items():
        vector = array_to_vector(F.array(*[values[c] for c in features]))
        copy = model.copy({model.getParam("featuresCol"): f"_f_{variant}", model.getParam("predictionCol"): f"_p_{variant}"})
        pairs = copy.transform(pairs.withColumn(f"_f_{variant}", vector)).drop(f"_f_{variant}")
    errors = pairs.agg(*[F.sqrt(F.avg((F.col(label) - F.col(f"_p_{v}")) * (F.col(label) - F.col(f"_p_{v}")))).alias(v)
                         for v in variants])
    entries = [{"feature": text(c), "rmse_increase": f"v{j} - base"} for j, c in enumerate(features)]
    return errors.selectExpr(rows(entries)).orderBy(F.desc("rmse_increase"), "feature")

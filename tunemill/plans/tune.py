"""Random search over a mixed parameter space on a fixed validation split."""

from __future__ import annotations

import json
import math
import random
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunemill.operators.evaluate import regression_metrics
from tunemill.plans.models import fit_forest, fit_gbt, forest_learner, score
from tunemill.plans.trials import fit_forest_rows

FITTERS = {"gbt": fit_gbt, "forest": fit_forest}


def draw(space: dict[str, tuple], rng: random.Random) -> dict:
    """One point of the space."""
    point = {}
    for name, (kind, *spec) in space.items():
        if kind == "int":
            low, high, step = spec
            point[name] = low + step * rng.randint(0, (high - low) // step)
        elif kind == "log":
            point[name] = math.exp(rng.uniform(math.log(spec[0]), math.log(spec[1])))
        elif kind == "uniform":
            point[name] = rng.uniform(*spec)
        else:
            point[name] = rng.choice(spec[0])
    return point


def random_search(df: DataFrame, kind: str, space: dict[str, tuple], features: list[str], label: str,
                  trials: int = 50, seed: int = 42, metric: str = "rmse", parallelism: int = 2,
                  fixed: dict | None = None) -> tuple[dict, DataFrame]:
    """Best parameters and the trial log (trial, params, rmse, r2, is_best).

    ``df`` carries a ``split`` column; models are fitted on "train" and compared on "val". Lowest RMSE or highest R2
    wins, the earlier trial on ties. The assembled rows are cached for the length of the search.
    """
    rng = random.Random(seed)
    points = [{**draw(space, rng), **(fixed or {})} for _ in range(trials)]
    data = df.select(*features, label, "split").cache()
    train, val = data.where(F.col("split") == "train"), data.where(F.col("split") == "val")

    def trial(point: dict) -> tuple[float, float]:
        model = FITTERS[kind](train, features, label, point, seed=seed)
        row = regression_metrics(score(val, model, features), label, "prediction").first()
        return row["rmse"], row["r2"]

    try:
        with ThreadPoolExecutor(max_workers=parallelism) as pool:
            results = list(pool.map(trial, points))
    finally:
        data.unpersist()
    best = min(range(trials), key=lambda i: (results[i][0] if metric == "rmse" else -results[i][1], i))
    rows = [(i, json.dumps(p, sort_keys=True), results[i][0], results[i][1], i == best) for i, p in enumerate(points)]
    log = df.sparkSession.createDataFrame(rows, "trial int, params string, rmse double, r2 double, is_best boolean")
    return points[best], log


def refit_and_test(df: DataFrame, kind: str, params: dict, features: list[str], label: str, seed: int = 42):
    """Fit on train and validation rows with the chosen parameters; returns the model and its test metrics.

    A forest is fitted as the search does, from cells of rows that a task holds, or else by MLlib's learner.
    """
    rows, test = df.where(F.col("split").isin("train", "val")), df.where(F.col("split") == "test")
    if kind == "forest":
        held = rows.select(*features, label).persist()
        try:
            model = fit_forest_rows(held, features, label, forest_learner(params, seed))
        finally:
            held.unpersist()
        if model is not None:
            return model, regression_metrics(model.score(test), label, "prediction", len(features))
    model = FITTERS[kind](rows, features, label, params, seed=seed)
    tested = score(test, model, features)
    return model, regression_metrics(tested, label, "prediction", len(features))



"""Gradient boosting that ends when validation rows stop improving, and a search that shares its ensembles.

An ensemble is fitted once. Its error after every round comes from one pass over the validation rows, and the model is cut to
its best first trees. Trials of a search that differ only in their number of trees are read off one ensemble.
"""

from __future__ import annotations

import json
import random
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.ml.linalg import DenseVector, Vectors
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunemill.plans.models import fit_forest, fit_gbt, forest_learner, gbt_learner
from tunemill.plans.trees import Trees, errors_by_round, pack, score_trees
from tunemill.plans.trials import search_errors
from tunemill.plans.tune import draw

PATIENCE = 20
#: Trees that every trial gets at first, how many times more the next rung has, and the share of trials that reach it.
FIRST_RUNG, RUNG_GROWTH, RUNG_SHARE = 3, 5, 1 / 4


def best_round(errors: list[float], patience: int = PATIENCE, least_gain: float = 0.0) -> tuple[int, int]:
    """(best, last): rounds counted from 1; training ends ``patience`` rounds after the last gain, or with the last tree."""
    best, low = 0, float("inf")
    for n, error in enumerate(errors, 1):
        if error < low - least_gain:
            best, low = n, error
        elif n - best >= patience:
            return best, n
    return best, len(errors)


@dataclass(frozen=True)
class Boosted:
    """A boosted model cut to its best trees; ``fitted`` and ``all_trees`` are the ensemble it was cut from."""

    fitted: object
    all_trees: Trees
    features: list[str]
    best: int
    last: int

    @property
    def trees(self) -> Trees:
        return self.all_trees.first(self.best)

    @property
    def featureImportances(self) -> DenseVector:  # noqa: N802, named as in MLlib's models
        return Vectors.dense(self.trees.importances(len(self.features)))

    def score(self, df: DataFrame, name: str = "prediction") -> DataFrame:
        return score_trees(df, self.trees, self.features, name)


def fit_boosting(df: DataFrame, features: list[str], label: str, params: dict | None = None, seed: int = 42,
                 validation: Column | None = None, patience: int = PATIENCE) -> Boosted:
    """Fit on the rows outside ``validation`` and keep the trees up to the best round on those inside.

    Without validation rows all trees stay. Patience counts rounds, as ``best_round`` does.
    """
    held = F.coalesce(validation, F.lit(False)) if validation is not None else F.lit(False)
    rows = df.select(*features, label, held.alias("_held")).persist()
    try:
        fitted = fit_gbt(rows.where("NOT _held"), features, label, params, seed, by_levels=True)
        trees = pack(df.sparkSession, fitted)
        errors = errors_by_round(rows.where("_held"), trees, features, label, F.lit("validation")).orderBy("round").collect()
    finally:
        rows.unpersist()
    best, last = best_round([r.rmse for r in errors], patience) if errors else (len(trees), len(trees))
    return Boosted(fitted, trees, features, best, last)


def curve(df: DataFrame, model: Boosted, label: str, part: Column) -> DataFrame:
    """(part, round, rows, rmse, mae, is_best, after_end) of all fitted rounds; those ``after_end`` were fitted in vain."""
    table = errors_by_round(df, model.all_trees, model.features, label, part)
    return table.withColumns({"is_best": F.col("round") == model.best, "after_end": F.col("round") > model.last})


def search(df: DataFrame, kind: str, space: dict[str, tuple], features: list[str], label: str, trials: int = 50, seed: int = 42,
           patience: int = PATIENCE, parallelism: int = 4, first_rung: int | None = FIRST_RUNG,
           rungs: int | None = None) -> tuple[dict, DataFrame]:
    """Best parameters and the log (trial, params, rung, trees, best_round, rmse, is_best) of a search in rungs.

    ``kind`` is "gbt" or "forest"; ``df`` carries a ``split`` column. All trials get ``first_rung`` trees; the best share goes on
    to a rung with several times as many, until those left have all the trees they ask for. Boosting is cut by patience; a forest
    keeps what it has. Points that differ only in ``n_estimators`` share one ensemble. A trial is judged by its best error on
    "val" in the highest rung it reached, the earlier one on ties. ``rungs`` ends the search early. The rows
    are cached for the length of the search.

    Without a ``first_rung`` there is one rung, in which every trial gets all its trees (boosting as far as its patience goes). Then
    tasks grow whole ensembles from cells of rows (``trials``), if these can be held by a task.
    """
    rng = random.Random(seed)
    points = [draw(space, rng) for _ in range(trials)]
    spark = df.sparkSession
    data = df.select(*features, label, "split").where(F.col("split").isin("train", "val")).persist()
    train, val = data.where(F.col("split") == "train"), data.where(F.col("split") == "val")

    def family(point: dict) -> str:
        return json.dumps({k: v for k, v in point.items() if k != "n_estimators"}, sort_keys=True)

    def errors(task: tuple[str, int]) -> list[float]:
        fit = fit_gbt if kind == "gbt" else fit_forest
        trees = pack(spark, fit(train, features, label, {**json.loads(task[0]), "n_estimators": task[1]}, seed))
        rows = errors_by_round(val, trees, features, label, F.lit("val")).collect()
        return [r.rmse for r in sorted(rows, key=lambda r: r["round"])]

    whole: dict[str, list[int]] = {}
    for point in points:
        whole.setdefault(family(point), []).append(point["n_estimators"])
    alive, rung, budget, results = list(range(trials)), 0, first_rung or max(p["n_estimators"] for p in points), {}
    try:
        if first_rung is None:
            learner = gbt_learner if kind == "gbt" else forest_learner
            families = {own: (learner({**json.loads(own), "n_estimators": max(n)}, seed), n) for own, n in whole.items()}
            held = search_errors(data, kind, families, features, label, F.col("split") == "train", patience, seed)
            for i in alive if held is not None else []:
                own, n = held[family(points[i])], points[i]["n_estimators"]
                best, last = best_round(own[:n], patience) if kind == "gbt" else (n, n)
                results[i] = (0, last, best, own[best - 1] if kind == "gbt" else own[n])
            alive = [] if held is not None else alive
        with ThreadPoolExecutor(max_workers=parallelism) as pool:
            while alive and (rungs is None or rung < rungs):
                wanted: dict[str, int] = {}
                for i in alive:
                    own = family(points[i])
                    wanted[own] = max(wanted.get(own, 0), min(budget, points[i]["n_estimators"]))
                found = dict(zip(wanted, pool.map(errors, wanted.items())))
                for i in alive:
                    own = found[family(points[i])][:min(budget, points[i]["n_estimators"])]
                    best, last = best_round(own, patience) if kind == "gbt" else (len(own), len(own))
                    results[i] = (rung, last, best, own[best - 1])
                order = sorted(alive, key=lambda i: (results[i][3], i))
                # A trial is done if it ran out of patience or has all its trees; it stays in the log as it is.
                more = [i for i in order[:max(1, round(len(alive) * RUNG_SHARE))]
                        if results[i][1] == budget and points[i]["n_estimators"] > budget]
                alive, rung, budget = more, rung + 1, budget * RUNG_GROWTH
    finally:
        data.unpersist()
    best = min(range(trials), key=lambda i: (results[i][3], i))
    rows = [(i, json.dumps(p, sort_keys=True), *results[i], i == best) for i, p in enumerate(points)]
    log = spark.createDataFrame(rows, "trial int, params string, rung int, trees int, best_round int, rmse double, is_best boolean")
    return {**points[best], "n_estimators": results[best][2]}, log

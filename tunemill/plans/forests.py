"""Random forests from histograms: one Spark job for each level of all trees, whatever their number.

Features are cut into at most ``BINS`` intervals and packed with the goal into blocks of rows. For every level each task draws the
bootstrap of its blocks, walks the rows down the trees grown so far and adds up (weight, sum, sum of squares) for every node,
feature and interval; the tables of a tree are then added and split in one group of bounded size. Cuts, gains, leaves and pruning
follow MLlib's learner, and the result is MLlib's own model; only the draws of the bootstrap are others, which in MLlib change with
the partitions too. Nothing but nodes comes to the driver.
"""

from __future__ import annotations

import json
import math
import time
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.regression import DecisionTreeRegressor, RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tunemill.plans.trees import with_features
from tunemill.session import scratch_path

#: Intervals of a feature, and the rows drawn to set their ends.
BINS, SAMPLE = 32, 10_000
#: Rows in a block, and bytes of the tables that a task fills at once; trees beyond that take another pass.
BLOCK, TABLE_BYTES = 1 << 15, 128 << 20
#: Deeper trees than this are left to MLlib, which splits their many nodes into groups.
MAX_DEPTH = 12
#: Impurities and gains below this share of the mean square are rounding.
ROUNDING = 1e-12
STATS = 3  # weight, sum, sum of squares

_BLOCKS = pa.schema([("block", pa.int64()), ("bins", pa.binary()), ("goal", pa.binary())])
_TABLES = pa.schema([("tree", pa.int32()), ("stats", pa.binary())])
_NODES = ("tree int, node int, weight double, total double, squares double, gain double, feature int, cut int, left_weight double, "
          "left_total double, left_squares double")


def cut_points(values: np.ndarray, bins: int = BINS, size: int | None = None) -> np.ndarray:
    """Ends of at most ``bins`` intervals with about as many values each, halfway between neighbouring values.

    ``size`` is the number of values that a draw was to have; as in MLlib, what its other values leave of it counts as zeros.
    """
    distinct, counts = np.unique(values, return_counts=True)
    total = len(values)
    if size is not None:
        zeros, total, other = size - np.count_nonzero(values), size, distinct != 0
        distinct, counts = distinct[other], counts[other]
        if zeros > 0:
            place = np.searchsorted(distinct, 0)
            distinct, counts = np.insert(distinct, place, 0.0), np.insert(counts, place, zeros)
    middle = (distinct[1:] + distinct[:-1]) / 2
    if len(middle) < bins:
        return middle
    cuts, target, reached = [], total / bins, counts.cumsum()
    for i in range(1, len(distinct)):
        if abs(reached[i - 1] - target) < abs(reached[i] - target):
            cuts.append(middle[i - 1])
            target += total / bins
    return np.array(cuts)


def features_per_node(strategy: str, trees: int, features: int) -> int:
    """How many features a node may choose from, for MLlib's names of the strategies."""
    if strategy == "auto":
        strategy = "all" if trees == 1 else "onethird"
    named = {"all": features, "sqrt": math.ceil(math.sqrt(features)), "log2": max(1, math.ceil(math.log2(features))),
             "onethird": math.ceil(features / 3)}
    if strategy in named:
        return named[strategy]
    return min(int(strategy), features) if strategy.isdigit() else math.ceil(float(strategy) * features)


def _poisson() -> np.ndarray:
    """How often a row is drawn, for each 16-bit number: counts of a bootstrap with a mean of 1."""
    chance = np.array([math.exp(-1) / math.factorial(k) for k in range(9)]).cumsum()
    return np.searchsorted(np.round(chance * 65536), np.arange(65536), side="right").astype(np.uint8)


def _blocks(rows: DataFrame, cuts: list[np.ndarray]) -> DataFrame:
    """(block, bins, goal): up to ``BLOCK`` rows (or one Arrow batch more) with the interval of every feature."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, made, held, size = TaskContext.get().partitionId() << 32, 0, [], 0

        def block():
            goal, *columns = [np.concatenate([b.column(i).to_numpy() for b in held]) for i in range(len(cuts) + 1)]
            bins = np.stack([np.searchsorted(c, x).astype(np.uint8) for c, x in zip(cuts, columns)])
            return pa.RecordBatch.from_pydict({"block": [first + made], "bins": [bins.tobytes()], "goal": [goal.tobytes()]}, schema=_BLOCKS)

        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= BLOCK:
                yield block()
                made, held, size = made + 1, [], 0
        if size:
            yield block()

    return rows.mapInArrow(pack, "block long, bins binary, goal binary")


def _tables(blocks: DataFrame, level: int, trees: range, paths: list, sizes: list[int], seed: int, bootstrap: bool) -> DataFrame:
    """(tree, stats): for each task and tree (weight, sum, sum of squares) by feature, node of the level and interval.

    ``paths`` has (feature, cut) of the nodes of every level above, as tables of all trees.
    """
    nodes = 1 << level
    ends = np.r_[0, np.cumsum(np.array(sizes) * nodes)]
    drawn = _poisson()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros((len(trees), STATS, ends[-1]))
        for batch in batches:
            for number, packed, goals in zip(*[batch.column(i).to_pylist() for i in range(3)]):
                goal = np.frombuffer(goals)
                bins = np.frombuffer(packed, np.uint8).reshape(len(sizes), -1)
                for at, tree in enumerate(trees):
                    if bootstrap:
                        source = np.random.Generator(np.random.SFC64([seed, number, tree]))
                        times = drawn.take(np.frombuffer(source.bytes(2 * len(goal)), np.uint16))
                        rows = np.flatnonzero(times)
                        weight, own, y = times.take(rows).astype(float), bins.take(rows, axis=1), goal.take(rows)
                    else:
                        weight, own, y = np.ones(len(goal)), bins, goal
                    flat, place, node = own.ravel(), np.arange(len(y)), np.zeros(len(y), np.int64)
                    for feature, cut in paths:
                        value = flat.take((feature[tree] * len(y)).take(node) + place)
                        node = 2 * node + (value > cut[tree].take(node))
                    stats = (weight, weight * y, weight * y * y)
                    for f, size in enumerate(sizes):
                        index = node * size + own[f]
                        for k in range(STATS):
                            table[at, k, ends[f]:ends[f + 1]] += np.bincount(index, stats[k], nodes * size)
        yield pa.RecordBatch.from_pydict({"tree": list(trees), "stats": [t.tobytes() for t in table]}, schema=_TABLES)

    return blocks.mapInArrow(run, "tree int, stats binary")


def variance(weight, total, squares):
    with np.errstate(divide="ignore", invalid="ignore"):
        return (squares - total * total / weight) / weight


def best_of(whole: np.ndarray, level: int, sizes: list[int], least: float, open_to: np.ndarray) -> dict[str, np.ndarray]:
    """The split of largest gain of every node of a level, from the table (statistic, feature and node and interval) of a tree."""
    nodes = 1 << level
    ends = np.r_[0, np.cumsum(np.array(sizes) * nodes)]
    first = whole[:, :ends[1]].reshape(STATS, nodes, sizes[0])
    node = first.sum(axis=2)
    lefts, gains = [], []
    for f, size in enumerate(sizes):
        left = whole[:, ends[f]:ends[f + 1]].reshape(STATS, nodes, size).cumsum(axis=2)[:, :, :-1]
        right = node[:, :, None] - left
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = variance(*node)[:, None] - (left[0] * variance(*left) + right[0] * variance(*right)) / node[0][:, None]
        allowed = (left[0] >= least) & (right[0] >= least) & open_to[:, f, None] & np.isfinite(gain)
        lefts.append(left)
        gains.append(np.where(allowed, gain, -np.inf))
    gain, left = np.concatenate(gains, axis=1), np.concatenate(lefts, axis=2)
    feature = np.repeat(np.arange(len(sizes)), [s - 1 for s in sizes])
    cut = np.concatenate([np.arange(s - 1) for s in sizes])
    if not len(cut):
        gain, left, feature, cut = np.full((nodes, 1), -np.inf), np.zeros((STATS, nodes, 1)), np.zeros(1, int), np.zeros(1, int)
    top, own = gain.argmax(axis=1), np.arange(nodes)
    return {"node": own, "weight": node[0], "total": node[1], "squares": node[2], "gain": gain[own, top], "feature": feature[top],
            "cut": cut[top], "left_weight": left[0, own, top], "left_total": left[1, own, top], "left_squares": left[2, own, top]}


def _best_splits(tables: DataFrame, level: int, sizes: list[int], least: float, choice: int, seed: int) -> DataFrame:
    """The split of largest gain of every node of the level, from the tables of all tasks."""
    def best(group: pd.DataFrame) -> pd.DataFrame:
        tree = int(group["tree"].iat[0])
        whole = sum(np.frombuffer(t) for t in group["stats"]).reshape(STATS, -1)
        source = np.random.Generator(np.random.SFC64([seed, level, tree, 1]))
        open_to = source.random((1 << level, len(sizes))).argsort(axis=1).argsort(axis=1) < choice
        return pd.DataFrame({"tree": tree, **best_of(whole, level, sizes, least, open_to)})

    return tables.groupBy("tree").applyInPandas(best, _NODES)


def _grown(blocks: DataFrame, sizes: list[int], trees: int, depth: int, least: float, choice: int, seed: int, bootstrap: bool):
    """Statistics, gain, feature and cut of all nodes; node 1 is the root, nodes 2n and 2n + 1 follow on n."""
    stats, gain = np.zeros((trees, 2 << depth, STATS)), np.full((trees, 2 << depth), -1.0)
    feature, cut, paths = np.full((trees, 2 << depth), -1), np.zeros((trees, 2 << depth), int), []
    active = np.ones((trees, 1), bool)
    for level in range(max(depth, 1)):
        start = nodes = 1 << level
        together = max(1, TABLE_BYTES // (nodes * sum(sizes) * STATS * 8))
        step_feature, step_cut = np.zeros((trees, nodes), np.int64), np.full((trees, nodes), 255, np.uint8)
        for at in range(0, trees, together):
            own = range(at, min(at + together, trees))
            found = _best_splits(_tables(blocks, level, own, paths, sizes, seed, bootstrap), level, sizes, least, choice, seed).toPandas()
            for tree, rows in found.groupby("tree"):
                rows = rows.sort_values("node")
                here = rows[["weight", "total", "squares"]].to_numpy()
                if level == 0:
                    stats[tree, 1] = here[0]
                noise = ROUNDING * here[:, 2] / np.maximum(here[:, 0], 1)
                splits = active[tree] & (rows["gain"].to_numpy() > noise) & (depth > 0)
                node = start + np.flatnonzero(splits)
                rows, here = rows[splits], here[splits]
                left = rows[["left_weight", "left_total", "left_squares"]].to_numpy()
                feature[tree, node], cut[tree, node], gain[tree, node] = rows["feature"], rows["cut"], rows["gain"]
                stats[tree, 2 * node], stats[tree, 2 * node + 1] = left, here - left
                step_feature[tree, node - start], step_cut[tree, node - start] = rows["feature"], rows["cut"]
        paths.append((step_feature, step_cut))
        below = stats[:, 2 * start:4 * start]
        mixed = variance(*np.moveaxis(below, 2, 0)) > ROUNDING * below[:, :, 2] / np.maximum(below[:, :, 0], 1)
        active = np.repeat(feature[:, start:2 * start] >= 0, 2, axis=1) & mixed
        if not active.any():
            break
    return stats, gain, feature, cut


def saved_nodes(tree: int, stats, gain, feature, cut, cuts: list[np.ndarray]) -> list[tuple]:
    """A tree's nodes in MLlib's saved form, numbered downwards from the left; equal neighbouring leaves become one."""
    value = stats[:, 1] / np.where(stats[:, 0] == 0, 1, stats[:, 0])
    spread = np.maximum(variance(*stats.T), 0.0)
    inner = feature >= 0
    for node in range(len(inner) // 2 - 1, 0, -1):
        if inner[node] and not inner[2 * node] and not inner[2 * node + 1] and value[2 * node] == value[2 * node + 1]:
            inner[node] = False
    out = []

    def add(node: int) -> int:
        own = len(out)
        out.append(None)
        left, right = (add(2 * node), add(2 * node + 1)) if inner[node] else (-1, -1)
        split = (int(feature[node]), [float(cuts[feature[node]][cut[node]])], -1) if inner[node] else (-1, [], -1)
        out[own] = (tree, (own, float(value[node]), float(spread[node]), [float(v) for v in stats[node]], int(stats[node, 0]),
                           float(gain[node]) if inner[node] else -1.0, left, right, split))
        return own

    add(1)
    return out


_SAVED = ("treeID int, nodeData struct<id: int, prediction: double, impurity: double, impurityStats: array<double>, rawCount: bigint, "
          "gain: double, leftChild: int, rightChild: int, split: struct<featureIndex: int, leftCategoriesOrThreshold: array<double>, "
          "numCategories: int>>")


def saved_model(spark: SparkSession, learner, kind: type, nodes: list[tuple], features: int, weights: list[float]):
    """MLlib's model of the class ``kind`` with these trees, read from its saved form; ``weights`` are what the trees count."""
    def described(name: str, uid: str, **more) -> str:
        own = {p.name: v for p, v in learner.extractParamMap().items() if learner.isSet(p)}
        usual = {p.name: learner._defaultParamMap[p] for p in learner.params if learner.hasDefault(p)}
        return json.dumps({"class": f"org.apache.spark.ml.regression.{name}", "timestamp": int(time.time() * 1000), "sparkVersion": spark.version,
                           "uid": uid, "paramMap": own, "defaultParamMap": {**usual, "leafCol": ""}, **more})

    path = scratch_path(spark, "grown")
    whole = described(kind.__name__, learner.uid, numFeatures=features, numTrees=len(weights))
    spark.createDataFrame([(whole,)], "value string").coalesce(1).write.text(f"{path}/metadata")
    spark.createDataFrame(nodes, _SAVED).write.parquet(f"{path}/data")
    single = json.loads(described("DecisionTreeRegressionModel", ""))
    for values in (single["paramMap"], single["defaultParamMap"]):
        for name in [n for n in values if n != "leafCol" and not DecisionTreeRegressor().hasParam(n)]:
            values.pop(name)
    rows = [(i, json.dumps({**single, "uid": f"{learner.uid}_{i}"}), float(w)) for i, w in enumerate(weights)]
    spark.createDataFrame(rows, "_1 int, _2 string, _3 double").write.parquet(f"{path}/treesMetadata")
    return kind.load(path)


def number(name: str):
    """The column as a double; a value without an end is an error, as in MLlib's learners."""
    value = F.col(name).cast("double")
    return F.when(F.abs(value) < float("inf"), value).otherwise(F.raise_error(F.lit(f"column {name} has a value that is not finite")).cast("double"))


def grow_forest(df: DataFrame, features: list[str], label: str, learner: RandomForestRegressor) -> RandomForestRegressionModel:
    """The forest that ``learner`` describes, from the rows of ``df`` without a missing feature or goal."""
    spark = df.sparkSession
    tasks = max(8, spark.sparkContext.defaultParallelism)
    rows = with_features(df, features).where(F.col(label).isNotNull()).select(
        number(label).alias("goal"), *[number(c).alias(f"x{i}") for i, c in enumerate(features)]).coalesce(tasks)
    trees, depth, seed = learner.getNumTrees(), learner.getMaxDepth(), learner.getSeed()
    drawn = rows.withColumn("_at", F.rand(seed)).orderBy("_at").limit(SAMPLE).drop("_at").toPandas()
    if drawn.empty:
        raise ValueError("a forest needs at least one row without missing values")
    cuts = [cut_points(drawn[f"x{i}"].to_numpy(), min(BINS, len(drawn))) for i in range(len(features))]
    blocks = _blocks(rows, cuts).persist()
    try:
        grown = _grown(blocks, [len(c) + 1 for c in cuts], trees, depth, learner.getMinInstancesPerNode(),
                       features_per_node(learner.getFeatureSubsetStrategy(), trees, len(features)), seed, learner.getBootstrap())
    finally:
        blocks.unpersist()
    nodes = [row for t in range(trees) for row in saved_nodes(t, *[a[t] for a in grown], cuts)]
    return saved_model(spark, learner, RandomForestRegressionModel, nodes, len(features), [1.0] * trees)

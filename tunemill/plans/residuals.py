"""Boosted trees from histograms of residuals: one Spark job for each level of a tree, over rows packed once.

Features are cut into at most ``BINS`` intervals. A tree sees a row only through its intervals, so rows of a task with the same ones
become a cell: their number, mean residual and squared deviations, which give the same sums. Where few rows agree a cell is a row.
Each job adds up (weight, sum, sum of squares) of the cells for every node, feature and interval, and only these tables come to the
driver, which splits the nodes. Once per tree the cells get the residuals that it leaves. Cuts, gains, leaves and pruning follow
MLlib's learner, and the result is MLlib's own model.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from tunemill.plans.forests import BINS, MAX_DEPTH, ROUNDING, SAMPLE, STATS, best_of, cut_points, number, saved_model, saved_nodes, variance
from tunemill.plans.trees import with_features

#: Rows of a task that are put into cells at once, and cells in a block.
ROWS, CELLS = 1 << 18, 1 << 18
#: Residuals of this many trees are made from those before, then again from the first ones, so that the lineage stays short.
LINKS = 20
#: Bytes of the table that a task sends for the deepest level of a tree; larger ones are left to MLlib's learner.
TABLE_BYTES = 4 << 20
#: Cells that do not fit into memory go to disk.
KEPT = StorageLevel.MEMORY_AND_DISK
#: Intervals of more combinations than this are not numbered, and every row is a cell.
NUMBERED = 1 << 62

#: Keys of cells (or intervals by feature, if not numbered), their number of rows, squared deviations and mean goal.
_CELLS = pa.schema([("bins", pa.binary()), ("rows", pa.binary()), ("spread", pa.binary()), ("rest", pa.binary())])
_CELLS_SQL = "bins binary, rows binary, spread binary, rest binary"


def _drawn(rows: DataFrame, size: int, count: int, seed: int) -> DataFrame:
    """All rows, or about ``size`` of them by the draw of MLlib's learner: with the same rows the cuts are the same."""
    if count <= size:
        return rows
    spark = rows.sparkSession
    own = spark.sparkContext._jvm.org.apache.spark.util.random.XORShiftRandom(seed).nextInt()
    return DataFrame(spark._jsparkSession.createDataFrame(rows._jdf.javaRDD().sample(False, size / count, own), rows._jdf.schema()), spark)


def _merged(key: np.ndarray, rows: np.ndarray, rest: np.ndarray, spread: np.ndarray) -> tuple:
    """Cells with equal keys as one."""
    distinct, own = np.unique(key, return_inverse=True)
    weight = np.bincount(own, rows)
    mean = np.bincount(own, rows * rest) / weight
    return distinct, weight, mean, np.bincount(own, spread + rows * (rest - mean.take(own)) ** 2)


def _cells(rows: DataFrame, cuts: list[np.ndarray]) -> RDD:
    """Blocks of about ``CELLS`` cells, (bins by feature, rows, spread, rest); rows and spread are None if all cells are single rows.

    Rows are merged within tasks, then cells of all tasks by groups of keys; a block of single rows needs no key.
    """
    sizes = [len(c) + 1 for c in cuts]
    numbered = math.prod(sizes) < NUMBERED

    def taken(batches: list[pa.RecordBatch]) -> tuple:
        goal, *columns = [np.concatenate([b.column(i).to_numpy() for b in batches]) for i in range(len(cuts) + 1)]
        return goal, np.stack([np.searchsorted(c, x).astype(np.uint8) for c, x in zip(cuts, columns)])

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.RecordBatch]]:
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= ROWS:
                yield held
                held, size = [], 0
        if size:
            yield held

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def block(key, weight, rest, spread):
            return pa.RecordBatch.from_pydict({"bins": [key.tobytes()], "rows": [weight.tobytes()], "spread": [spread.tobytes()], "rest": [rest.tobytes()]},
                                              schema=_CELLS)

        held = None
        for chunk in chunks(batches):
            goal, bins = taken(chunk)
            if not numbered:
                yield pa.RecordBatch.from_pydict({"bins": [bins.tobytes()], "rows": [b""], "spread": [b""], "rest": [goal.tobytes()]}, schema=_CELLS)
                continue
            new = (np.ravel_multi_index(bins, sizes), np.ones(len(goal)), goal, np.zeros(len(goal)))
            held = _merged(*(new if held is None else [np.concatenate(pair) for pair in zip(held, new)]))
            if len(held[0]) >= CELLS:
                yield block(*held)
                held = None
        if held is not None:
            yield block(*held)

    blocks = rows.mapInArrow(merge, _CELLS_SQL).rdd.map(_arrays)
    if not numbered:
        return blocks.map(lambda b: (b[0].view(np.uint8).reshape(len(sizes), -1), None, None, b[3]))
    blocks.persist(KEPT)
    tasks = blocks.getNumPartitions()
    groups = max(tasks, math.ceil(blocks.map(lambda b: len(b[3])).sum() / CELLS))

    def dealt(block: tuple) -> Iterator[tuple]:
        key, weight, spread, rest = block
        group = key % groups
        order = group.argsort(kind="stable")
        ends = np.searchsorted(group.take(order), np.arange(groups + 1))
        for g in range(groups):
            own = order[ends[g]:ends[g + 1]]
            if len(own):
                yield g, (key.take(own), weight.take(own), rest.take(own), spread.take(own))

    def cells(parts) -> tuple:
        key, weight, rest, spread = _merged(*[np.concatenate(same) for same in zip(*sorted(parts, key=lambda p: (p[0][0], len(p[0]), p[2][0])))])
        bins = np.stack(np.unravel_index(key, sizes)).astype(np.uint8)
        return (bins, None, None, rest) if (weight == 1).all() else (bins, weight, spread, rest)

    return blocks.flatMap(dealt).groupByKey(tasks).mapValues(cells).values()


def _arrays(block: Row) -> tuple:
    """(keys or bins, rows, spread, rest) of a block."""
    return np.frombuffer(block.bins, np.int64 if block.rows else np.uint8), *[np.frombuffer(x) for x in (block.rows, block.spread, block.rest)]


def _node(bins: np.ndarray, paths: list) -> np.ndarray:
    """Where the cells are after the levels of ``paths``, (feature, cut) of the nodes of each."""
    flat, place, node = bins.ravel(), np.arange(bins.shape[1]), np.zeros(bins.shape[1], np.int64)
    for feature, cut in paths:
        value = flat.take((feature * bins.shape[1]).take(node) + place) if len(feature) > 1 else bins[feature[0]]
        node = 2 * node + (value > cut.take(node))
    return node


def _less(cells: RDD, trees: list) -> RDD:
    """The cells with what ``trees``, (paths, values of the last nodes), leave of the residuals."""
    def left(block: tuple) -> tuple:
        bins, rows, spread, rest = block
        for paths, values in trees:
            rest = rest - values.take(_node(bins, paths))
        return bins, rows, spread, rest

    return cells.map(left)


def _table(cells: RDD, level: int, paths: list, sizes: list[int], scale: float) -> np.ndarray:
    """(weight, sum, sum of squares) of ``scale`` times the residuals, by feature, node of the level and interval."""
    nodes = 1 << level
    ends = np.r_[0, np.cumsum(np.array(sizes) * nodes)]

    def added(blocks: Iterator[tuple]) -> Iterator[np.ndarray]:
        table = np.zeros((STATS, ends[-1]))
        for bins, rows, spread, rest in blocks:
            node, goal = _node(bins, paths), scale * rest
            stats = (None, goal, goal * goal) if rows is None else (rows, rows * goal, scale * scale * spread + rows * goal * goal)
            for f, size in enumerate(sizes):
                index = node * size + bins[f]
                for k in range(STATS):
                    table[k, ends[f]:ends[f + 1]] += np.bincount(index, stats[k], nodes * size)
        yield table

    return sum(cells.mapPartitions(added).collect())


def _grown(cells: RDD, sizes: list[int], depth: int, least: float, least_gain: float, scale: float) -> tuple:
    """Statistics, gain, feature and cut of all nodes of a tree, numbered as in forests, and its paths."""
    stats, gain = np.zeros((2 << depth, STATS)), np.full(2 << depth, -1.0)
    feature, cut, paths, active = np.full(2 << depth, -1), np.zeros(2 << depth, int), [], np.ones(1, bool)
    for level in range(max(depth, 1)):
        start = 1 << level
        found = best_of(_table(cells, level, paths, sizes, scale), level, sizes, least, np.ones((start, len(sizes)), bool))
        here = np.column_stack([found["weight"], found["total"], found["squares"]])
        if level == 0:
            stats[1] = here[0]
        noise = ROUNDING * here[:, 2] / np.maximum(here[:, 0], 1)
        splits = np.flatnonzero(active & (found["gain"] > noise) & (found["gain"] >= least_gain) & (depth > 0))
        node, left = start + splits, np.column_stack([found["left_weight"], found["left_total"], found["left_squares"]])[splits]
        feature[node], cut[node], gain[node] = found["feature"][splits], found["cut"][splits], found["gain"][splits]
        stats[2 * node], stats[2 * node + 1] = left, here[splits] - left
        step_feature, step_cut = np.zeros(start, np.int64), np.full(start, 255, np.uint8)
        step_feature[splits], step_cut[splits] = feature[node], cut[node]
        paths.append((step_feature, step_cut))
        below = stats[2 * start:4 * start]
        mixed = variance(*below.T) > ROUNDING * below[:, 2] / np.maximum(below[:, 0], 1)
        active = np.repeat(feature[start:2 * start] >= 0, 2) & mixed
        if not active.any():
            break
    return stats, gain, feature, cut, paths


def _values(stats: np.ndarray, feature: np.ndarray, levels: int) -> np.ndarray:
    """What the tree says at each node after its last level; a node that does not split sends all to its left."""
    value = stats[:, 1] / np.where(stats[:, 0] == 0, 1, stats[:, 0])
    for level in range(levels):
        for node in range(1 << level, 2 << level):
            if feature[node] < 0:
                value[2 * node] = value[2 * node + 1] = value[node]
    return value[1 << levels:2 << levels]


def by_levels(learner: GBTRegressor, features: int) -> bool:
    """Whether the trees can be grown here: all rows and features for every tree, and tables of bounded size."""
    depth = learner.getMaxDepth()
    return (depth <= MAX_DEPTH and learner.getSubsamplingRate() == 1 and learner.getFeatureSubsetStrategy() in ("all", "auto")
            and STATS * 8 * features * BINS * (1 << max(depth - 1, 0)) <= TABLE_BYTES)


def grow_boosted(df: DataFrame, features: list[str], label: str, learner: GBTRegressor) -> GBTRegressionModel:
    """The boosted trees that ``learner`` describes, from the rows of ``df`` without a missing feature or goal."""
    spark, seed, depth = df.sparkSession, learner.getSeed(), learner.getMaxDepth()
    rows = with_features(df, features).where(F.col(label).isNotNull()).select(
        number(label).alias("goal"), *[number(c).alias(f"x{i}") for i, c in enumerate(features)])
    count = rows.count()
    if not count:
        raise ValueError("boosting needs at least one row without missing values")
    drawn = _drawn(rows.drop("goal"), SAMPLE, count, seed).toPandas()
    cuts = [cut_points(drawn[f"x{i}"].to_numpy(), min(BINS, count), SAMPLE if count > SAMPLE else None) for i in range(len(features))]
    sizes = [len(c) + 1 for c in cuts]
    first = _cells(rows.coalesce(max(8, spark.sparkContext.defaultParallelism)), cuts).persist(KEPT)
    states, trees, nodes, weights = [first], [], [], []
    try:
        for tree in range(learner.getMaxIter()):
            # The first tree learns the goal, the others the slope of the squared error, twice the residual.
            *grown, paths = _grown(states[-1], sizes, depth, learner.getMinInstancesPerNode(), learner.getMinInfoGain(), 2.0 if tree else 1.0)
            for old in states[1:-1]:
                old.unpersist()
            weights.append(learner.getStepSize() if tree else 1.0)
            nodes += saved_nodes(tree, *grown, cuts)
            trees.append((paths, weights[-1] * _values(grown[0], grown[2], len(paths))))
            again = len(trees) % LINKS == 0
            states = [first, *states[1:][-1:], _less(first if again else states[-1], trees if again else trees[-1:]).persist(KEPT)]
    finally:
        for held in states:
            held.unpersist()
    return saved_model(spark, learner, GBTRegressionModel, nodes, len(features), weights)

"""Ensembles of regression trees as packed node tables.

A fitted MLlib ensemble is saved to the shared folder and read back as rows of nodes, which become a few arrays (feature,
cut, children, value) for all trees together. Tasks walk a whole Arrow batch through all trees level by level, so a plan has
the same size for 5 trees and for 500, every tree's own prediction comes out of one pass, and a boosted model can be cut to
its first trees.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from tunemill.session import scratch_path

#: Rows times trees that are walked at once in a task.
WALKED = 1 << 20
LEAF = -1
#: Trees of up to this many leaves are read by a bit for each leaf; a number whose products with the single bits differ in their first six.
LEAVES, HASH = 64, 0x03F79D71B4CB0A89
#: Deeper trees are walked without counting their leaves.
DEEPEST = 12


@dataclass(frozen=True)
class Trees:
    """Nodes of all trees one after another; ``roots`` are their first nodes, ``weights`` what a tree's value counts."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    weights: np.ndarray
    depth: int
    #: Fall of the error at a node times its rows, what importances are made of.
    gain: np.ndarray
    #: A forest is the mean of its trees, a boosted model their sum.
    mean: bool

    def __len__(self) -> int:
        return len(self.roots)

    def first(self, n: int) -> Trees:
        """The ensemble of the first ``n`` trees."""
        return replace(self, roots=self.roots[:n], weights=self.weights[:n])

    def importances(self, features: int) -> np.ndarray:
        """Share of each feature in the total gain of these trees."""
        ends = np.r_[self.roots[1:], self.roots[-1:] + self._size(len(self) - 1)] if len(self) else self.roots
        total = np.zeros(features)
        for start, end in zip(self.roots, ends):
            own = np.flatnonzero(self.feature[start:end] != LEAF) + start
            np.add.at(total, self.feature[own], self.gain[own])
        return total / total.sum() if total.sum() else total

    def _size(self, tree: int) -> int:
        """Number of nodes of a tree: its last node is the right-most one."""
        reach = self.roots[tree]
        level = np.array([reach])
        while len(level):
            reach = max(reach, level.max())
            level = level[self.feature[level] != LEAF]
            level = np.concatenate([self.left[level], self.right[level]])
        return int(reach - self.roots[tree] + 1)

    @cached_property
    def _steps(self) -> tuple[np.ndarray, np.ndarray]:
        """Feature to look at and the two next nodes of each node; a leaf leads to itself, so that a walk needs no test for it."""
        inner, own = self.feature != LEAF, np.arange(len(self.feature))
        follow = np.column_stack([np.where(inner, self.left, own), np.where(inner, self.right, own)]).astype(np.int32)
        return np.maximum(self.feature, 0), follow.ravel()

    @cached_property
    def _reached(self) -> tuple[list[np.ndarray], list[tuple]] | None:
        """Cuts by feature and, by tree, which leaves (bits) the interval of each feature leaves open, and their values by hash.

        Every row has one leaf that all its intervals leave open. None if a tree has more leaves than bits.
        """
        inner = np.flatnonzero(self.feature != LEAF)
        cuts = [np.unique(self.cut[inner][self.feature[inner] == f]) for f in range(self.feature.max(initial=LEAF) + 1)]
        trees = []
        for root, weight in zip(self.roots, self.weights):
            open_to, values = {}, np.zeros(LEAVES)

            def below(node: int, first: int) -> int:
                """The number after that of the last leaf under ``node``, whose leaves count from ``first``."""
                f = int(self.feature[node])
                if f == LEAF:
                    if first < LEAVES:
                        values[((HASH << first) % (1 << 64)) >> 58] = self.value[node] * weight
                    return first + 1
                middle = below(self.left[node], first)
                end = below(self.right[node], middle)
                if end <= LEAVES:
                    table = open_to.setdefault(f, np.full(len(cuts[f]) + 1, (1 << 64) - 1, np.uint64))
                    at = np.searchsorted(cuts[f], self.cut[node]) + 1
                    table[:at] &= np.uint64(~((1 << end) - (1 << middle)) % (1 << 64))
                    table[at:] &= np.uint64(~((1 << middle) - (1 << first)) % (1 << 64))
                return end

            if (leaves := below(int(root), 0)) > LEAVES:
                return None
            trees.append((np.uint64((1 << leaves) - 1), list(open_to.items()), values))
        return cuts, trees

    def each(self, x: np.ndarray) -> np.ndarray:
        """(rows, trees): the value of every tree for every row, times the tree's weight."""
        if self.depth <= DEEPEST and self._reached is not None:
            return self._each_by_leaves(x)
        out = np.empty((len(x), len(self)))
        rows = max(1, WALKED // max(1, len(self)))
        feature, follow = self._steps
        for at in range(0, len(x), rows):
            part = x[at:at + rows]
            flat, node = part.ravel(), np.tile(self.roots, len(part))
            own = np.repeat(np.arange(len(part), dtype=np.int32) * x.shape[1], len(self))
            for _ in range(self.depth):
                goes_left = flat.take(own + feature.take(node)) <= self.cut.take(node)
                node = follow.take(2 * node + ~goes_left)
            out[at:at + rows] = self.value.take(node).reshape(len(part), len(self)) * self.weights
        return out

    def _each_by_leaves(self, x: np.ndarray) -> np.ndarray:
        cuts, trees = self._reached
        out, rows = np.empty((len(self), len(x))), max(1, WALKED // max(1, len(self)))
        for at in range(0, len(x), rows):
            interval = [np.searchsorted(c, x[at:at + rows, f]) for f, c in enumerate(cuts)]
            for t, (every, tables, values) in enumerate(trees):
                leaf = every
                for f, table in tables:
                    leaf = leaf & table.take(interval[f])
                out[t, at:at + rows] = values.take((leaf * np.uint64(HASH) >> np.uint64(58)).astype(np.int64)) if tables else values[HASH >> 58]
        return out.T

    def total(self, x: np.ndarray) -> np.ndarray:
        """The prediction for every row."""
        each = self.each(x)
        return each.mean(axis=1) if self.mean else each.sum(axis=1)

    def running(self, x: np.ndarray) -> np.ndarray:
        """(rows, trees): the prediction of the first 1, 2, ... trees for every row."""
        sums = self.each(x).cumsum(axis=1)
        return sums / np.arange(1, len(self) + 1) if self.mean else sums


def pack(spark: SparkSession, model) -> Trees:
    """The node tables of a fitted MLlib forest or boosted model with numeric features."""
    path = scratch_path(spark, "trees")
    model.write().save(path)
    n = F.col("nodeData")
    nodes = spark.read.parquet(f"{path}/data").select(
        "treeID", n["id"].alias("id"), n["prediction"].alias("value"), n["leftChild"].alias("left"), n["rightChild"].alias("right"),
        n["split"]["featureIndex"].alias("feature"), F.get(n["split"]["leftCategoriesOrThreshold"], F.lit(0)).alias("cut"),
        n["split"]["numCategories"].alias("categories"), (n["gain"] * n["rawCount"]).alias("gain")).toPandas().sort_values(["treeID", "id"])
    inner = nodes["left"].to_numpy() >= 0
    if (nodes["categories"].to_numpy()[inner] >= 0).any():
        raise ValueError("trees with categorical splits cannot be packed")
    tree = nodes["treeID"].to_numpy()
    roots = np.flatnonzero(np.r_[True, tree[1:] != tree[:-1]])
    offset = np.repeat(roots, np.diff(np.r_[roots, len(tree)]))  # ids count up from 0 within a tree
    child = lambda name: np.where(inner, nodes[name].to_numpy() + offset, 0).astype(np.int32)
    depth = max([t.depth for t in model.trees], default=0)
    return Trees(np.where(inner, nodes["feature"].to_numpy(), LEAF).astype(np.int32), nodes["cut"].to_numpy().astype(float),
                 child("left"), child("right"), nodes["value"].to_numpy().astype(float), roots.astype(np.int32), np.array(model.treeWeights, float), depth,
                 nodes["gain"].to_numpy().astype(float), mean=not hasattr(model, "evaluateEachIteration"))


def _matrix(columns) -> np.ndarray:
    return np.column_stack([np.asarray(c, float) for c in columns]) if columns else np.empty((0, 0))


def with_features(df: DataFrame, features: list[str]) -> DataFrame:
    """Rows without a missing feature."""
    have = F.lit(True)
    for c in features:
        have = have & F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double"))
    return df.where(have)


def score_trees(df: DataFrame, trees: Trees, features: list[str], name: str = "prediction") -> DataFrame:
    """``df`` with the prediction of all trees; rows with missing features are skipped."""
    held = df.sparkSession.sparkContext.broadcast(trees)

    @pandas_udf("double")
    def total(*columns: pd.Series) -> pd.Series:
        return pd.Series(held.value.total(_matrix(columns)))

    return with_features(df, features).withColumn(name, total(*[F.col(c).cast("double") for c in features]))


def spread_of_trees(trees: Trees, spark: SparkSession, features: list[str]) -> Column:
    """struct(prediction, pred_std): mean and population deviation of the single trees of a forest."""
    held = spark.sparkContext.broadcast(trees)

    @pandas_udf("prediction double, pred_std double")
    def spread(*columns: pd.Series) -> pd.DataFrame:
        each = held.value.each(_matrix(columns))
        return pd.DataFrame({"prediction": each.mean(axis=1), "pred_std": each.std(axis=1)})

    return spread(*[F.col(c).cast("double") for c in features])


_ERRORS = pa.schema([("part", pa.string()), ("round", pa.int64()), ("rows", pa.int64()), ("squared", pa.float64()), ("absolute", pa.float64())])


def errors_by_round(df: DataFrame, trees: Trees, features: list[str], label: str, part: Column) -> DataFrame:
    """(part, round, rows, rmse, mae) of the first 1, 2, ... trees, from one pass with a running sum per row."""
    held = df.sparkSession.sparkContext.broadcast(trees)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict = {}
        for batch in batches:
            columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns[2:]]
            parts = np.array(batch.column(0).to_pylist(), object)
            rows = max(1, WALKED // max(1, len(held.value)))
            for at in range(0, batch.num_rows, rows):
                off = batch.column(1).to_numpy()[at:at + rows, None] - held.value.running(_matrix([c[at:at + rows] for c in columns]))
                for name in set(parts[at:at + rows]):
                    own = off[parts[at:at + rows] == name]
                    old = sums.get(name, (0, 0.0, 0.0))
                    sums[name] = (old[0] + len(own), old[1] + (own * own).sum(axis=0), old[2] + np.abs(own).sum(axis=0))
        for name, (n, squared, absolute) in sums.items():
            t = len(squared)
            yield pa.RecordBatch.from_pydict({"part": [name] * t, "round": list(range(1, t + 1)), "rows": [n] * t, "squared": squared,
                                              "absolute": absolute}, schema=_ERRORS)

    rows = with_features(df, features).where(F.col(label).isNotNull()).select(
        part.cast("string").alias("part"), F.col(label).cast("double").alias("goal"), *[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(features)])
    sums = rows.mapInArrow(run, "part string, round long, rows long, squared double, absolute double")
    n = F.sum("rows")
    return sums.groupBy("part", "round").agg(n.alias("rows"), F.sqrt(F.sum("squared") / n).alias("rmse"), (F.sum("absolute") / n).alias("mae"))

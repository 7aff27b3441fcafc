"""Most similar items by cosine, optionally blended with a second score."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tunemill.operators.cells import neighbours, of_length, unit

SEEDS_PER_PASS = 1000


def _leading(seed: np.ndarray, ids: np.ndarray, score: np.ndarray, n: int) -> np.ndarray:
    """Positions of the ``n`` best candidates of each seed, smaller ids first among equal scores."""
    order = np.lexsort((ids, -score, seed))
    seed = seed[order]
    first = np.flatnonzero(np.r_[True, seed[1:] != seed[:-1]]) if len(seed) else np.empty(0, np.int64)
    place = np.arange(len(seed)) - np.repeat(first, np.diff(np.r_[first, len(seed)]))
    return order[place < n]


def similar_items(items: DataFrame, seeds: DataFrame, id_col: str, vector: Column, n: int,
                  extra: Column | None = None, weight: float = 1.0, digits: int = 6) -> DataFrame:
    """(seed_id, item_id, similarity, score, rank): the ``n`` best items for each seed.

    ``score = weight * similarity + (1 - weight) * extra``, rounded before ranking; ties go to the smaller id. Whole
    numbers stay 64-bit ids, other ids are texts. Rows without id or vector are left out; vectors must have one length.
    Up to ``SEEDS_PER_PASS`` seeds go to every task, which multiplies its batches with them and keeps ``n`` rows per seed,
    so that no item x seed table is built. More seeds are searched in cells (:mod:`tunemill.operators.cells`).
    """
    kind = "long" if isinstance(items.schema[id_col].dataType, T.IntegralType) else "string"
    known = "v IS NOT NULL AND id IS NOT NULL"
    requests = seeds.select(F.col(id_col).cast(kind).alias("id"), vector.cast("array<double>").alias("v")).where(known)
    rows = items.select(F.col(id_col).cast(kind).alias("id"), vector.cast("array<double>").alias("v"),
                        (F.lit(0.0) if extra is None else extra.cast("double")).alias("extra")).where(known)
    schema = f"seed_id {kind}, item_id {kind}, similarity double, score double"
    id_type = "int64" if kind == "long" else str

    def pass_over(block):
        size = len(block[0][1])
        if any(len(v) != size for _, v in block):
            raise ValueError("the vectors of the seeds differ in length")
        seed_ids = np.array([i for i, _ in block], dtype=id_type)
        matrix = unit(np.array([v for _, v in block], dtype="float64"))

        def local_top(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            best = (np.empty(0, "int64"), np.empty(0, id_type), np.empty(0), np.empty(0))
            for batch in batches:
                if batch.empty:
                    continue
                ids = batch["id"].to_numpy().astype(id_type)
                sims = matrix @ unit(np.stack(batch["v"].to_numpy())).T
                score = np.round(weight * sims + (1.0 - weight) * batch["extra"].to_numpy()[None, :], digits)
                score[(seed_ids[:, None] == ids[None, :]) | ~np.isfinite(score)] = -np.inf
                cut = np.partition(score, -n, axis=1)[:, -n, None] if score.shape[1] > n else -np.inf
                seed, item = np.nonzero((score >= cut) & np.isfinite(score))
                found = (seed, ids[item], np.round(sims[seed, item], digits), score[seed, item])
                best = tuple(np.concatenate(pair) for pair in zip(best, found))
                keep = _leading(best[0], best[1], best[3], n)
                best = tuple(column[keep] for column in best)
            yield pd.DataFrame({"seed_id": seed_ids[best[0]], "item_id": best[1], "similarity": best[2], "score": best[3]})

        return rows.where(of_length(size)).mapInPandas(local_top, schema)

    first = requests.limit(SEEDS_PER_PASS + 1).collect()
    if len(first) <= SEEDS_PER_PASS:
        found = pass_over(first) if first else items.sparkSession.createDataFrame([], schema)
    else:
        found, _ = neighbours(rows, requests, n, weight, digits)
    best = W.partitionBy("seed_id").orderBy(F.desc("score"), "item_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= n)

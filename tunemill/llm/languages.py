"""Language of documents by a mixture of languages, fitted per document with expectation-maximisation.

Training counts hashed byte trigrams of lower-cased letters per language over all labelled rows. A document's trigrams are
then explained by a mixture of the languages: expectation-maximisation finds the proportions, languages enter the set in
the order of their proportion as long as the log-likelihood rises by more than a penalty, and the largest proportion
names the language, its value being the score.

Defined cases: a null text or one without letters is ``und`` with score 0, as is every text if nothing was learned; equal
proportions go to the first language in alphabetical order; rows with null language or text teach nothing; repeated rows
are predicted each and count each. Further columns are ignored.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from tunemill.llm.common import forget_worker_state, map_lists

BITS = 15
BUCKETS = 1 << BITS
#: Languages that a model may have; beyond, fitting stops with an error (the model is one number per language and bucket).
MAX_LANGUAGES = 200
SMOOTHING = 0.2
STEPS = 25
#: Trigrams overlap, so their log-likelihoods count a third; a further language must gain this times the log of the length.
OVERLAP, PENALTY = 3.0, 2.0
UNKNOWN = "und"
NO_LETTERS = re.compile(r"[\W\d_]+")


def trigrams(text: str | None) -> np.ndarray:
    """Hash buckets of the byte trigrams of the text's words, lower-cased, one space between words; empty without letters."""
    words = NO_LETTERS.sub(" ", (text or "").lower()).strip()
    if not words:
        return np.empty(0, np.uint32)
    b = np.frombuffer(f" {words} ".encode(), np.uint8).astype(np.uint32)
    code = b[:-2] | b[1:-1] << 8 | b[2:] << 16
    return (code * np.uint32(2654435761)) >> np.uint32(32 - BITS)


def held_out(key: str = "doc_id") -> Column:
    return F.crc32(F.col(key).cast("string")) % 3 == 1


def trigram_counts(labelled: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, bucket, n) over all rows; each slice of rows is summed before the shuffle."""
    schema = pa.schema([("lang", pa.string()), ("bucket", pa.int64()), ("n", pa.int64())])

    def make():
        forget_worker_state()

        def count(rows):
            out = {"lang": [], "bucket": [], "n": []}
            for name in dict.fromkeys(rows["lang"]):
                own = [trigrams(t) for t, x in zip(rows["text"], rows["lang"]) if x == name]
                counts = np.bincount(np.concatenate(own), minlength=BUCKETS)
                at = np.flatnonzero(counts)
                out["lang"] += [name] * len(at)
                out["bucket"] += at.tolist()
                out["n"] += counts[at].tolist()
            return out
        return count

    rows = labelled.select(F.col(text).alias("text"), F.col(lang).alias("lang")).where("text IS NOT NULL AND lang IS NOT NULL")
    return map_lists(rows, make, schema).groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


class LanguageModel:
    """Log-probabilities of trigram buckets for each language; small enough to be sent to every task."""

    def __init__(self, languages: list[str], counts: np.ndarray):
        self.languages, self.counts = languages, counts
        smooth = counts + SMOOTHING
        self.share = (smooth / smooth.sum(axis=0, keepdims=True)).astype(np.float32) if languages else counts

    def mixture(self, share: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, float]:
        """Proportions by expectation-maximisation and the log-likelihood they reach."""
        part = np.full(share.shape[1], 1 / share.shape[1])
        if len(part) == 1:
            return part, float(counts @ np.log(share[:, 0]))
        total = counts.sum()
        for _ in range(STEPS):
            new = part * ((counts / (share @ part)) @ share) / total
            done = np.abs(new - part).max() < 1e-4
            part = new
            if done:
                break
        return part, float(counts @ np.log(share @ part))

    def predict(self, text: str | None) -> tuple[str, float]:
        hashed = trigrams(text)
        if not len(hashed) or not self.languages:
            return UNKNOWN, 0.0
        all_counts = np.bincount(hashed, minlength=BUCKETS)
        at = np.flatnonzero(all_counts)
        counts, share = all_counts[at].astype(np.float64), self.share[at].astype(np.float64)
        scale = share.max(axis=1, keepdims=True)
        share = share / scale
        order = np.argsort(-np.round(self.mixture(share, counts)[0], 9), kind="stable")
        kept, best = order[:1], self.mixture(share[:, order[:1]], counts)
        for k in range(2, len(order) + 1):
            further = self.mixture(share[:, order[:k]], counts)
            if (further[1] - best[1]) / OVERLAP <= PENALTY * math.log(counts.sum() + 1):
                break
            kept, best = order[:k], further
        lead = int(np.argmax(np.round(best[0], 9)))
        return self.languages[kept[lead]], float(min(1.0, best[0][lead]))


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang") -> LanguageModel:
    """Learn from all labelled rows. The driver gets one number per language and bucket, never texts."""
    names = [r[0] for r in labelled.select(F.col(lang).alias("lang")).where("lang IS NOT NULL").distinct()
             .limit(MAX_LANGUAGES + 1).collect()]
    if len(names) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    names.sort()
    table = trigram_counts(labelled, text, lang).toPandas()
    counts = np.zeros((BUCKETS, len(names)))
    counts[table["bucket"].to_numpy(int), table["lang"].map({x: i for i, x in enumerate(names)}).to_numpy(int)] = table["n"]
    return LanguageModel(names, counts)


def identify(text: Column, model: LanguageModel) -> Column:
    """struct(lang, score) of each text."""
    shared = SparkSession.active().sparkContext.broadcast((model.languages, model.counts))

    @pandas_udf("lang string, score double")
    def predict(texts):
        forget_worker_state()
        own = LanguageModel(*shared.value)
        return pd.DataFrame([own.predict(t) for t in texts], columns=["lang", "score"])

    return predict(text)


def predicted(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """Prediction for every document by a model of the documents that are not held out."""
    model = fit(docs.where(~F.coalesce(held_out(key), F.lit(False))), text, lang)
    found = identify(F.col(text), model)
    return (docs.select(F.col(key).alias(key), F.coalesce(held_out(key), F.lit(False)).alias("held_out"), found.alias("found"))
            .select(key, "held_out", F.col("found.lang").alias("lang_pred"), F.col("found.score").alias("score")))

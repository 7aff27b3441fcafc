"""From raw documents to packed sequences: language ID, quality rules, near-duplicates, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each result as Parquet in the shared folder
and reads it back as the next stage's documents. All but the last return the columns of the documents, whatever they are.
SQL can express neither the mixture model nor the token ids, so there is no check in SQL; tests compare each stage with a
plain version.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tunemill.llm import languages, packing, quality, simhash
from tunemill.llm.common import written

#: A document stays if its leading language has at least this share of it.
MIN_SHARE = 0.4
GROUPS = ["lang", "source"]
#: Near-duplicates have fingerprints of shingles of four words that differ in at most four of 64 bits.
SHINGLE, RADIUS = 4, 4

#: Words kept in a Python worker while packing, which shares its executor with what earlier stages left in memory.
REMEMBERED = 100_000


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language: ``und`` goes, as do texts in which no language leads."""
    model = languages.fit(docs.where(~F.coalesce(languages.held_out(), F.lit(False))))
    found = languages.identify(F.col("text"), model)
    return docs.where((found["lang"] != languages.UNKNOWN) & (found["score"] >= MIN_SHARE))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents within the thresholds of their language and source."""
    held = docs.select(F.struct(*docs.columns).alias("document"), *GROUPS, "text")
    counted = quality.with_counts(held)
    kept = quality.judged(counted, quality.thresholds(counted, GROUPS), GROUPS).where("kept")
    return kept.select("document.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component: the one with the smallest id, the first of its rows if ids repeat."""
    rows = written(docs.select(F.struct(*docs.columns).alias("document"), F.col("doc_id").alias("id"), "text",
                               F.monotonically_increasing_id().alias("row")), "numbered")
    order = F.struct(F.col("id").isNull().alias("unknown"), "id", "row")
    found = simhash.clustered(rows.select(order.alias("order"), "text"), "order", "text", SHINGLE, radius=RADIUS)
    copies = written(found.where("order <> component_id").select("order.row"), "copies")
    return rows.join(copies, "row", "left_anti").select("document.*")


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 2,048 tokens: one row per piece."""
    return packing.packed(docs, public_tokenizers.path("byte_bpe_50k.json"), remembered=REMEMBERED)


STAGES = [("language ID", language_id), ("quality rules", quality_rules), ("SimHash near-dedup", near_duplicates),
          ("best-fit packing", best_fit_packing)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs

"""Registry of queries and their check SQL, with the shared views."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query; ``sql`` computes the same result from the same tables."""
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded for comparison, counts as 64-bit integers; negative zero becomes zero."""
    out = []
    for f in df.schema:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.round(c.cast("double"), digits) + F.lit(0.0)
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType)):
            c = c.cast("long")
        out.append(c.alias(f.name))
    return df.select(out)


def rd(expr: str, digits: int = 6) -> str:
    """The same rounding in SQL."""
    return f"(round(CAST({expr} AS DOUBLE), {digits}) + 0.0)"


# ---- the table of scored items that stands for the raw music table ----

TRACKS_BODY = """
SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS track_id,
       CAST(l_partkey % 101 AS INT) AS popularity, p_type AS track_genre, p_brand AS album_name, p_name AS track_name,
       concat(p_brand, CASE l_linenumber % 4 WHEN 0 THEN ' feat. ' WHEN 1 THEN ';' WHEN 2 THEN ' & ' ELSE ', ' END,
              p_type) AS artists,
       CAST(floor(l_extendedprice) AS BIGINT) * 10 AS duration_ms, l_returnflag = 'R' AS explicit,
       (l_quantity - 1) / 49 AS danceability, l_discount * 10 AS energy, l_tax * 12.5 AS valence,
       (l_quantity % 7) / 6 AS acousticness, (p_size - 1) / CAST(49 AS DOUBLE) AS instrumentalness,
       -60 + l_quantity AS loudness, 50 + l_quantity * 5.5 AS tempo, CAST(l_linenumber % 12 AS INT) AS key,
       CAST(l_suppkey % 2 AS INT) AS mode, CAST(3 + l_linenumber % 3 AS INT) AS time_signature,
       l_shipdate AS release_date{extra}
FROM lineitem JOIN part ON l_partkey = p_partkey
"""
PREDS_EXTRA = """,
       l_orderkey, l_quantity, 20 + 0.5 * CAST(l_partkey % 101 AS DOUBLE) + 10 * (l_discount * 10) - 5 * (l_tax * 12.5)
           AS prediction,
       CASE WHEN l_orderkey % 20 < 3 THEN 'test' WHEN l_orderkey % 20 < 6 THEN 'val' ELSE 'train' END AS split,
       l_quantity % 15 AS pred_std"""
FEATURE_KEY = ["danceability", "energy", "valence"]
TRACK_FEATURES = ["danceability", "energy", "valence", "acousticness", "instrumentalness", "loudness", "tempo"]

TRACKS_SQL = f"tracks AS ({TRACKS_BODY.format(extra='')})"
PREDS_SQL = f"preds AS ({TRACKS_BODY.format(extra=PREDS_EXTRA)})"
CLEAN_SQL = f"""{TRACKS_SQL}, clean AS (
SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY danceability, energy, valence ORDER BY popularity DESC, track_id) AS rn
    FROM tracks) WHERE rn = 1 AND popularity > 0)"""


def with_tracks(sql: str) -> str:
    return f"WITH {TRACKS_SQL}{sql if sql.lstrip().startswith(',') else ' ' + sql}"


def with_clean(sql: str) -> str:
    return f"WITH {CLEAN_SQL}{sql if sql.lstrip().startswith(',') else ' ' + sql}"


def with_preds(sql: str) -> str:
    return f"WITH {PREDS_SQL}{sql if sql.lstrip().startswith(',') else ' ' + sql}"


def _joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))


def _track_columns() -> list:
    separator = (F.when(F.col("l_linenumber") % 4 == 0, " feat. ").when(F.col("l_linenumber") % 4 == 1, ";")
                 .when(F.col("l_linenumber") % 4 == 2, " & ").otherwise(", "))
    return [
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("track_id"),
        (F.col("l_partkey") % 101).cast("int").alias("popularity"),
        F.col("p_type").alias("track_genre"), F.col("p_brand").alias("album_name"), F.col("p_name").alias("track_name"),
        F.concat("p_brand", separator, "p_type").alias("artists"),
        (F.floor("l_extendedprice").cast("long") * 10).alias("duration_ms"),
        (F.col("l_returnflag") == "R").alias("explicit"),
        ((F.col("l_quantity") - 1) / 49).alias("danceability"), (F.col("l_discount") * 10).alias("energy"),
        (F.col("l_tax") * 12.5).alias("valence"), ((F.col("l_quantity") % 7) / 6).alias("acousticness"),
        ((F.col("p_size") - 1) / F.lit(49.0)).alias("instrumentalness"),
        (F.lit(-60) + F.col("l_quantity")).alias("loudness"), (F.lit(50) + F.col("l_quantity") * 5.5).alias("tempo"),
        (F.col("l_linenumber") % 12).cast("int").alias("key"), (F.col("l_suppkey") % 2).cast("int").alias("mode"),
        (F.lit(3) + F.col("l_linenumber") % 3).cast("int").alias("time_signature"),
        F.col("l_shipdate").alias("release_date"),
    ]


def tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _joined(spark, sf_dir).select(_track_columns())


def preds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tracks with a fixed stand-in for a model's prediction, a split and an uncertainty."""
    bucket = F.col("l_orderkey") % 20
    prediction = (F.lit(20) + 0.5 * (F.col("l_partkey") % 101).cast("double") + 10 * (F.col("l_discount") * 10)
                  - 5 * (F.col("l_tax") * 12.5))
    return _joined(spark, sf_dir).select(
        *_track_columns(), "l_orderkey", "l_quantity", prediction.alias("prediction"),
        F.when(bucket < 3, "test").when(bucket < 6, "val").otherwise("train").alias("split"),
        (F.col("l_quantity") % 15).alias("pred_std"))

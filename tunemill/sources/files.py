"""CSV, Parquet and JSON files."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tunemill.operators.clean import complete_rows
from tunemill.operators.columns import available
from tunemill.presets import MISSING_TOKENS


def tokens_to_null(df: DataFrame) -> DataFrame:
    """Texts that stand for a missing value become null."""
    texts = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: F.when(~F.col(c).isin(MISSING_TOKENS), F.col(c)) for c in texts}) if texts else df


def _typed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast text columns after missing tokens are gone; what cannot be cast becomes null (see :func:`rejected_cells`)."""
    return df.select([F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in schema])


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None,
             encodings: tuple[str, ...] = ("UTF-8",), multi_line: bool = True) -> DataFrame:
    """CSV with a header and doubled quotes. Types come from ``schema``, or are inferred when it is absent.

    Quoted line breaks need ``multi_line``, with which one task reads a whole file; without such texts pass False, so
    that Spark can split large files.

    With several encodings the next one is used as soon as a decoded text holds a replacement character.
    """
    clean = tokens_to_null(_texts(spark, path, schema, encodings, multi_line))
    return _typed(clean, schema) if schema is not None else clean


def rejected_cells(spark: SparkSession, path: str, schema: T.StructType, encodings: tuple[str, ...] = ("UTF-8",),
                   multi_line: bool = True) -> DataFrame:
    """(column, rejected): cells per column that hold a text :func:`read_csv` cannot cast and turns into null."""
    clean = tokens_to_null(_texts(spark, path, schema, encodings, multi_line))
    counts = clean.agg(*[F.count_if(F.col(f"`{f.name}`").isNotNull() & F.col(f"`{f.name}`").try_cast(f.dataType).isNull())
                         .alias(f.name) for f in schema])
    return counts.unpivot([], [f"`{f.name}`" for f in schema], "column", "rejected")


def _texts(spark: SparkSession, path: str, schema: T.StructType | None, encodings: tuple[str, ...], multi_line: bool) -> DataFrame:
    """The file as text columns, or with inferred types if there is no schema."""
    def load(encoding: str) -> DataFrame:
        reader = (spark.read.option("header", True).option("quote", '"').option("escape", '"')
                  .option("multiLine", multi_line).option("encoding", encoding))
        if schema is None:
            return reader.option("inferSchema", True).csv(path)
        return reader.schema(T.StructType([T.StructField(f.name, T.StringType()) for f in schema])).csv(path)

    for position, encoding in enumerate(encodings):
        raw = load(encoding)
        if position + 1 == len(encodings) or not _garbled(raw):
            break
    return raw


def _garbled(df: DataFrame) -> bool:
    texts = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    bad: Column = F.lit(False)
    for c in texts:
        bad = bad | F.coalesce(F.contains(F.col(f"`{c}`"), F.lit("�")), F.lit(False))
    return bool(df.where(bad).limit(1).collect())


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def load_features(df: DataFrame, cols: list[str], target: str) -> DataFrame:
    """Feature columns present plus the target, without incomplete rows."""
    wanted = [*available(df, cols), target]
    return complete_rows(df.select(*wanted), wanted)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", True).option("quote", '"').option("escape", '"').csv(path)


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None, mode: str = "overwrite") -> None:
    writer = df.write.mode(mode).option("compression", "snappy")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_split(df: DataFrame, path: str) -> None:
    """One dataset with a directory per split; a reader of one split skips the others."""
    write_parquet(df, path, ["split"])


def load_split(spark: SparkSession, path: str, name: str) -> DataFrame:
    return spark.read.parquet(path).where(F.col("split") == name).drop("split")


def convert(spark: SparkSession, source: str, target: str) -> None:
    """Parquet to CSV."""
    write_csv(read_parquet(spark, source), target)


def load_params(spark: SparkSession, path: str) -> dict:
    """Parameters from a small JSON file."""
    row = spark.read.option("multiLine", True).json(path).first()
    return row.asDict(recursive=True) if row else {}


def write_json(spark: SparkSession, document: dict, path: str, mode: str = "append") -> None:
    """Append a small document (parameters, metrics, a verification report) as one JSON line."""
    line = spark.createDataFrame([(json.dumps(document, sort_keys=True, default=str),)], "value string")
    line.coalesce(1).write.mode(mode).text(path)


def write_report(report: DataFrame, path: str) -> None:
    """A (section, item, value) table as text lines."""
    line = F.concat_ws(": ", F.concat(F.lit("["), "section", F.lit("] "), "item"), "value")
    report.select(line.alias("value")).write.mode("overwrite").text(path)

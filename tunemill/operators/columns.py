"""Column discovery, selection and alignment."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tunemill.presets import DEFAULT_YEAR


def resolve_column(df: DataFrame, candidates: list[str], default: str | None = None) -> str | None:
    """First column, in table order, whose lower-case name is among the candidates."""
    wanted = set(candidates)
    return next((c for c in df.columns if c.lower() in wanted), default)


def numeric_cols(df: DataFrame) -> list[str]:
    """Numeric columns; booleans are not numeric."""
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def string_cols(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]


def available(df: DataFrame, cols: list[str]) -> list[str]:
    present = set(df.columns)
    return [c for c in cols if c in present]


def drop_cols(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.drop(*available(df, cols))


def align_to(df: DataFrame, cols: list[str], defaults: dict | None = None) -> DataFrame:
    """Exactly ``cols`` in order; absent ones are filled with their default (year, else 0)."""
    fill = {"release_year": DEFAULT_YEAR, **(defaults or {})}
    return df.select([F.col(f"`{c}`") if c in df.columns else F.lit(fill.get(c, 0)).alias(c) for c in cols])


def snake_names(df: DataFrame) -> DataFrame:
    """Column names in lower case with underscores."""
    def snake(name: str) -> str:
        spaced = re.sub(r"(?<=[a-z0-9])(?=[A-Z])", "_", name.strip())
        return re.sub(r"[^0-9a-z]+", "_", spaced.lower()).strip("_")
    return df.toDF(*[snake(c) for c in df.columns])


def column_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Columns of one table that the other lacks, with their values that are not null: (side, column, filled)."""
    def lacking(side: str, own: DataFrame, other: DataFrame) -> DataFrame:
        pairs = [F.struct(F.lit(side).alias("side"), F.lit(c).alias("column"), F.count(f"`{c}`").alias("filled"))
                 for c in own.columns if c not in other.columns]
        found = F.array(*pairs).cast("array<struct<side:string,column:string,filled:bigint>>")
        return own.agg(found.alias("found")).select(F.inline("found"))

    return lacking("missing", a, b).unionByName(lacking("extra", b, a))


def check_same_columns(a: DataFrame, b: DataFrame) -> None:
    """Raise unless both tables have the same columns in the same order."""
    if a.columns != b.columns:
        missing = [c for c in a.columns if c not in b.columns]
        extra = [c for c in b.columns if c not in a.columns]
        raise ValueError(f"columns differ: missing {missing}, extra {extra}, order {a.columns} / {b.columns}")

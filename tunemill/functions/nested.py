"""JSON paths, map lookups and serialised parameters."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def json_first(text: Column, paths: list[str], dtype: str, default=None) -> Column:
    """First JSON path with a value, cast to ``dtype``; the default where none has one."""
    found = [F.get_json_object(text, path).try_cast(dtype) for path in paths]
    return F.coalesce(*found, F.lit(default).cast(dtype))


def lookup(key: Column, table: dict, default=None) -> Column:
    """Value of a small fixed map, with a default."""
    pairs = [F.lit(item) for pair in table.items() for item in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), key), F.lit(default))


def json_text(col: Column) -> Column:
    """Structs, maps and arrays as JSON text."""
    return F.to_json(col)

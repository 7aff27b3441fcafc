"""Helpers of this subpackage: Arrow batches as lists, shared files, state of a Python worker."""

from __future__ import annotations

import ctypes
import sys
import types
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

from tunemill.session import scratch_path

_SPARK_NAMES = {pa.int64(): "long", pa.int32(): "int", pa.string(): "string", pa.binary(): "binary",
                pa.bool_(): "boolean", pa.float64(): "double"}
#: Rows that are Python objects at the same time in one task.
SLICE_ROWS = 2_000


def ddl(schema: pa.Schema) -> str:
    return ", ".join(f"`{f.name}` {_SPARK_NAMES[f.type]}" for f in schema)


def map_lists(df: DataFrame, make: Callable[[], Callable[[dict], dict]], schema: pa.Schema,
              slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Each slice of rows as ``{column: list}`` through the function that ``make`` builds once per task.

    The function returns ``{column: list}`` for ``schema``, with any number of rows.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_memory()
        fn = make()
        for batch in batches:
            for at in range(0, batch.num_rows, slice_rows):
                out = fn(batch.slice(at, slice_rows).to_pydict())
                yield pa.RecordBatch.from_pydict(out, schema=schema)

    return df.mapInArrow(run, ddl(schema))


def release_memory() -> None:
    """Gives back what earlier tasks freed in this Python worker, from Arrow's pool and, where it can trim, the C heap."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder, read back: cuts lineage, and lost executors cost no earlier step."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def filesystem(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a shared path (local, HDFS, object store) and the path in it."""
    if ":/" not in uri:
        return fs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(uri)


def worker_state(name: str, make: Callable[[], object]):
    """A value kept for the life of the Python worker, such as a loaded vocabulary and its word cache.

    Functions of this package travel by value, so their own globals are new in every task.
    """
    home = sys.modules.setdefault("tunemill_worker_state", types.ModuleType("tunemill_worker_state"))
    if not hasattr(home, name):
        setattr(home, name, make())
    return getattr(home, name)


def forget_worker_state() -> None:
    """Frees what earlier stages kept in this Python worker; called by operators that keep nothing themselves."""
    home = sys.modules.get("tunemill_worker_state")
    kept = [n for n in vars(home) if not n.startswith("__")] if home else []
    for name in kept:
        delattr(home, name)
    if kept:
        release_memory()

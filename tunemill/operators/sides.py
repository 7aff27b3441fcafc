"""Join sides whose size has been checked."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_BROADCAST_ROWS = 100_000


def checked(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Broadcast ``df`` if its rows, counted here, stay within the bound, so that the other side is not shuffled.

    A larger side is returned as it is: the join then shuffles both sides and adaptive execution splits hot keys.
    """
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df

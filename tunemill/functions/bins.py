"""Binning expressions with explicit edge closure."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def cut(col: Column, edges: Sequence[float], labels: Sequence, right: bool = True,
        include_lowest: bool = False) -> Column:
    """Label of the bin that holds ``col``; null outside the edges and for null or NaN.

    ``right=True`` closes bins on the right, and ``include_lowest`` also admits the leftmost edge.
    """
    if len(labels) != len(edges) - 1:
        raise ValueError("one label per bin is needed")
    below = col <= edges[0] if right and not include_lowest else col < edges[0]
    label = F.when(col.isNull() | below, F.lit(None))
    for upper, name in zip(edges[1:], labels):
        label = label.when(col <= upper if right else col < upper, F.lit(name))
    return label


def cut_ordinal(col: Column, edges: Sequence[float], right: bool = True, include_lowest: bool = False) -> Column:
    """Zero-based number of the bin, in edge order."""
    return cut(col, edges, range(len(edges) - 1), right, include_lowest).cast("int")


def fixed_width_bin(col: Column, low: float, high: float, bins: int) -> Column:
    """Zero-based bin of equal width; the last bin is closed on both sides, null outside."""
    if high == low:
        return F.when(col == low, F.lit(0))
    width = (high - low) / bins
    slot = F.floor((col - F.lit(low)) / F.lit(width)).cast("int")
    return F.when((col >= low) & (col <= high), F.least(slot, F.lit(bins - 1)))

"""Names inside delimited lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tunemill.presets import ARTIST_SEPARATORS

WHITESPACE = " \t\n\r\x0b\x0c"


def members_of(text: Column, separators: Sequence[str] = tuple(ARTIST_SEPARATORS)) -> Column:
    """Trimmed parts of a list; separators are literal, case-sensitive and applied in order."""
    for separator in separators:
        if separator != ",":
            text = F.replace(text, F.lit(separator), F.lit(","))
    return F.transform(F.split(text, ","), lambda part: F.trim(part, F.lit(WHITESPACE)))


def primary_of(text: Column, separators: Sequence[str] = tuple(ARTIST_SEPARATORS)) -> Column:
    """First part of a list."""
    return F.get(members_of(text, separators), F.lit(0))

"""Scalar expressions: clipping, moods, flags, dates and small text helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tunemill.presets import CALM_MOOD, MOODS


def clip(col: Column, low: float, high: float) -> Column:
    """Bound ``col``; null stays null."""
    return F.when(col.isNotNull(), F.least(F.greatest(col, F.lit(low)), F.lit(high)))


def minutes(ms: Column) -> Column:
    return ms / F.lit(60000)


def year_of(text: Column) -> Column:
    """Year of a date string; null where it does not parse."""
    return F.year(F.try_to_timestamp(text))


def mood_quadrant(valence: Column, energy: Column, cut: float = 0.5, clamp: bool = True) -> Column:
    """Mood label from the side of ``cut`` on which valence and energy lie; null if either is null."""
    v = clip(valence, 0.0, 1.0) if clamp else valence
    e = clip(energy, 0.0, 1.0) if clamp else energy
    label = F.when(v.isNull() | e.isNull(), F.lit(None))
    for (happy, energetic), name in MOODS.items():
        label = label.when((v > cut if happy else v <= cut) & (e > cut if energetic else e <= cut), name)
    return label


def mood_three_way(valence: Column, energy: Column, cut: float = 0.5) -> Column:
    """Mood with all low-energy items under one label."""
    return F.when(energy <= cut, F.lit(CALM_MOOD)).otherwise(mood_quadrant(valence, energy, cut, clamp=False))


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it does not or is unknown."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def capitalise(text: Column) -> Column:
    return F.concat(F.upper(F.substring(text, 1, 1)), F.lower(F.substr(text, F.lit(2))))


def strip_prefix(text: Column, prefix: str) -> Column:
    return F.when(text.startswith(prefix), F.substr(text, F.lit(len(prefix) + 1))).otherwise(text)


def percent_text(share: Column, decimals: int = 1) -> Column:
    return F.concat(F.format_number(share * 100, decimals), F.lit("%"))


def file_stamp(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMMdd_HHmmss")


def harmonic_mean(a: Column, b: Column) -> Column:
    return F.try_divide(2 * a * b, a + b)


def stable_hash(col: Column, mod: int = 100) -> Column:
    """A repeatable value in [0, 1) for a category."""
    return F.pmod(F.xxhash64(col), F.lit(mod)) / F.lit(float(mod))


def finite(col: Column) -> Column:
    return col.isNotNull() & ~F.isnan(col) & (F.abs(col) < F.lit(float("inf")))


def correlation(x: Column, y: Column) -> Column:
    """Pearson correlation over rows where both are present; null where either is constant."""
    xs, ys = F.when(y.isNotNull(), x), F.when(x.isNotNull(), y)
    return F.try_divide(F.covar_pop(xs, ys), F.stddev_pop(xs) * F.stddev_pop(ys))

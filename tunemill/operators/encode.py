"""Derived columns and encodings of the model matrix."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tunemill.functions.bins import cut
from tunemill.functions.scalars import (
    flag, minutes, mood_quadrant, mood_three_way, stable_hash, year_of,
)
from tunemill.operators.columns import available
from tunemill.operators.ranks import global_index
from tunemill.operators.sides import checked
from tunemill.presets import (
    ENERGY_BINS, ONE_HOT_LEVELS, POPULARITY_BINS, SCALED_FEATURES, SERVING_ENERGY_BINS, SERVING_ENERGY_BINS_WIDE,
    SERVING_TEMPO_BINS, TEMPO_BINS, UNKNOWN_MOOD,
)

MAX_LEVELS = 1000


def with_duration_min(df: DataFrame) -> DataFrame:
    return df.withColumn("duration_min", minutes(F.col("duration_ms"))) if "duration_ms" in df.columns else df


def with_year(df: DataFrame, col: str, name: str = "release_year") -> DataFrame:
    return df.withColumn(name, year_of(F.col(col).cast("string")))


def with_mood(df: DataFrame, cut_at: float = 0.5, clamp: bool = True) -> DataFrame:
    """``mood_energy``; "Unknown" where the table lacks valence or energy."""
    if not {"valence", "energy"} <= set(df.columns):
        return df.withColumn("mood_energy", F.lit(UNKNOWN_MOOD))
    return df.withColumn("mood_energy", mood_quadrant(F.col("valence"), F.col("energy"), cut_at, clamp))


def with_categories(df: DataFrame) -> DataFrame:
    """Energy, popularity and tempo labels for the columns present."""
    bins = {"energy": ENERGY_BINS, "popularity": POPULARITY_BINS, "tempo": TEMPO_BINS}
    return df.withColumns({
        f"{c}_category": cut(F.col(c), *spec, include_lowest=True) for c, spec in bins.items() if c in df.columns})


def derive(df: DataFrame) -> DataFrame:
    """The five columns that cleaning adds."""
    df = with_duration_min(df)
    if {"valence", "energy"} <= set(df.columns):
        df = with_mood(df)
    return with_categories(df)


def with_serving_categories(df: DataFrame, wide: bool = False) -> DataFrame:
    """Left-closed labels and the mood as the scoring forms compute them (``wide``: 0.67 edge, three moods)."""
    energy, valence = F.col("energy"), F.col("valence")
    return df.withColumns({
        "energy_category": cut(energy, *(SERVING_ENERGY_BINS_WIDE if wide else SERVING_ENERGY_BINS), right=False),
        "tempo_category": cut(F.col("tempo"), *SERVING_TEMPO_BINS, right=False),
        "mood_energy": mood_three_way(valence, energy) if wide else mood_quadrant(valence, energy, clamp=False),
    })


def interactions(df: DataFrame, pairs: list[tuple[str, str]] | None = None) -> DataFrame:
    pairs = pairs or [("energy", "danceability"), ("valence", "energy"), ("acousticness", "energy")]
    return df.withColumns({f"{a}_{b}": F.col(a) * F.col(b) for a, b in pairs})


def squares(df: DataFrame, cols: tuple[str, ...] = ("energy", "danceability", "valence")) -> DataFrame:
    return df.withColumns({f"{c}_squared": F.col(c) * F.col(c) for c in cols})


def flags(df: DataFrame) -> DataFrame:
    energy, valence, length = F.col("energy"), F.col("valence"), F.col("duration_min")
    return df.withColumns({
        "is_short_track": flag(length < 3),
        "is_long_track": flag(length > 5),
        "high_energy_happy": flag((energy > 0.7) & (valence > 0.7)),
        "low_energy_sad": flag((energy < 0.3) & (valence < 0.3)),
    })


def levels_of(df: DataFrame, col: str, limit: int = MAX_LEVELS) -> list:
    """Sorted distinct values of a low-cardinality column; raises beyond the limit."""
    rows = df.select(col).where(F.col(col).isNotNull()).distinct().limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"{col} has more than {limit} levels and cannot be one-hot encoded")
    return sorted(r[0] for r in rows)


def levels_of_all(df: DataFrame, cols: list[str], limit: int = MAX_LEVELS) -> dict[str, list]:
    """Sorted distinct values of several low-cardinality columns in one pass."""
    if not cols:
        return {}
    long = df.select([F.col(c).cast("string").alias(c) for c in cols]).unpivot([], cols, "feature", "value")
    rows = long.where(F.col("value").isNotNull()).distinct().limit(limit * len(cols) + 1).collect()
    found: dict[str, list] = {c: [] for c in cols}
    for r in rows:
        found[r.feature].append(r.value)
    for c, values in found.items():
        if len(values) > limit:
            raise ValueError(f"{c} has more than {limit} levels and cannot be encoded by level")
        if isinstance(df.schema[c].dataType, T.IntegralType):
            found[c] = [int(v) for v in values]
    return {c: sorted(values) for c, values in found.items()}


def one_hot(df: DataFrame, col: str, levels: list | None = None, drop_first: bool = True) -> DataFrame:
    """One 0/1 column per level, without the first level in order; null gives all zeros."""
    levels = levels_of(df, col) if levels is None else list(levels)
    kept = levels[1:] if drop_first else levels
    return df.withColumns({f"{col}_{level}": flag(F.col(col) == F.lit(level)) for level in kept}).drop(col)


def level_codes(df: DataFrame, col: str, inline_limit: int = MAX_LEVELS) -> dict | DataFrame:
    """Number of each value among the sorted distinct values, for any number of values.

    Few levels are a map; more are numbered by a distributed sort and stay a table of ``col`` and ``code``.
    """
    distinct = df.select(col).where(F.col(col).isNotNull()).distinct()
    head = distinct.limit(inline_limit + 1).collect()
    if len(head) <= inline_limit:
        return {v: i for i, v in enumerate(sorted(r[0] for r in head))}
    return global_index(distinct, [col], "code")


def with_codes(df: DataFrame, col: str, codes: dict | DataFrame, name: str) -> DataFrame:
    """``df`` with the code of each value as last column; null where the value has none."""
    if isinstance(codes, DataFrame):
        coded = df.drop(name).join(checked(codes.select(col, F.col("code").alias(name))), col, "left")
    elif codes:
        pairs = [item for v, i in codes.items() for item in (F.lit(v), F.lit(i).cast("long"))]
        coded = df.withColumn(name, F.try_element_at(F.create_map(*pairs), F.col(col)))
    else:
        coded = df.withColumn(name, F.lit(None).cast("long"))
    return coded.select(*[c for c in df.columns if c != name], name)


def label_encode(df: DataFrame, col: str, name: str | None = None, inline_limit: int = MAX_LEVELS) -> DataFrame:
    """Number of each value among the sorted distinct values."""
    return with_codes(df, col, level_codes(df, col, inline_limit), name or f"{col}_encoded")


def hash_encode(df: DataFrame, col: str, mod: int = 100, name: str | None = None) -> DataFrame:
    return df.withColumn(name or f"{col}_encoded", stable_hash(F.col(col), mod))


def fit_scaler(df: DataFrame, cols: list[str]) -> dict[str, tuple[float, float]]:
    """Mean and divisor per column in one job; the divisor is the population deviation, or 1 when that is 0."""
    stats = [f(c).alias(f"{tag}_{i}") for i, c in enumerate(cols)
             for tag, f in (("m", F.avg), ("s", F.stddev_pop))]
    row = df.agg(*stats).first()
    return {c: (row[f"m_{i}"], row[f"s_{i}"] or 1.0) for i, c in enumerate(cols)}


def scaled(col: Column, mean: float | None, divisor: float) -> Column:
    return F.lit(None).cast("double") if mean is None else (col - F.lit(mean)) / F.lit(divisor)


def apply_scaler(df: DataFrame, scaler: dict[str, tuple[float, float]]) -> DataFrame:
    return df.withColumns({c: scaled(F.col(c), *fit) for c, fit in scaler.items()})


def featurize(df: DataFrame, levels: dict | None = None, genre_codes: dict | DataFrame | None = None) -> DataFrame:
    """Model features of any table of tracks; the same code serves batch tables and single requests.

    ``levels`` and ``genre_codes`` come from :func:`fit_features`, so that a request row gets the columns of the
    training table whatever values it holds. A genre without a code gets 0.
    """
    df = flags(squares(interactions(df)))
    if "explicit" in df.columns:
        df = df.withColumn("explicit", F.col("explicit").cast("int"))
    for col, fixed in ONE_HOT_LEVELS.items():
        if col in df.columns:
            df = one_hot(df, col, (levels or {}).get(col, fixed))
    if "track_genre" in df.columns:
        if genre_codes is None:
            df = label_encode(df, "track_genre")
        else:
            df = with_codes(df, "track_genre", genre_codes, "track_genre_encoded").withColumn(
                "track_genre_encoded", F.coalesce("track_genre_encoded", F.lit(0).cast("long")))
        df = df.drop("track_genre")
    return df


def fit_features(df: DataFrame) -> tuple[dict, dict | DataFrame]:
    """Levels of the one-hot columns and codes of the genres, however many, from the training rows."""
    levels = {c: fixed for c, fixed in ONE_HOT_LEVELS.items() if c in df.columns}
    open_ended = [c for c, fixed in levels.items() if fixed is None]
    found = levels_of_all(df, open_ended)
    codes = level_codes(df, "track_genre") if "track_genre" in df.columns else {}
    return levels | {c: found[c] for c in open_ended}, codes


def model_matrix(df: DataFrame, fit_on: DataFrame | None = None) -> DataFrame:
    """Encoded and scaled table; all statistics are fitted on ``fit_on`` (the training rows) when given."""
    source = df if fit_on is None else fit_on
    levels, codes = fit_features(source)
    encoded = featurize(df, levels, codes)
    fitted = encoded if fit_on is None else featurize(fit_on, levels, codes)
    return apply_scaler(encoded, fit_scaler(fitted, available(fitted, SCALED_FEATURES)))

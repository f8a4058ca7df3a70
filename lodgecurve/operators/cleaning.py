"""Cleaning: names, types, ranges, missing values and column selection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodgecurve.functions import values as V
from lodgecurve.schemas import BINARY_COLS, CLIP_RANGES, DOUBLE_COLS, FLAG_COLS, INT_COLS


def snake_case_columns(df: DataFrame) -> DataFrame:
    names = [V.snake_name(c) for c in df.columns]
    if len(set(names)) < len(names):
        raise ValueError(f"column names collide in snake case: {sorted(n for n in names if names.count(n) > 1)}")
    return df.toDF(*names)


def _update(df: DataFrame, exprs: dict[str, Column]) -> DataFrame:
    """Replace the columns that exist, in one projection."""
    return df.withColumns({c: e for c, e in exprs.items() if c in df.columns})


def to_doubles(df: DataFrame, columns: list[str] = DOUBLE_COLS) -> DataFrame:
    """Doubles where the value reads as one, NULL elsewhere; absent columns are skipped."""
    return _update(df, {c: F.col(c).try_cast("double") for c in columns})


def to_flags(df: DataFrame, columns: list[str] = FLAG_COLS) -> DataFrame:
    return _update(df, {c: V.flag(F.col(c)) for c in columns})


def to_ints(df: DataFrame, columns: list[str] = INT_COLS) -> DataFrame:
    """Integers; yes/no words count as 1/0 when the column is text."""
    texts = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    number = {c: F.col(c).try_cast("int") for c in columns}
    return _update(df, {c: F.coalesce(e, V.flag(F.col(c))) if c in texts else e for c, e in number.items()})


def booleans_to_ints(df: DataFrame) -> DataFrame:
    found = [f.name for f in df.schema.fields if isinstance(f.dataType, T.BooleanType)]
    return df.withColumns({c: F.col(c).cast("int") for c in found})


def clean_listings(df: DataFrame) -> DataFrame:
    """Names in snake case, numbers as doubles, flags as 0/1."""
    return to_ints(to_flags(to_doubles(snake_case_columns(df))))


def clip_ranges(df: DataFrame, ranges: dict[str, tuple] = CLIP_RANGES) -> DataFrame:
    return _update(df, {c: V.clip(F.col(c), lo, hi) for c, (lo, hi) in ranges.items()})


def clip_to_column(df: DataFrame, column: str = "days_booked", bound: str = "days_in_period") -> DataFrame:
    """Bound ``column`` to [0, ``bound``]."""
    return df.withColumn(column, V.clip(F.col(column), 0, F.col(bound)))


def clip_binary(df: DataFrame, columns: list[str] = BINARY_COLS) -> DataFrame:
    return _update(df, {c: V.clip(F.col(c), 0, 1) for c in columns})


def clip_listings(df: DataFrame) -> DataFrame:
    """All range rules: constants first, then booked days to the clipped period, then flags."""
    out = clip_ranges(df)
    if {"days_booked", "days_in_period"} <= set(out.columns):
        out = clip_to_column(out)
    return clip_binary(out)


def safe_floats(df: DataFrame, columns: list[str], default: float = 0.0) -> DataFrame:
    return _update(df, {c: V.finite_or(F.col(c), default) for c in columns})


def fill_missing(df: DataFrame, columns: list[str], value: float = 0.0) -> DataFrame:
    """Replace NULL and NaN."""
    return df.na.fill(value, subset=columns)


def labelled(df: DataFrame, target: str = "occupancy_rate") -> DataFrame:
    """Add ``label`` and keep the rows that have one."""
    return df.withColumn("label", F.col(target).cast("double")).where(F.col("label").isNotNull())


def in_market(df: DataFrame, city: str, season: str | None = None, weekend: int | None = None) -> DataFrame:
    """Rows of one market, or of one of its segments."""
    keep = F.col("city") == city
    if season is not None:
        keep &= F.col("season") == season
    if weekend is not None:
        keep &= F.col("weekend") == weekend
    return df.where(keep)


def drop_present(df: DataFrame, *columns: str) -> DataFrame:
    return df.drop(*[c for c in columns if c in df.columns])


def select_present(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*[c for c in columns if c in df.columns])

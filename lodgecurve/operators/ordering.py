"""Orders and top lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodgecurve.schemas import SEASONS_ASCENDING


def season_rank(season: Column) -> Column:
    """0 for the high season, then shoulder and low; other names sort last."""
    found = F.array_position(F.array(*[F.lit(s) for s in reversed(SEASONS_ASCENDING)]), season)
    return F.when(found > 0, found.cast("int") - 1).otherwise(F.lit(len(SEASONS_ASCENDING)))


def by_season(df: DataFrame, *first: str) -> DataFrame:
    """Order by the given columns, then high to low season, weekdays before weekends."""
    return df.orderBy(*first, season_rank(F.col("season")), "weekend")


def top(df: DataFrame, k: int, by: str, *ties: str) -> DataFrame:
    """The ``k`` rows with the greatest values."""
    return df.orderBy(F.col(by).desc(), *ties).limit(k)

"""Schemas, column roles and the fixed values every operator shares."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# --- Fixed values: column names, ranges and labels that results depend on. -------------

SEGMENT_COLS = ["city", "season", "weekend"]

# From the season with the lowest prices to the one with the highest.
SEASONS_ASCENDING = ["low", "shoulder", "high"]

# Numeric ranges a listing is clipped to.
CLIP_RANGES = {
    "listing_price": (10, 10000),
    "person_capacity": (1, 20),
    "bedrooms": (0, 15),
    "cleanliness_rating": (0, 10),
    "guest_satisfaction_overall": (0, 100),
    "city_center_dist": (0, 50),
    "metro_dist": (0, 50),
    "days_in_period": (0, 365),
    "occupancy_rate": (0, 1),
}
BINARY_COLS = ["host_is_superhost", "multi", "biz", "weekend"]

# Columns read as doubles, as yes/no flags and as 0/1 integers.
DOUBLE_COLS = [
    "listing_price",
    "person_capacity",
    "cleanliness_rating",
    "guest_satisfaction_overall",
    "city_center_dist",
    "metro_dist",
    "bedrooms",
    "days_in_period",
    "days_booked",
    "occupancy_rate",
]
FLAG_COLS = ["host_is_superhost", "weekend"]
INT_COLS = ["multi", "biz"]
TRUE_WORDS = ["true", "1", "t", "yes", "y"]
FALSE_WORDS = ["false", "0", "f", "no", "n"]

# Model inputs, in training order.
NUMERIC_FEATURES = [
    "listing_price",
    "person_capacity",
    "cleanliness_rating",
    "guest_satisfaction_overall",
    "bedrooms",
    "city_center_dist",
    "metro_dist",
    "log_price",
    "price_per_person",
    "price_per_bedroom",
    "quality_score",
    "price_x_satisfaction",
    "price_per_dist_km",
    "log_metro_dist",
    "segment_avg_price",
    "segment_median_price",
    "segment_p90_price",
    "segment_p10_price",
    "segment_price_std",
    "segment_price_spread",
    "price_vs_segment_median",
    "price_vs_segment_avg",
    "relative_price_volatility",
    "elasticity_slope",
]

# Days of a season used where a segment has no observed days, and the weekday/weekend shares.
FALLBACK_SEASON_DAYS = {"high": 120.0, "shoulder": 150.0, "low": 95.0}
WEEKDAY_SHARE = 5.0 / 7.0
WEEKEND_SHARE = 2.0 / 7.0

# --- Schemas ---------------------------------------------------------------------------

ELASTICITY_SCHEMA = T.StructType(
    [
        T.StructField("city", T.StringType(), False),
        T.StructField("season", T.StringType(), False),
        T.StructField("weekend", T.IntegerType(), False),
        T.StructField("price_regime", T.StringType(), False),
        T.StructField("elasticity_slope", T.DoubleType(), False),
        T.StructField("breakpoint_log_price", T.DoubleType(), True),
    ]
)

ELASTICITY_DOCUMENT_SCHEMA = T.MapType(
    T.StringType(),
    T.StructType(
        [
            T.StructField("breakpoint_log_price", T.DoubleType()),
            T.StructField("regimes", T.ArrayType(T.StructType([T.StructField("slope", T.DoubleType())]))),
        ]
    ),
)

# --- Column roles ----------------------------------------------------------------------


def require_columns(df: DataFrame, names: Iterable[str]) -> None:
    """Raise when any of ``names`` is missing, listing all that are."""
    absent = sorted(set(names) - set(df.columns))
    if absent:
        raise ValueError(f"missing required columns: {', '.join(absent)}")


def first_present(df: DataFrame, *names: str) -> str | None:
    """The first of ``names`` that ``df`` has, or None."""
    return next((n for n in names if n in df.columns), None)


def price_column(df: DataFrame) -> str:
    name = first_present(df, "listing_price", "realsum")
    if name is None:
        raise ValueError("no price column: expected listing_price or realsum")
    return name


def distance_column(df: DataFrame) -> str | None:
    return first_present(df, "city_center_dist", "metro_dist")


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def segment_columns(df: DataFrame) -> list[str]:
    return [c for c in SEGMENT_COLS if c in df.columns]

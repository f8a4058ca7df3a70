"""Segment and market aggregates, and the features that join them back to listings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodgecurve.functions.features import listing_expressions, market_position
from lodgecurve.operators.scale import aggregate_with_quantiles, join_measured
from lodgecurve.schemas import (
    FALLBACK_SEASON_DAYS,
    SEGMENT_COLS,
    WEEKDAY_SHARE,
    WEEKEND_SHARE,
    distance_column,
    price_column,
    require_columns,
)


def listing_features(df: DataFrame) -> DataFrame:
    """Add every listing-level feature the columns allow, in one projection."""
    return df.withColumns(listing_expressions(df.columns, price_column(df), distance_column(df)))


def segment_stats(df: DataFrame, segment_cols: list[str] = SEGMENT_COLS, approx: bool = False) -> DataFrame:
    """Listing count and price statistics of each segment."""
    price = price_column(df)
    require_columns(df, segment_cols)
    stats = aggregate_with_quantiles(
        df,
        segment_cols,
        [
            F.count(F.lit(1)).alias("segment_listing_count"),
            F.avg(price).alias("segment_avg_price"),
            F.stddev(price).alias("segment_price_std"),
        ],
        {
            "segment_median_price": (price, 0.5),
            "segment_p90_price": (price, 0.9),
            "segment_p10_price": (price, 0.1),
        },
        approx=approx,
    )
    return stats.withColumn("segment_price_spread", F.col("segment_p90_price") - F.col("segment_p10_price"))


def competition_features(df: DataFrame, segment_cols: list[str] = SEGMENT_COLS, stats: DataFrame | None = None) -> DataFrame:
    """Join segment statistics onto listings and place each price in its segment."""
    stats = segment_stats(df, segment_cols) if stats is None else stats
    joined = join_measured(df, stats, segment_cols, "left")
    return joined.withColumns(market_position(F.col(price_column(df)).cast("double")))


# Segment means taken when the column exists.
SEGMENT_MEANS = {
    "guest_satisfaction_overall": "avg_satisfaction",
    "cleanliness_rating": "avg_cleanliness",
    "city_center_dist": "avg_city_center_dist",
    "metro_dist": "avg_metro_dist",
    "person_capacity": "avg_capacity",
    "bedrooms": "avg_bedrooms",
    "price_per_person": "avg_price_per_person",
    "quality_score": "avg_quality_score",
    "host_is_superhost": "host_is_superhost_rate",
    "biz": "biz_rate",
    "multi": "multi_rate",
    "n_bookings": "avg_bookings",
}


def segment_dataset(
    df: DataFrame, segment_cols: list[str] = SEGMENT_COLS, extra_quantiles: dict[str, tuple[str, float]] | None = None
) -> DataFrame:
    """One row per segment: supply, price distribution, quality, host mix and demand.

    ``extra_quantiles`` adds quantiles, by name, to the same aggregation.
    """
    price = price_column(df)
    require_columns(df, segment_cols)
    means = [F.avg(F.col(c).cast("double")).alias(a) for c, a in SEGMENT_MEANS.items() if c in df.columns]
    out = aggregate_with_quantiles(
        df,
        segment_cols,
        [
            F.count(F.lit(1)).alias("listing_count"),
            F.avg(price).alias("avg_price"),
            F.stddev(price).alias("std_price"),
            *means,
        ],
        {"median_price": (price, 0.5), "p10_price": (price, 0.1), "p90_price": (price, 0.9)} | (extra_quantiles or {}),
    )
    return out.withColumn("log_demand", F.log1p(F.col("listing_count").cast("double")))


def stats_from_dataset(dataset: DataFrame, segment_cols: list[str] = SEGMENT_COLS, *more: str) -> DataFrame:
    """The columns of ``segment_stats``, and ``more``, from a segment dataset, so both cost one aggregation."""
    names = {
        "listing_count": "segment_listing_count",
        "avg_price": "segment_avg_price",
        "std_price": "segment_price_std",
        "median_price": "segment_median_price",
        "p90_price": "segment_p90_price",
        "p10_price": "segment_p10_price",
    }
    return dataset.select(
        *segment_cols,
        *[F.col(a).alias(b) for a, b in names.items()],
        (F.col("p90_price") - F.col("p10_price")).alias("segment_price_spread"),
        *more,
    )


def quartiles(column: str = "price_per_bedroom") -> dict[str, tuple[str, float]]:
    return {"q1": (column, 0.25), "q3": (column, 0.75)}


def fences() -> dict[str, Column]:
    """Interquartile range and the fences 1.5 such ranges out, from columns ``q1`` and ``q3``."""
    spread = F.col("q3") - F.col("q1")
    reach = F.lit(1.5) * spread
    return {"iqr": spread, "lower_bound": F.col("q1") - reach, "upper_bound": F.col("q3") + reach}


def iqr_bounds(df: DataFrame, column: str = "price_per_bedroom", segment_cols: list[str] = SEGMENT_COLS) -> DataFrame:
    """Quartiles of ``column`` per segment and the fences around them."""
    return aggregate_with_quantiles(df, segment_cols, [], quartiles(column)).withColumns(fences())


def inside_fences(column: str = "price_per_bedroom") -> Column:
    """True within the fences, both included; false where that is unknown."""
    return F.coalesce(F.col(column).between(F.col("lower_bound"), F.col("upper_bound")), F.lit(False))


def with_outlier_flag(df: DataFrame, column: str = "price_per_bedroom", segment_cols: list[str] = SEGMENT_COLS) -> DataFrame:
    """Add ``is_inlier``: whether the value lies inside its segment's fences."""
    bounds = iqr_bounds(df, column, segment_cols).select(*segment_cols, "lower_bound", "upper_bound")
    joined = join_measured(df, bounds, segment_cols, "left")
    return joined.withColumn("is_inlier", inside_fences(column)).drop("lower_bound", "upper_bound")


def remove_outliers(df: DataFrame, column: str = "price_per_bedroom", segment_cols: list[str] = SEGMENT_COLS) -> DataFrame:
    return with_outlier_flag(df, column, segment_cols).where("is_inlier").drop("is_inlier")


def removal_report(flagged: DataFrame) -> DataFrame:
    """Rows before and after dropping flagged outliers, in one pass."""
    before, after = F.count(F.lit(1)), F.count_if(F.col("is_inlier"))
    return flagged.agg(
        before.alias("rows_before"),
        after.alias("rows_after"),
        (before - after).alias("rows_removed"),
        F.try_divide(F.lit(100.0) * (before - after), before).alias("pct_removed"),
    )


def column_profile(df: DataFrame, column: str) -> DataFrame:
    """Known and missing values, distinct count and moments of one column."""
    c = F.col(column)
    return df.agg(
        F.count(c).alias("total_listings"),
        F.count_if(c.isNull()).alias("null_count"),
        F.count_distinct(c).alias("unique_values"),
        F.avg(c).alias("mean_value"),
        F.stddev(c).alias("std_value"),
        F.min(c).alias("min_value"),
        F.max(c).alias("max_value"),
    )


def summary_table(df: DataFrame, columns: list[str]) -> DataFrame:
    """Count, mean, deviation, extremes and exact quartiles: one row per column."""
    entry = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("v")) for c in columns]))
    long = df.select(entry.alias("e")).select("e.column_name", "e.v")
    return aggregate_with_quantiles(
        long,
        ["column_name"],
        [
            F.count("v").alias("row_count"),
            F.avg("v").alias("mean_value"),
            F.stddev("v").alias("std_value"),
            F.min("v").alias("min_value"),
            F.max("v").alias("max_value"),
        ],
        {"p25": ("v", 0.25), "p50": ("v", 0.5), "p75": ("v", 0.75)},
    )


def segment_breakdown(df: DataFrame, column: str, segment_cols: list[str] = SEGMENT_COLS) -> DataFrame:
    """Listing count and average, least and greatest value per segment, in segment order."""
    return (
        df.groupBy(*segment_cols)
        .agg(
            F.count(F.lit(1)).alias("listing_count"),
            F.avg(column).alias("avg_value"),
            F.min(column).alias("min_value"),
            F.max(column).alias("max_value"),
        )
        .orderBy(*segment_cols)
    )


def average_price(df: DataFrame, by: list[str] = ["city", "season"]) -> DataFrame:
    return df.groupBy(*by).agg(F.avg(price_column(df)).alias("avg_price")).orderBy("avg_price", *by)


def market_size(df: DataFrame, by: list[str] = ["city", "season"]) -> DataFrame:
    """Market value, the sum of price times occupancy, with listing count and average price."""
    price = F.col(price_column(df))
    return (
        df.groupBy(*by)
        .agg(
            F.sum(price * F.col("occupancy_rate")).alias("total_market_value"),
            F.count(F.lit(1)).alias("listing_count"),
            F.avg(price).alias("avg_price"),
        )
        .orderBy("avg_price", *by)
    )


# Medians that describe a market's typical property.
PROFILE_MEDIANS = {
    "median_price": "listing_price",
    "median_capacity": "person_capacity",
    "median_bedrooms": "bedrooms",
    "median_cleanliness": "cleanliness_rating",
    "median_satisfaction": "guest_satisfaction_overall",
    "median_city_dist": "city_center_dist",
    "median_metro_dist": "metro_dist",
}


def market_profile(df: DataFrame, market: str = "city") -> DataFrame:
    """The typical property of every market."""
    return aggregate_with_quantiles(df, [market], [], {a: (c, 0.5) for a, c in PROFILE_MEDIANS.items()})


def pricing_segment_stats(
    df: DataFrame, segment_cols: list[str] = SEGMENT_COLS, extra: Sequence[Column] = (), cells: DataFrame | None = None
) -> DataFrame:
    """Segment statistics for pricing: those of ``segment_stats`` with days, volatility and ``extra`` aggregates.

    ``cells`` are the listings' ``elasticity.price_cells``, where they were summed already.
    """
    price = price_column(df)
    out = aggregate_with_quantiles(
        df,
        segment_cols,
        [
            F.count(F.lit(1)).alias("listing_count"),
            F.avg(price).alias("segment_avg_price"),
            F.stddev(price).alias("segment_price_std"),
            F.avg("days_in_period").alias("avg_days_in_period"),
            *extra,
        ],
        {
            "segment_median_price": (price, 0.5),
            "segment_p90_price": (price, 0.9),
            "segment_p10_price": (price, 0.1),
        },
        cells=None if cells is None else {price: cells},
    )
    mean = F.col("segment_avg_price")
    return out.withColumns(
        {
            "segment_price_spread": F.col("segment_p90_price") - F.col("segment_p10_price"),
            "segment_relative_price_volatility": F.when(mean > 0, F.col("segment_price_std") / mean).otherwise(F.lit(0.0)),
        }
    )


def days_per_segment(df: DataFrame, segment_cols: list[str] = SEGMENT_COLS, tolerance: float = 10.0) -> DataFrame:
    """Average days of each segment, with a seasonal default where none are known.

    ``plausible_year`` says whether a market's days add up to 365 within ``tolerance``.
    """
    market = [c for c in segment_cols if c not in ("season", "weekend")]
    default = F.coalesce(*[F.when(F.col("season") == s, F.lit(d)) for s, d in FALLBACK_SEASON_DAYS.items()])
    share = F.when(F.col("weekend") == 1, F.lit(WEEKEND_SHARE)).otherwise(F.lit(WEEKDAY_SHARE))
    days = df.groupBy(*segment_cols).agg(F.avg("days_in_period").alias("known"))
    out = days.select(*segment_cols, F.coalesce("known", default * share).alias("days_in_segment"))
    total = F.sum("days_in_segment").over(Window.partitionBy(*market))
    return out.withColumn("plausible_year", F.abs(total - F.lit(365.0)) <= F.lit(tolerance))


def price_deciles(df: DataFrame, by: list[str] = ["city"]) -> DataFrame:
    """Listing count, average price and the nine price deciles."""
    price = price_column(df)
    deciles = {f"p{10 * i}": (price, i / 10) for i in range(1, 10)}
    return aggregate_with_quantiles(
        df, by, [F.count(F.lit(1)).alias("listing_count"), F.avg(price).alias("avg_price")], deciles
    )

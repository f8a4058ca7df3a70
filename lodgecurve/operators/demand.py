"""From market statistics to demand curves over price grids, for all markets at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodgecurve.functions.features import capacity_bin, market_position, price_expressions, quality_score
from lodgecurve.functions.response import occupancy_at, slope_at
from lodgecurve.functions.values import clip, segment_name
from lodgecurve.operators.elasticity import regime_table
from lodgecurve.operators.ordering import season_rank
from lodgecurve.operators.scale import join_measured
from lodgecurve.schemas import SEGMENT_COLS

REGIME_COLS = ["slope_all", "slope_low", "slope_high", "breakpoint_log_price"]


def representative_property(profile: DataFrame, room_type: str = "Entire home/apt", mode: str = "train") -> DataFrame:
    """The property each market is priced for: its medians, run by a superhost with one listing."""
    whole = lambda c: F.col(c).cast("int").cast("double")
    satisfaction, cleanliness = F.col("median_satisfaction"), F.col("median_cleanliness")
    score = (
        quality_score(satisfaction, cleanliness, F.col("median_city_dist"))
        if mode == "train"
        else cleanliness * satisfaction / F.lit(100.0)
    )
    return profile.select(
        "city",
        F.col("median_price").alias("listing_price"),
        whole("median_capacity").alias("person_capacity"),
        whole("median_bedrooms").alias("bedrooms"),
        cleanliness.alias("cleanliness_rating"),
        satisfaction.alias("guest_satisfaction_overall"),
        F.col("median_city_dist").alias("city_center_dist"),
        F.col("median_metro_dist").alias("metro_dist"),
        F.lit(1).alias("host_is_superhost"),
        F.lit(0).alias("multi"),
        F.lit(0).alias("biz"),
        F.lit(room_type).alias("room_type"),
        capacity_bin(whole("median_capacity")).alias("capacity_bin"),
        F.log1p("median_metro_dist").alias("log_metro_dist"),
        score.alias("quality_score"),
    )


def with_regimes(segments: DataFrame, rows: DataFrame) -> DataFrame:
    """Attach each segment's slopes and breakpoint."""
    return join_measured(segments, regime_table(rows), SEGMENT_COLS, "left")


def _slope_for(price: Column) -> Column:
    return slope_at(
        price, F.expm1("breakpoint_log_price"), F.col("slope_all"), F.col("slope_low"), F.col("slope_high")
    )


def reprice(df: DataFrame, price: Column, mode: str = "train") -> DataFrame:
    """Set ``listing_price`` and recompute everything that depends on it.

    Needs the property columns and segment statistics on the row; with regime columns there
    too, the slope follows the price across the breakpoint.
    """
    new = {"listing_price": price} | price_expressions(price, "city_center_dist", mode) | market_position(price, mode)
    if set(REGIME_COLS) <= set(df.columns):
        new["elasticity_slope"] = _slope_for(price)
    return df.withColumns(new)


def baseline_features(stats: DataFrame, properties: DataFrame, rows: DataFrame, mode: str = "train") -> DataFrame:
    """Each market's property in each of its segments, priced at the segment median."""
    joined = join_measured(stats, properties.drop("listing_price"), ["city"], "inner")
    priced = reprice(with_regimes(joined, rows), F.col("segment_median_price"), mode)
    return priced.withColumn("is_weekend", F.col("weekend").cast("int"))


def demand_curve(baseline: DataFrame, span: float = 0.5, points: int = 500) -> DataFrame:
    """Prices evenly spread over baseline * (1 -/+ span), with occupancy and revenue at each.

    ``baseline`` has one row per segment: ``baseline_price``, ``baseline_occupancy``, the
    regime columns and anything to carry along. ``candidate_id`` is unique within a market.
    """
    if not 0 < span < 1:
        raise ValueError("span must lie between 0 and 1")
    if points < 3:
        raise ValueError("points must be 3 or more")
    base = F.col("baseline_price")
    low, high = base * F.lit(1.0 - span), base * F.lit(1.0 + span)
    step = (high - low) / F.lit(float(points - 1))
    grid = baseline.withColumn("grid_index", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
    price = F.when(F.col("grid_index") == points - 1, high).otherwise(low + F.col("grid_index") * step)
    occupancy = occupancy_at(
        F.col("price"), base, F.col("baseline_occupancy"), F.expm1("breakpoint_log_price"),
        F.col("slope_all"), F.col("slope_low"), F.col("slope_high"),
    )
    ordinal = season_rank(F.col("season")) * 2 + F.col("weekend")
    return (
        grid.withColumn("price", price)
        .withColumns({"predicted_occupancy": occupancy, "elasticity_slope": _slope_for(F.col("price"))})
        .withColumns(
            {
                "daily_revenue": F.col("price") * F.col("predicted_occupancy"),
                "candidate_id": (ordinal * points + F.col("grid_index")).cast("bigint"),
                "segment_name": segment_name(F.col("season"), F.col("weekend")),
            }
        )
        .drop(*REGIME_COLS)
    )


def annual_revenue(candidates: DataFrame, days: DataFrame | None = None) -> DataFrame:
    """Yearly revenue from daily revenue and the days of the segment."""
    if days is not None:
        candidates = join_measured(candidates, days.select(*SEGMENT_COLS, "days_in_segment"), SEGMENT_COLS, "left")
    return candidates.withColumn("annual_revenue", F.col("daily_revenue") * F.col("days_in_segment"))

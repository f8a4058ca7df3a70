"""Listing-level features as named expressions.

Two formula sets exist for price-dependent features. ``train`` is what models are fitted on
and the default everywhere; ``serving`` is a second convention some scored tables use.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F



def _num(name: str) -> Column:
    return F.col(name).cast("double")


def _at_least(value: Column, floor: float) -> Column:
    return F.greatest(value, F.lit(floor))


def capacity_bin(capacity: Column) -> Column:
    """'1' to '4', and '5+' for everything else, NULL and fractions included."""
    return (
        F.when(capacity <= 1, "1")
        .when(capacity.isin(2, 3, 4), capacity.cast("int").cast("string"))
        .otherwise("5+")
    )


def quality_score(satisfaction: Column, cleanliness: Column, distance: Column) -> Column:
    nearness = _at_least(F.lit(5.0) - distance, 0.0)
    blend = satisfaction * F.lit(0.5) + cleanliness * F.lit(0.3) + nearness * F.lit(4.0)
    return F.least(_at_least(blend, 0.0), F.lit(100.0))


def price_expressions(price: Column, distance: str | None, mode: str = "train") -> dict[str, Column]:
    """Features that depend on the price and on columns of the same row.

    Every feature needs the columns listed with it in ``PRICE_INPUTS``.
    """
    out = {
        "log_price": F.log1p(price),
        "price_per_person": price / _at_least(_num("person_capacity"), 1.0),
        "price_per_bedroom": price / _at_least(_num("bedrooms"), 1.0),
        "price_x_satisfaction": price * _num("guest_satisfaction_overall"),
    }
    if mode == "train":
        out["price_x_satisfaction"] = out["price_x_satisfaction"] / F.lit(100.0)
    if distance:
        d = _num(distance)
        reach = d + F.lit(0.1) if mode == "train" else _at_least(d, 0.1)
        out["price_per_dist_km"] = F.try_divide(price, reach)
    return out


PRICE_INPUTS = {
    "log_price": [],
    "price_per_person": ["person_capacity"],
    "price_per_bedroom": ["bedrooms"],
    "price_x_satisfaction": ["guest_satisfaction_overall"],
    "price_per_dist_km": [],
}


def market_position(price: Column, mode: str = "train") -> dict[str, Column]:
    """Where a price stands in its segment; needs the segment statistics on the row."""
    median, mean = F.col("segment_median_price"), F.col("segment_avg_price")
    if mode == "train":
        return {
            "price_vs_segment_median": price / _at_least(median, 1.0),
            "price_vs_segment_avg": price / _at_least(mean, 1.0),
            "relative_price_volatility": F.col("segment_price_spread") / _at_least(median, 1.0),
        }
    return {
        "price_vs_segment_median": (price - median) / _at_least(median, 1.0),
        "price_vs_segment_avg": (price - mean) / _at_least(mean, 1.0),
        "relative_price_volatility": F.when(mean > 0, F.col("segment_price_std") / mean).otherwise(F.lit(0.0)),
    }


def listing_expressions(columns: list[str], price: str, distance: str | None) -> dict[str, Column]:
    """All listing features the given columns allow, ready for one ``withColumns``."""
    have = set(columns)
    p = _num(price)
    out = {
        name: expr
        for name, expr in price_expressions(p, distance).items()
        if have.issuperset(PRICE_INPUTS[name])
    }
    if "person_capacity" in have:
        out["capacity_bin"] = capacity_bin(F.col("person_capacity"))
    if distance and have >= {"guest_satisfaction_overall", "cleanliness_rating"}:
        out["quality_score"] = quality_score(
            _num("guest_satisfaction_overall"), _num("cleanliness_rating"), _num(distance)
        )
    logs = {"metro_dist": "log_metro_dist", "n_bookings": "log_bookings"}
    out |= {new: F.log1p(_num(old)) for old, new in logs.items() if old in have}
    ints = {"host_is_superhost": "host_is_superhost", "multi": "multi", "biz": "biz", "weekend": "is_weekend"}
    out |= {new: F.col(old).cast("int") for old, new in ints.items() if old in have}
    return out

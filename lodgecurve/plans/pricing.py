"""From prepared listings and a demand model to recommended prices for every market."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodgecurve.operators import demand, learning, report, segments
from lodgecurve.operators.cleaning import safe_floats
from lodgecurve.operators.encoding import SparseCategories, apply_one_hot
from lodgecurve.operators.optimize import PriceRules, optimal_prices
from lodgecurve.operators.scale import join_measured, materialise
from lodgecurve.schemas import SEGMENT_COLS


def baseline_scores(
    listed: DataFrame, rows: DataFrame, model, names: list[str], fitted: dict | SparseCategories, room_type: str, mode: str = "train"
) -> DataFrame:
    """Occupancy the model expects for each market's typical property at the segment median price."""
    stats = segments.pricing_segment_stats(listed)
    properties = demand.representative_property(segments.market_profile(listed), room_type, mode)
    inputs = apply_one_hot(demand.baseline_features(stats, properties, rows, mode), fitted)
    vectors = set(learning.vector_columns(inputs, names))
    scored = learning.score(safe_floats(inputs, [n for n in names if n not in vectors]), model, names, "baseline_occupancy")
    return scored.select(
        *SEGMENT_COLS, F.col("listing_price").alias("baseline_price"), "baseline_occupancy",
        F.col("elasticity_slope").alias("baseline_slope"), "segment_avg_price", *demand.REGIME_COLS,
    )


@dataclass
class Pricing:
    baseline: DataFrame
    candidates: DataFrame
    report: DataFrame
    schedule: DataFrame
    status: DataFrame
    summary: DataFrame


def price_markets(
    listed: DataFrame, rows: DataFrame, model, names: list[str], fitted: dict | SparseCategories, room_type: str,
    rules: PriceRules = PriceRules(), span: float = 0.5, points: int = 500, mode: str = "train",
) -> Pricing:
    """Recommended prices and reports for all markets in ``listed``."""
    days = segments.days_per_segment(listed).select(*SEGMENT_COLS, "days_in_segment")
    scores = baseline_scores(listed, rows, model, names, fitted, room_type, mode)
    baseline = materialise(join_measured(scores, days, SEGMENT_COLS, "left"))
    candidates = demand.annual_revenue(demand.demand_curve(baseline, span, points))
    chosen, status = optimal_prices(candidates, rules)
    lifted = materialise(report.lift_report(chosen))
    properties = demand.representative_property(segments.market_profile(listed), room_type, mode)
    return Pricing(
        baseline, candidates, lifted, report.price_schedule(lifted), status,
        report.business_summary(lifted, properties, rules, span),
    )

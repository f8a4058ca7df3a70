"""Registered queries: each reads the shared tables whole and runs one or more operators."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodgecurve.checks.listings import listings
from lodgecurve.functions import values as V
from lodgecurve.operators import (
    cleaning, demand, elasticity, encoding, importance, learning, mlp, optimize, ordering, report, segments, splits,
)
from lodgecurve.operators.scale import materialise, shared_folder
from lodgecurve.plans import pricing, training
from lodgecurve.plans.features import CATEGORIES, prepare_listings
from lodgecurve.plans.features import feature_dataset as build_feature_dataset
from lodgecurve.plans.ingest import ingest
from lodgecurve.schemas import NUMERIC_FEATURES, SEGMENT_COLS
from lodgecurve.sources import readers, writers

KEY = "listing_key"


def r(column: str | Column, digits: int = 6, name: str | None = None) -> Column:
    """Round a computed double so that the last bits of two engines do not matter.

    Aggregates are rounded to 6 digits. Values computed within a row can sit on a decimal tie,
    which engines break differently, so they are rounded to 9 digits, past their last one.
    """
    c = F.col(column) if isinstance(column, str) else column
    return F.round(c, digits).alias(name or column)


def clipped(spark, sf, *columns: str) -> DataFrame:
    return cleaning.clip_listings(listings(spark, sf, *columns))


def features(spark, sf) -> DataFrame:
    return segments.listing_features(clipped(spark, sf))


PRICED = [*SEGMENT_COLS, "listing_price"]
PROFILED = [*SEGMENT_COLS, *segments.PROFILE_MEDIANS.values(), "occupancy_rate", "days_in_period"]
SOLD = [*PRICED, "occupancy_rate", "days_in_period"]
PREPARED = [
    KEY, *PRICED, "person_capacity", "bedrooms", "cleanliness_rating", "guest_satisfaction_overall", "city_center_dist",
    "metro_dist", "host_is_superhost", "multi", "biz", "n_bookings", "occupancy_rate",
]


def held(spark, sf, *columns: str) -> DataFrame:
    """Clipped listings, or some of their columns, written once for operators that read them repeatedly."""
    df = clipped(spark, sf, *columns)
    return materialise(df.select(*columns) if columns else df)


def held_features(spark, sf, *columns: str) -> DataFrame:
    return segments.listing_features(held(spark, sf, *columns))


# --- cleaning --------------------------------------------------------------------------


def clip_ranges(spark, sf):
    """Clip prices and two shifted columns that leave their ranges on both sides."""
    df = listings(spark, sf).withColumns(
        {"bedrooms": F.col("bedrooms") * 4.0 - 2.0, "cleanliness_rating": F.col("cleanliness_rating") + 3.0}
    )
    return cleaning.clip_ranges(df).select(
        KEY, "listing_price", "bedrooms", r("cleanliness_rating", 9), r("occupancy_rate", 9), "days_in_period"
    )


def clip_to_column(spark, sf):
    df = listings(spark, sf).withColumn("days_booked", F.col("days_booked") * 1.3 - 5.0)
    return cleaning.clip_to_column(df).select(KEY, "days_in_period", r("days_booked", 9))


def clip_binary(spark, sf):
    df = listings(spark, sf).withColumns({"multi": F.col("multi") * 3 - 1, "biz": F.col("biz") + 1})
    return cleaning.clip_binary(df).select(KEY, "host_is_superhost", "multi", "biz", "weekend")


def _word(column: str) -> Column:
    """The listing's flags as the words raw files use."""
    return F.when(F.col("biz") == 1, F.lit(None)).when(F.col(column) == 1, F.lit("Yes")).otherwise(F.lit("F"))


def bool_flags(spark, sf):
    df = listings(spark, sf).select(
        KEY,
        _word("host_is_superhost").alias("host_is_superhost"),
        F.when(F.col("weekend") == 1, "TRUE").otherwise(F.col("season")).alias("weekend"),
        F.when(F.col("multi") == 1, "2").otherwise("no").alias("multi"),
        (F.col("biz") == 1).alias("biz"),
    )
    return cleaning.booleans_to_ints(cleaning.to_ints(cleaning.to_flags(df), ["multi"]))


def tolerant_casts(spark, sf):
    """Numbers that arrive as text, some of it unreadable."""
    df = listings(spark, sf).select(
        KEY,
        F.when(F.col("biz") == 1, "n/a").otherwise(F.col("days_booked").cast("int").cast("string")).alias("days_booked"),
        F.when(F.col("multi") == 1, "").otherwise(F.col("person_capacity").cast("int").cast("string")).alias("person_capacity"),
        F.col("room_type").alias("bedrooms"),
    )
    return cleaning.to_doubles(df)


def sanitize_categories(spark, sf):
    raw = F.when(F.col("biz") == 1, "--").otherwise(
        F.concat(F.lit("  "), F.initcap("room_type"), F.lit(" / "), F.upper("season"), F.lit("! "))
    )
    return (
        listings(spark, sf)
        .select(V.safe_category(raw).alias("category"))
        .groupBy("category")
        .agg(F.count(F.lit(1)).alias("listing_count"))
    )


def segment_key_roundtrip(spark, sf):
    key = V.segment_key(F.col("city"), F.col("season"), F.col("weekend"))
    counted = listings(spark, sf).select(key.alias("segment_key")).groupBy("segment_key").agg(F.count(F.lit(1)).alias("listing_count"))
    parts = V.parse_segment_key(F.col("segment_key"))
    return counted.select(
        "segment_key", "listing_count", *[c.alias(n) for n, c in parts.items()],
        V.segment_name(parts["season"], parts["weekend"]).alias("segment_name"),
    )


def safe_fill(spark, sf):
    nan, inf = F.lit(float("nan")), F.lit(float("inf"))
    df = listings(spark, sf).select(
        KEY,
        F.when(F.col("biz") == 1, nan).when(F.col("multi") == 1, inf).otherwise(F.col("bedrooms")).alias("bedrooms"),
        F.when(F.col("biz") == 1, nan).when(F.col("multi") == 1, F.lit(None)).otherwise(F.col("metro_dist")).alias("metro_dist"),
    )
    return cleaning.fill_missing(cleaning.safe_floats(df, ["bedrooms"], -1.0), ["metro_dist"])


def label_rows(spark, sf):
    df = listings(spark, sf).withColumn("occupancy_rate", F.when(F.col("biz") == 0, F.col("occupancy_rate")))
    return cleaning.labelled(df).select(KEY, r("label", 9))


def market_filter(spark, sf):
    return cleaning.in_market(listings(spark, sf), "nation_7", "shoulder", 1).select(
        KEY, "city", "season", "weekend", "listing_price"
    )


# --- features --------------------------------------------------------------------------

FEATURES_OUT = [
    "log_price", "price_per_person", "price_per_bedroom", "quality_score", "price_x_satisfaction",
    "price_per_dist_km", "log_metro_dist", "log_bookings",
]


def listing_features(spark, sf):
    return features(spark, sf).select(
        KEY, "capacity_bin", "is_weekend", "host_is_superhost", "multi", "biz", *[r(c, 9) for c in FEATURES_OUT]
    )


ROOM_TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


def one_hot(spark, sf):
    out = encoding.one_hot(held_features(spark, sf, KEY, "room_type", "season", "listing_price", "person_capacity"), ["room_type", "season", "capacity_bin"], drop_originals=True)
    return out.select(KEY, *sorted(c for c in out.columns if c.startswith("cat_")))


def reverse_one_hot(spark, sf):
    coded = encoding.one_hot(held_features(spark, sf, KEY, *PRICED), ["city", "season"], drop_originals=True).drop("weekend")
    back = encoding.restore_weekend(encoding.reverse_one_hot(encoding.reverse_one_hot(coded, "city"), "season"))
    return back.select(KEY, "city", "season", "weekend")


def one_hot_apply(spark, sf):
    """Categories fitted on part of the listings, stored, and applied to all of them."""
    df = features(spark, sf)
    fitted = encoding.fit_categories(df.where(F.col("room_type") < "PROMO"), ["room_type"])
    stored = encoding.categories_frame(spark, fitted)
    out = encoding.apply_one_hot(df, encoding.load_categories(stored))
    return out.select(KEY, *sorted(c for c in out.columns if c.startswith("cat_")))


STATS_OUT = [
    "segment_avg_price", "segment_price_std", "segment_median_price", "segment_p90_price", "segment_p10_price",
    "segment_price_spread",
]
POSITION_OUT = ["price_vs_segment_median", "price_vs_segment_avg", "relative_price_volatility"]


# --- segments --------------------------------------------------------------------------


def segment_stats(spark, sf):
    return segments.segment_stats(held(spark, sf, *PRICED)).select(
        *SEGMENT_COLS, "segment_listing_count", *[r(c) for c in STATS_OUT]
    )


def segment_dataset(spark, sf):
    out = segments.segment_dataset(features(spark, sf))
    fixed = [*SEGMENT_COLS, "listing_count"]
    return out.select(*fixed, *[r(c) for c in out.columns if c not in fixed])


def iqr_bounds(spark, sf):
    out = segments.iqr_bounds(held_features(spark, sf, *PRICED, "bedrooms"))
    return out.select(*SEGMENT_COLS, *[r(c, 9) for c in out.columns if c not in SEGMENT_COLS])


def outlier_filter(spark, sf):
    out = segments.remove_outliers(held_features(spark, sf, KEY, *PRICED, "bedrooms"))
    return out.select(KEY, *SEGMENT_COLS, r("price_per_bedroom", 9))


def outlier_report(spark, sf):
    out = segments.removal_report(segments.with_outlier_flag(held_features(spark, sf, *PRICED, "bedrooms")))
    return out.select("rows_before", "rows_after", "rows_removed", r("pct_removed"))


def competition_features(spark, sf):
    out = segments.competition_features(held(spark, sf, KEY, *PRICED))
    return out.select(KEY, "segment_listing_count", *[r(c) for c in STATS_OUT], *[r(c, 9 if "avg" not in c else 6) for c in POSITION_OUT])


def column_profile(spark, sf):
    out = segments.column_profile(
        features(spark, sf).withColumn("price_per_dist_km", F.when(F.col("biz") == 0, F.col("price_per_dist_km"))),
        "price_per_dist_km",
    )
    counts = ["total_listings", "null_count", "unique_values"]
    return out.select(*counts, r("mean_value"), r("std_value"), r("min_value", 9), r("max_value", 9))


SUMMARY_INPUTS = [
    "listing_price", "bedrooms", "guest_satisfaction_overall", "cleanliness_rating", "city_center_dist", "occupancy_rate",
]


def summary_table(spark, sf):
    out = segments.summary_table(held_features(spark, sf, *SUMMARY_INPUTS), ["listing_price", "price_per_bedroom", "quality_score", "occupancy_rate"])
    exact = ["min_value", "max_value", "p25", "p50", "p75"]
    return out.select("column_name", "row_count", r("mean_value"), r("std_value"), *[r(c, 9) for c in exact])


def segment_breakdown(spark, sf):
    return segments.segment_breakdown(features(spark, sf), "price_per_person").select(
        *SEGMENT_COLS, "listing_count", r("avg_value"), r("min_value", 9), r("max_value", 9)
    )


def avg_price_by_city_season(spark, sf):
    return segments.average_price(clipped(spark, sf)).select("city", "season", r("avg_price"))


def market_size(spark, sf):
    return segments.market_size(clipped(spark, sf)).select(
        "city", "season", r("total_market_value", 3), "listing_count", r("avg_price")
    )


def market_profile(spark, sf):
    out = segments.market_profile(held(spark, sf, "city", *segments.PROFILE_MEDIANS.values()))
    return out.select("city", *[r(c) for c in out.columns if c != "city"])


def pricing_segment_stats(spark, sf):
    out = segments.pricing_segment_stats(held(spark, sf, *PRICED, "days_in_period"))
    fixed = [*SEGMENT_COLS, "listing_count"]
    return out.select(*fixed, *[r(c) for c in out.columns if c not in fixed])


def days_per_segment(spark, sf):
    """Days per segment, with those of one day type of the low season unknown."""
    unknown = (F.col("season") == "low") & (F.col("weekend") == 1)
    df = listings(spark, sf).withColumn("days_in_period", F.when(~unknown, F.col("days_in_period")))
    return segments.days_per_segment(df).select(*SEGMENT_COLS, r("days_in_segment"), "plausible_year")


def distinct_values(spark, sf):
    return encoding.distinct_values(features(spark, sf), ["room_type", "city", "season", "capacity_bin"]).withColumnsRenamed(
        {"column": "column_name", "value": "category"}
    )


def price_deciles(spark, sf):
    out = segments.price_deciles(held(spark, sf, "city", "listing_price"))
    fixed = ["city", "listing_count"]
    return out.select(*fixed, *[r(c) for c in out.columns if c not in fixed])


def feature_dataset(spark, sf):
    """Listing features with one-hot columns and segment statistics, for one row per listing."""
    fitted = {"season": {f"cat_season_{s}": [s] for s in ("high", "low", "shoulder")}}
    out, _ = build_feature_dataset(held(spark, sf), categories=fitted)
    return out.select(
        KEY, *SEGMENT_COLS, "cat_season_high", "cat_season_low", "cat_season_shoulder", "segment_listing_count",
        r("quality_score", 9), r("price_per_bedroom", 9), *[r(c) for c in STATS_OUT],
        *[r(c, 9 if "avg" not in c else 6) for c in POSITION_OUT],
    )


# --- elasticity ------------------------------------------------------------------------


def bins(spark, sf) -> DataFrame:
    return elasticity.price_bins(held(spark, sf, *SOLD))


def fit(spark, sf) -> DataFrame:
    return elasticity.breakpoint_fit(bins(spark, sf))


def elastic_rows(listed: DataFrame, cells: DataFrame | None = None) -> DataFrame:
    return materialise(elasticity.elasticity_rows(elasticity.breakpoint_fit(elasticity.price_bins(listed, cells=cells))))


def price_bins(spark, sf):
    return bins(spark, sf).select(*SEGMENT_COLS, "bin", "n", r("x"), r("y"))


def segment_ols(spark, sf):
    return elasticity.segment_ols(bins(spark, sf)).select(
        *SEGMENT_COLS, "n_bins", r("slope"), r("intercept"), r("r_squared")
    )


def breakpoint_search(spark, sf):
    """One or two lines per segment, whichever the criterion prefers."""
    return fit(spark, sf).select(
        *SEGMENT_COLS, "regime", "price_regime", "n_bins", r("slope"), r("intercept"), r("r_squared"),
        r("breakpoint_log_price"),
    )


def slope_classes(spark, sf):
    """Two lines in every segment, under segment keys and with classified slopes."""
    two = elasticity.breakpoint_fit(bins(spark, sf), force_two=True)
    return elasticity.elasticity_summary(two).select(
        "segment", "regime", "regime_type", r("slope"), r("r_squared"), "n_bins", "price_range"
    )


def elasticity_json(spark, sf):
    rows = elastic_rows(held(spark, sf, *SOLD))
    return elasticity.elasticity_documents(rows.withColumns({c: F.round(c, 6) for c in ("elasticity_slope", "breakpoint_log_price")}))


def elasticity_flatten(spark, sf):
    """Elasticity rows written to nested JSON text and read back."""
    documents = elasticity.elasticity_documents(elastic_rows(held(spark, sf, *SOLD)))
    return elasticity.flatten_documents(documents).select(
        *SEGMENT_COLS, "price_regime", r("elasticity_slope"), r("breakpoint_log_price")
    )


def regime_lookup(spark, sf):
    listed = held_features(spark, sf, KEY, *SOLD)
    out = elasticity.with_elasticity(listed, elastic_rows(listed))
    return out.select(KEY, *SEGMENT_COLS, r("elasticity_slope"))


def impute_slope(spark, sf):
    """Slopes of the high regime are missing on weekends and filled from the low regime."""
    listed = held_features(spark, sf, KEY, *SOLD)
    rows = elastic_rows(listed).where(~((F.col("weekend") == 1) & (F.col("price_regime") == "high")))
    listed = elasticity.with_elasticity(listed, rows)
    return elasticity.impute_slope(listed).select(KEY, *SEGMENT_COLS, r("elasticity_slope"))


# --- splits and order ------------------------------------------------------------------


def hash_split(spark, sf):
    train, test = splits.hash_split(listings(spark, sf), [KEY])
    return train.select(KEY, F.lit("train").alias("split")).unionByName(test.select(KEY, F.lit("test").alias("split")))


def three_way_split(spark, sf):
    return splits.with_split(listings(spark, sf), [KEY]).select(KEY, "split")


def chunk_split(spark, sf):
    return splits.with_chunk(listings(spark, sf), [KEY], 5, epoch=3).groupBy("chunk").agg(
        F.count(F.lit(1)).alias("listing_count"), F.min(KEY).alias("first_key"), F.max(KEY).alias("last_key")
    )


def top_k(spark, sf):
    return ordering.top(clipped(spark, sf), 25, "listing_price", KEY).select(KEY, "city", "listing_price")


def hash_sample_topn(spark, sf):
    return splits.hash_top(listings(spark, sf), [KEY], 100).select(KEY, "city", "listing_price")


def random_topn(spark, sf):
    return splits.random_top(listings(spark, sf), 10).select(KEY, "city", "listing_price")


def season_order(spark, sf):
    counted = listings(spark, sf).groupBy(*SEGMENT_COLS).agg(F.count(F.lit(1)).alias("listing_count"))
    ranked = counted.withColumn("season_rank", ordering.season_rank(F.col("season")))
    return ordering.by_season(ranked, "city")


def bernoulli_sample(spark, sf):
    return splits.sample_about(listings(spark, sf), 10_000).select(KEY, "city", "listing_price")


# --- pricing ---------------------------------------------------------------------------


def baseline(listed: DataFrame, with_days: bool = True) -> DataFrame:
    """Each segment at its median price and mean occupancy, with its regimes."""
    cells = elasticity.price_cells(listed)
    stats = segments.pricing_segment_stats(listed, extra=[F.avg("occupancy_rate").alias("baseline_occupancy")], cells=cells)
    base = stats.select(
        *SEGMENT_COLS, F.col("segment_median_price").alias("baseline_price"), "baseline_occupancy",
        *([F.col("avg_days_in_period").alias("days_in_segment")] if with_days else []),
    )
    return materialise(demand.with_regimes(base, elastic_rows(listed, cells)))


GRID = 500


def price_grid(spark, sf):
    curve = demand.demand_curve(baseline(held(spark, sf, *SOLD)), points=500)
    return curve.select(*SEGMENT_COLS, "segment_name", "candidate_id", "grid_index", r("price", 9))


def demand_curve(spark, sf):
    curve = demand.demand_curve(baseline(held(spark, sf, *SOLD)), points=500)
    return curve.select(
        *SEGMENT_COLS, "candidate_id", r("price", 9), r("predicted_occupancy"), r("daily_revenue"), r("elasticity_slope")
    )


def annual_revenue(spark, sf):
    listed = held(spark, sf, *SOLD)
    curve = demand.demand_curve(baseline(listed, with_days=False), points=500)
    out = demand.annual_revenue(curve, segments.days_per_segment(listed))
    return out.select(*SEGMENT_COLS, "candidate_id", r("days_in_segment"), r("annual_revenue", 4))


def market_properties(listed: DataFrame) -> DataFrame:
    return demand.representative_property(segments.market_profile(listed), "STANDARD")


def representative_property(spark, sf):
    out = market_properties(held(spark, sf, "city", *segments.PROFILE_MEDIANS.values()))
    texts = ["city", "host_is_superhost", "multi", "biz", "room_type", "capacity_bin"]
    return out.select(*texts, *[r(c, 9) for c in out.columns if c not in texts])


REPRICED = [
    "listing_price", "log_price", "price_per_person", "price_per_bedroom", "price_x_satisfaction", "price_per_dist_km",
    "price_vs_segment_median", "price_vs_segment_avg", "relative_price_volatility", "elasticity_slope",
]


def _repriced(spark, sf, mode: str) -> DataFrame:
    listed = held(spark, sf, *PROFILED)
    cells = elasticity.price_cells(listed)
    stats = segments.pricing_segment_stats(listed, cells=cells)
    base = demand.baseline_features(stats, market_properties(listed), elastic_rows(listed, cells), mode)
    dearer = demand.reprice(base, F.col("segment_median_price") * F.lit(1.2), mode)
    return dearer.select(*SEGMENT_COLS, *[r(c) for c in REPRICED])


def reprice_features(spark, sf):
    """Every market's property in each segment, 20% above the median price."""
    return _repriced(spark, sf, "train")


def reprice_features_serving(spark, sf):
    return _repriced(spark, sf, "serving")


def solved(listed: DataFrame, points: int = GRID) -> tuple[DataFrame, DataFrame]:
    return optimize.optimal_prices(demand.annual_revenue(demand.demand_curve(baseline(listed), points=points)))


def optimal_prices(spark, sf):
    """Optimal prices of all markets on a grid of 500 prices."""
    rows, _ = solved(held(spark, sf, *SOLD))
    return rows.select(*SEGMENT_COLS, "grid_index", r("price", 9), r("predicted_occupancy"), r("annual_revenue", 4))


def optimal_prices_full_grid(spark, sf):
    rows, _ = solved(held(spark, sf, *SOLD), 500)
    return rows.select(*SEGMENT_COLS, "grid_index", r("price", 9), r("predicted_occupancy"), r("annual_revenue", 4))


def solution_status(spark, sf, points=GRID):
    _, status = solved(held(spark, sf, *SOLD), points)
    return status


def solution_status_full_grid(spark, sf):
    return solution_status(spark, sf, 500)


def lift_report(spark, sf, points=GRID):
    out = report.lift_report(solved(held(spark, sf, *SOLD), points)[0])
    changes = ["price_change_pct", "occupancy_change_pct", "revenue_lift_pct"]
    money = ["baseline_annual_revenue", "annual_revenue", "revenue_lift"]
    return out.select(*SEGMENT_COLS, "segment_name", *[r(c, 5) for c in changes], *[r(c, 4) for c in money])


def lift_report_full_grid(spark, sf):
    return lift_report(spark, sf, 500)


def price_schedule(spark, sf):
    return report.price_schedule(report.lift_report(solved(held(spark, sf, *SOLD), 500)[0]))


def portfolio_kpis(spark, sf, points=GRID):
    out = report.portfolio_kpis(report.lift_report(solved(held(spark, sf, *SOLD), points)[0]))
    return out.select("city", *[r(c, 4) for c in out.columns if c != "city"])


def portfolio_kpis_full_grid(spark, sf):
    return portfolio_kpis(spark, sf, 500)


def weekend_premium(spark, sf, points=GRID):
    out = report.weekend_premium(report.lift_report(solved(held(spark, sf, *SOLD), points)[0]))
    return out.select("city", "best_segment", *[r(c, 5) for c in ("weekend_price", "weekday_price", "premium_pct", "best_lift_pct")])


def weekend_premium_full_grid(spark, sf):
    return weekend_premium(spark, sf, 500)


def business_summary(spark, sf):
    listed = held(spark, sf, *PROFILED)
    chosen = report.lift_report(solved(listed, 500)[0])
    return report.business_summary(chosen, market_properties(listed))


# --- models ----------------------------------------------------------------------------

def _prepared(spark, sf):
    """Prepared listings, elasticities, categories, and the names of the full feature set."""
    raw = held(spark, sf)
    fitted = encoding.fit_categories(segments.listing_features(raw), CATEGORIES)
    rows = elastic_rows(raw)
    listed = materialise(prepare_listings(raw, rows, categories=fitted)[0])
    return listed, rows, fitted, training.input_names(fitted)


def model_rows(spark, sf) -> tuple[DataFrame, DataFrame, list[str]]:
    """Train and test rows with assembled features, written once for repeated passes, and the features' names."""
    listed, _, _, names = _prepared(spark, sf)
    rows = materialise(cleaning.labelled(listed).select(KEY, "label", *names))
    train, test = splits.hash_split(rows, [KEY])
    return learning.assemble(train, names), learning.assemble(test, names), names


SCALED = ["listing_price", "quality_score", "price_per_person"]


def standardise(spark, sf):
    df = held_features(spark, sf, KEY, "person_capacity", *SUMMARY_INPUTS)
    out = learning.scaled_columns(learning.fit_scaler(df, SCALED).transform(df), SCALED)
    return out.select(KEY, *[r(f"{c}_scaled") for c in SCALED])


def linear_fit(spark, sf):
    rows = materialise(cleaning.labelled(clipped(spark, sf)).select("label", "listing_price", "n_bookings"))
    names = ["listing_price", "n_bookings"]
    model = learning.linear_model().fit(learning.assemble(rows, names, "features"))
    terms = [("intercept", float(model.intercept)), *zip(names, map(float, model.coefficients))]
    return spark.createDataFrame(terms, "term string, coefficient double").select("term", r("coefficient"))


def _guess(spark, sf) -> DataFrame:
    guess = F.lit(0.9) - F.lit(0.0004) * F.col("listing_price")
    return cleaning.labelled(clipped(spark, sf)).withColumn("prediction", guess)


def regression_metrics(spark, sf):
    return learning.regression_metrics(_guess(spark, sf), ["season"]).select("season", r("rmse"), r("mae"), r("r2"))


def log_scale_metrics(spark, sf):
    logs = _guess(spark, sf).withColumns({c: F.log1p(c) for c in ("label", "prediction")})
    return learning.log_scale_metrics(logs, ["season"]).select("season", r("rmse"), r("mae"), r("r2"), r("log_mse"))


def gbt_scores(spark, sf):
    train, test, names = model_rows(spark, sf)
    model = learning.fit_columns(learning.boosted_trees(), train, names)
    return learning.score(test.drop("features_unscaled"), model, names).select(KEY, "label", "predicted_occupancy")


def forest_scores(spark, sf):
    train, test, names = model_rows(spark, sf)
    model = learning.fit_held(learning.random_forest(), train)
    return learning.score(test.drop("features_unscaled"), model, names).select(KEY, "label", "predicted_occupancy")


def model_ranking(spark, sf):
    """Linear, boosted, forest and network models ranked on held-out listings."""
    listed, _, _, names = _prepared(spark, sf)
    networks = {"network": mlp.UNIFORM_PRESET, "network_he_normal": mlp.HE_NORMAL_PRESET}
    return training.train_models(listed, names, [KEY], networks=networks).ranking


def tree_importance(spark, sf):
    train, _, names = model_rows(spark, sf)
    return learning.tree_importance(spark, learning.fit_columns(learning.boosted_trees(), train, names), names)


def _network(spark, sf) -> tuple[DataFrame, mlp.Mlp]:
    """A network trained on standardised inputs, and the held-out rows."""
    listed, _, _, names = _prepared(spark, sf)
    train, test = splits.hash_split(materialise(cleaning.labelled(listed).select(KEY, "label", *names)), [KEY])
    numeric = [n for n in names if n in set(NUMERIC_FEATURES)]
    train, test = (p.fillna(0.0, numeric) for p in (train, test))
    scaler = learning.fit_scaler(train, numeric)
    train, test = (learning.scaled_columns(scaler.transform(p), numeric) for p in (train, test))
    inputs = [f"{n}_scaled" for n in numeric] + [n for n in names if n not in set(numeric)]
    return test.select(KEY, "label", *inputs), mlp.train_mlp(train, test, inputs, [KEY], settings=mlp.UNIFORM_PRESET)


def mlp_scores(spark, sf):
    test, model = _network(spark, sf)
    return mlp.predictions(mlp.network_rows(test, model.names, "label", [KEY]), model).select("key", "label", "prediction")


def gradient_importance(spark, sf):
    test, model = _network(spark, sf)
    return mlp.gradient_importance(mlp.network_rows(test, model.names, "label", [KEY]), model)


def weight_importance(spark, sf):
    _, model = _network(spark, sf)
    return mlp.weight_importance(mlp.weight_table(spark, model))


def permutation_importance(spark, sf):
    train, test, names = model_rows(spark, sf)
    model = learning.fit_columns(learning.boosted_trees(), train, names)
    rows = test.select("label", F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in names]).alias("features"))
    return importance.tree_permutation_importance(rows, names, model)


def prepared_listings(spark, sf):
    """Listings ready for training: features, one-hot seasons, no outliers, price elasticity."""
    fitted = {"season": {f"cat_season_{s}": [s] for s in ("high", "low", "shoulder")}}
    out, _ = prepare_listings(held(spark, sf, *PREPARED), categories=fitted)
    return out.select(
        KEY, *SEGMENT_COLS, "cat_season_high", "segment_listing_count", r("segment_avg_price"), r("price_per_bedroom", 9),
        r("price_vs_segment_median", 9), r("elasticity_slope"),
    )


def _pricing_inputs(spark, sf):
    """Prepared listings, elasticities, and a boosted model on the full feature set."""
    listed, rows, fitted, names = _prepared(spark, sf)
    model = learning.fit_columns(learning.boosted_trees(), cleaning.labelled(listed).select("label", *names), names)
    return listed, rows, model, names, fitted


def baseline_scores(spark, sf):
    return pricing.baseline_scores(*_pricing_inputs(spark, sf), "STANDARD")


def recommended_prices(spark, sf):
    """The whole way from listings to a price schedule, with a fitted demand model."""
    return pricing.price_markets(*_pricing_inputs(spark, sf), "STANDARD").schedule


# --- files -----------------------------------------------------------------------------


def _place(spark) -> str:
    return f"{shared_folder(spark)}/files-{uuid.uuid4().hex}"


def ingest_csv(spark, sf):
    """Listings written as a raw CSV, with spaced names and flags in words, and ingested again."""
    place = _place(spark)
    raw = listings(spark, sf).select(
        F.col(KEY).alias("Listing Key"), F.col("listing_price").alias("Listing Price"), F.col("room_type").alias("Room-Type"),
        _word("host_is_superhost").alias("Host Is Superhost"), (F.col("weekend") == 1).alias("weekend"), "multi",
        F.when(F.col("biz") == 1, "yes").otherwise("no").alias("biz"), F.col("days_booked").cast("int").alias("days_booked"),
        "season",
    )
    writers.write_csv(raw, f"{place}/csv")
    return ingest(spark, f"{place}/csv", f"{place}/table")


def elasticity_files(spark, sf):
    """Elasticity rows through both file formats: row lines, then nested documents."""
    place = _place(spark)
    writers.write_json_lines(elastic_rows(held(spark, sf, *SOLD)), f"{place}/rows")
    writers.write_elasticity(readers.read_elasticity_rows(spark, f"{place}/rows"), f"{place}/documents")
    return readers.read_elasticity_documents(spark, f"{place}/documents").select(
        *SEGMENT_COLS, "price_regime", r("elasticity_slope"), r("breakpoint_log_price")
    )


def segment_frame(spark, sf):
    return readers.segment_frame(listings(spark, sf).select("city").distinct())


def preview(spark, sf):
    place = _place(spark)
    writers.write_preview(market_size(spark, sf), place)
    return readers.read_listings_csv(spark, place)

"""Names of the registered queries."""

from __future__ import annotations

from lodgecurve.checks import queries as q
from lodgecurve.checks.oracle import ORACLE  # noqa: F401

_NAMES = """
clip_ranges clip_to_column clip_binary bool_flags tolerant_casts sanitize_categories segment_key_roundtrip
safe_fill label_rows market_filter
listing_features one_hot reverse_one_hot one_hot_apply
segment_stats segment_dataset iqr_bounds outlier_filter outlier_report competition_features column_profile
summary_table segment_breakdown avg_price_by_city_season market_size market_profile pricing_segment_stats
days_per_segment distinct_values price_deciles feature_dataset
price_bins segment_ols breakpoint_search slope_classes elasticity_json elasticity_flatten regime_lookup impute_slope
hash_split three_way_split chunk_split top_k hash_sample_topn random_topn season_order bernoulli_sample
representative_property price_grid reprice_features reprice_features_serving demand_curve annual_revenue
optimal_prices optimal_prices_full_grid solution_status lift_report price_schedule portfolio_kpis weekend_premium
solution_status_full_grid lift_report_full_grid portfolio_kpis_full_grid weekend_premium_full_grid business_summary
standardise linear_fit regression_metrics log_scale_metrics gbt_scores forest_scores model_ranking tree_importance
mlp_scores gradient_importance weight_importance permutation_importance baseline_scores recommended_prices
prepared_listings ingest_csv elasticity_files segment_frame preview
"""

QUERIES = {name: getattr(q, name) for name in _NAMES.split()}

from pyspark.sql import functions as F

from lodgecurve.checks.listings import listings
from lodgecurve.operators import encoding, learning, segments
from lodgecurve.plans import pricing, training
from lodgecurve.plans.features import CATEGORIES, prepare_listings, training_table


def test_from_listings_to_prices(spark, sf_dir):
    """Prepare, train and price two markets, and look for broken rules in the result."""
    raw = listings(spark, sf_dir).where(F.col("city").isin("nation_1", "nation_2")).withColumnRenamed("listing_key", "listing_id")
    fitted = encoding.fit_categories(segments.listing_features(raw), CATEGORIES)
    prepared, dataset = prepare_listings(raw, categories=fitted)
    assert dataset.count() == 12 and 0 < prepared.count() <= raw.count()
    assert not {"city", "season", "weekend", "capacity_bin", "room_type"} & set(training_table(prepared).columns)

    names = training.input_names(fitted)
    model = learning.boosted_trees(trees=3).fit(
        learning.assemble(learning.training_rows(prepared, keep=["listing_id"]).select("label", *names), names))
    rows = prepared.groupBy("city", "season", "weekend").agg(
        F.lit("all").alias("price_regime"), F.avg("elasticity_slope").alias("elasticity_slope"),
        F.lit(None).cast("double").alias("breakpoint_log_price"))
    result = pricing.price_markets(prepared, rows, model, names, fitted, "STANDARD", points=60)

    assert result.baseline.count() == 12 and result.candidates.count() == 12 * 60
    states = dict(map(tuple, result.status.collect()))
    assert set(states) == {"nation_1", "nation_2"} and "Optimal" in states.values()
    for city in (c for c, s in states.items() if s == "Optimal"):
        price = {(r["season"], r["weekend"]): r["optimal_price"] for r in result.report.where(F.col("city") == city).collect()}
        assert len(price) == 6
        for season in ("low", "shoulder", "high"):
            assert price[season, 1] >= 1.1 * price[season, 0]
        for lower, upper in (("low", "shoulder"), ("shoulder", "high")):
            assert all(price[upper, w] >= 1.05 * price[lower, w] for w in (0, 1))
    solved = sum(s == "Optimal" for s in states.values())
    assert result.schedule.count() == 6 * solved and result.summary.count() == solved

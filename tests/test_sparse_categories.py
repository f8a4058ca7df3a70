"""Categories as sparse vectors, from listings to prices."""

import pytest
from pyspark.sql import functions as F

from lodgecurve.checks.listings import listings
from lodgecurve.operators import encoding, learning, mlp, segments
from lodgecurve.plans import pricing, training
from lodgecurve.plans.features import CATEGORIES, prepare_listings


def slopes(prepared):
    return prepared.groupBy("city", "season", "weekend").agg(
        F.lit("all").alias("price_regime"), F.avg("elasticity_slope").alias("elasticity_slope"),
        F.lit(None).cast("double").alias("breakpoint_log_price"))


def test_vectors_name_their_places_and_leave_the_unknown_zero(spark, tmp_path):
    df = spark.createDataFrame([("b", "x"), ("a", None), ("a c", "x"), ("a_c", "__in_y")], "city string, kind string")
    fitted = encoding.fit_sparse_categories(df)
    assert fitted.columns == ["city", "kind"] and fitted.outputs == ["cat_city", "cat_kind"]
    fitted.save(f"{tmp_path}/categories")
    for one in (fitted, encoding.SparseCategories.load(f"{tmp_path}/categories")):
        rows = one.apply(df.unionByName(spark.createDataFrame([("new", "x"), (None, None)], df.schema)))
        assert rows.columns == ["city", "kind", "cat_city", "cat_kind"]
        assert [list(r.cat_city.toArray()) for r in rows.collect()] == [[0, 0, 0, 1], [1, 0, 0, 0], [0, 1, 0, 0], [0, 0, 1, 0], [0] * 4, [0] * 4]
        assert [list(r.cat_kind.toArray()) for r in rows.collect()] == [[0, 1], [0, 0], [0, 1], [1, 0], [0, 1], [0, 0]]
        names = learning.feature_names(rows, ["cat_kind", "cat_city"])
        assert names == ["cat_kind___in_y", "cat_kind_x", "cat_city_a", "cat_city_a c", "cat_city_a_c", "cat_city_b"]
        assert learning.vector_feature_names(learning.assemble(rows, ["cat_kind", "cat_city"]), "features_unscaled") == names
    lacking = encoding.apply_one_hot(df.drop("kind"), fitted, drop_originals=True)
    assert lacking.columns == ["cat_city", "cat_kind"] and all(r.cat_kind.numNonzeros() == 0 for r in lacking.collect())
    again = fitted.apply(fitted.apply(df))
    assert again.columns == ["city", "kind", "cat_city", "cat_kind"]


def test_tables_without_values(spark):
    empty = spark.createDataFrame([], "city string, n int")
    fitted = encoding.fit_sparse_categories(empty)
    assert fitted.outputs == [] and fitted.apply(empty).columns == ["city", "n"]
    assert encoding.fit_sparse_categories(empty.select("n")).outputs == []
    unnamed = spark.createDataFrame([(1.0,)], "a double")
    vector = learning.assemble(unnamed, ["a"]).withMetadata("features_unscaled", {})
    with pytest.raises(ValueError, match="name"):
        learning.feature_names(vector, ["features_unscaled"])


def test_vectors_predict_what_columns_predict(spark, sf_dir):
    raw = listings(spark, sf_dir).where(F.col("city").isin("nation_1", "nation_2")).withColumnRenamed("listing_key", "listing_id")
    listed = segments.listing_features(raw)
    wide, sparse = encoding.fit_categories(listed, CATEGORIES), encoding.fit_sparse_categories(listed, CATEGORIES)
    settings = mlp.MlpSettings(hidden=(4,), dropout=(0.0,), max_epochs=2, chunks=1, batch_size=64)
    found = {}
    for kind, fitted in (("wide", wide), ("sparse", sparse)):
        prepared, _ = prepare_listings(raw, categories=fitted)
        names = training.input_names(fitted)
        trained = training.train_models(prepared, names, ["listing_id"], trees=3, networks={"network": settings})
        found[kind] = {r.model: r.rmse for r in trained.ranking.collect()}
        ranked = learning.tree_importance(spark, trained.models["boosted_trees"], trained.features)
        found[f"{kind} inputs"] = ranked.count()
        scores = pricing.baseline_scores(prepared, slopes(prepared), trained.models["network"], names, fitted, "STANDARD")
        assert scores.where(F.col("baseline_occupancy").between(0, 1)).count() == scores.count() == 12
        trained.release()
    assert found["wide inputs"] == found["sparse inputs"] == len(training.input_names(wide))
    for family in ("linear", "boosted_trees"):
        assert found["sparse"][family] == pytest.approx(found["wide"][family], rel=1e-3)


def test_thousands_of_cities_are_trained_and_priced(spark, sf_dir):
    raw = listings(spark, sf_dir).withColumnRenamed("listing_key", "listing_id")
    raw = raw.withColumn("city", F.concat(F.lit("town "), F.pmod(F.xxhash64("listing_id"), F.lit(40_000)).cast("string")))
    listed = segments.listing_features(raw)
    cities = raw.select("city").distinct().count()
    assert cities > 5000
    with pytest.raises(ValueError):
        encoding.fit_categories(listed, CATEGORIES)
    fitted = encoding.fit_sparse_categories(listed, CATEGORIES)
    prepared, _ = prepare_listings(raw, categories=fitted)
    assert len(prepared.columns) < 100
    names = training.input_names(fitted)
    train = learning.assemble(learning.training_rows(prepared).select("label", *names), names)
    assert len(learning.vector_feature_names(train, "features_unscaled")) > 5000
    model = learning.linear_model("features_unscaled").setSolver("l-bfgs").setMaxIter(5).fit(train)
    result = pricing.price_markets(prepared, slopes(prepared), model, names, fitted, "STANDARD", points=10)
    assert result.baseline.where(F.col("baseline_occupancy").between(0, 1)).count() == result.baseline.count() > 5000
    assert result.status.count() == prepared.select("city").distinct().count()

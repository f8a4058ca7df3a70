import math

import pytest
from pyspark.sql import functions as F

from lodgecurve import schemas
from lodgecurve.functions import values as V
from lodgecurve.operators import cleaning, encoding, segments

NAN = float("nan")


def column(df, name):
    return [r[name] for r in df.collect()]


def test_clip_keeps_null_and_sends_nan_to_the_upper_bound(spark):
    df = spark.createDataFrame([(v,) for v in (None, NAN, -1.0, 5.0, 10.0, 1e6)], "listing_price double")
    once = cleaning.clip_ranges(df)
    assert column(once, "listing_price") == [None, 10000.0, 10.0, 10.0, 10.0, 10000.0]
    assert column(cleaning.clip_ranges(once), "listing_price") == column(once, "listing_price")


def test_clip_to_column_uses_the_clipped_bound(spark):
    df = spark.createDataFrame([(400.0, 500.0), (10.0, -3.0), (None, 7.0)], "days_in_period double, days_booked double")
    assert column(cleaning.clip_listings(df), "days_booked") == [365.0, 0.0, 7.0]


def test_flags(spark):
    words = ["TRUE", "t", "Yes", "0", "n", "maybe", None]
    df = spark.createDataFrame([(w,) for w in words], "weekend string")
    assert column(cleaning.to_flags(df), "weekend") == [1, 1, 1, 0, 0, None, None]
    assert column(cleaning.to_flags(spark.createDataFrame([(True,), (None,)], "weekend boolean")), "weekend") == [1, None]


def test_ints_from_text_and_numbers(spark):
    df = spark.createDataFrame([("1", 2.0), ("yes", 1.0), ("2", None), ("x", 0.0)], "multi string, biz double")
    out = cleaning.to_ints(df)
    assert column(out, "multi") == [1, 1, 2, None]
    assert column(out, "biz") == [2, 1, None, 0]


def test_clean_listings_end_to_end(spark):
    df = spark.createDataFrame([("12.5", "true", "abc", True)], "`Listing Price` string, `Weekend?` string, Bedrooms string, multi boolean")
    assert cleaning.clean_listings(df).first().asDict() == {"listing_price": 12.5, "weekend": 1, "bedrooms": None, "multi": 1}


def test_colliding_names_raise(spark):
    with pytest.raises(ValueError, match="a_b"):
        cleaning.snake_case_columns(spark.range(1).select(F.lit(1).alias("a b"), F.lit(2).alias("A-B")))


def test_safe_category(spark):
    df = spark.createDataFrame([(v,) for v in (" A b ", "a-B", "5+", "", "++", None)], "v string")
    assert column(df.select(V.safe_category(F.col("v")).alias("v")), "v") == ["a_b", "a_b", "5", "unknown", "unknown", "unknown"]


def test_segment_keys(spark):
    keys = ["new_york_high_season_weekend", "paris_low_season_weekday", "too_short", "a_b_c"]
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    parts = V.parse_segment_key(F.col("k"))
    rows = [tuple(r) for r in df.select(parts["city"], parts["season"], parts["weekend"]).collect()]
    assert rows == [("new_york", "high", 1), ("paris", "low", 0), (None, None, None), (None, None, None)]


def test_finite_or(spark):
    df = spark.createDataFrame([(v,) for v in ("1.5", "x", None, "NaN", "Infinity", "-Infinity")], "v string")
    assert column(df.select(V.finite_or(F.col("v"), 9).alias("v")), "v") == [1.5, 9.0, 9.0, 9.0, 9.0, 9.0]


def test_column_roles(spark):
    df = spark.range(1).select(F.lit(1.0).alias("realsum"), F.lit(2.0).alias("metro_dist"), F.lit("x").alias("city"))
    assert schemas.price_column(df) == "realsum" and schemas.distance_column(df) == "metro_dist"
    assert schemas.string_columns(df) == ["city"] and schemas.segment_columns(df) == ["city"]
    with pytest.raises(ValueError, match="season"):
        schemas.require_columns(df, ["city", "season"])
    with pytest.raises(ValueError, match="price"):
        schemas.price_column(df.drop("realsum"))


def test_labels_and_selection(spark):
    df = spark.createDataFrame([(0.5, True), (None, False)], "occupancy_rate double, flag boolean")
    out = cleaning.booleans_to_ints(cleaning.labelled(df))
    assert [tuple(r) for r in out.collect()] == [(0.5, 1, 0.5)]
    assert cleaning.drop_present(df, "flag", "nothing").columns == ["occupancy_rate"]
    assert cleaning.select_present(df, "nothing", "flag").columns == ["flag"]


def test_listing_features_with_gaps(spark):
    df = spark.createDataFrame(
        [(100.0, None, 0.0, None, 9.0, -0.1), (50.0, 2.5, 3.0, 80.0, None, 2.0), (80.0, 4.0, 2.0, 90.0, 9.0, None)],
        "listing_price double, person_capacity double, bedrooms double, guest_satisfaction_overall double, "
        "cleanliness_rating double, city_center_dist double",
    )
    a, b, c = segments.listing_features(df).collect()
    assert a["price_per_person"] == 100.0 and a["price_per_bedroom"] == 100.0 and a["capacity_bin"] == "5+"
    assert a["quality_score"] == 0.0 and a["price_per_dist_km"] is None and a["price_x_satisfaction"] is None
    assert b["capacity_bin"] == "5+" and b["quality_score"] == 0.0
    assert c["capacity_bin"] == "4" and math.isclose(c["quality_score"], 47.7)


def test_one_hot_merges_equal_names_and_ignores_null(spark):
    df = spark.createDataFrame([("A b",), ("a-B",), ("5+",), (None,)], "room_type string")
    out = encoding.one_hot(df)
    assert [tuple(r) for r in out.collect()] == [("A b", 0, 1), ("a-B", 0, 1), ("5+", 1, 0), (None, 0, 0)]
    assert out.columns == ["room_type", "cat_room_type_5", "cat_room_type_a_b"]
    with pytest.raises(ValueError, match="more than 2"):
        encoding.fit_categories(df, max_categories=2)


def test_one_hot_round_trip_and_unseen(spark):
    train = spark.createDataFrame([("x", "s"), ("y", "t")], "city string, season string")
    fitted = encoding.load_categories(encoding.categories_frame(spark, encoding.fit_categories(train)))
    other = spark.createDataFrame([("y",), ("z",)], "city string")
    out = encoding.apply_one_hot(other, fitted, drop_originals=True)
    assert [r.asDict() for r in out.collect()] == [
        {"cat_city_x": 0, "cat_city_y": 1, "cat_season_s": 0, "cat_season_t": 0},
        {"cat_city_x": 0, "cat_city_y": 0, "cat_season_s": 0, "cat_season_t": 0},
    ]
    assert column(encoding.reverse_one_hot(out, "city"), "city") == ["y", None]


def test_names_agree_and_null_key_parts_count(spark):
    for text in ("--", "", "A b", " Éa-B ", "5+", "x__y"):
        df = spark.createDataFrame([(text,)], "t string")
        assert df.select(V.safe_category(F.col("t"))).first()[0] == V.category_suffix(text) != ""
    rows = spark.createDataFrame([("a", None, "b"), ("a", "b", None), (None, "a", "b")], "x string, y string, z string")
    assert rows.select(V.hash_number(F.col("x"), F.col("y"), F.col("z"))).distinct().count() == 3

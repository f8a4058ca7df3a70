"""Merged segment statistics against exact ones."""

import os
import random

import pytest

from lodgecurve.operators import segments, sketches

SCHEMA = "day string, city string, season string, weekend int, listing_price double"


def listed():
    r = random.Random(2)
    rows = []
    for day in ("d1", "d2", "d3"):
        for city, n in (("a", 3000), ("b", 40), ("c", 1)):
            rows += [(day, city, "high", w, r.lognormvariate(4.5, 0.6)) for w in (0, 1) for _ in range(n)]
    return rows + [("d1", "a", "high", 0, None), ("d2", "a", "high", 0, float("nan")), ("d3", "void", "low", 1, None)]


def test_merged_statistics_equal_exact_ones(spark, tmp_path):
    rows = listed()
    df = spark.createDataFrame(rows, SCHEMA)
    path = f"{tmp_path}/stats"
    for day in ("d1", "d2"):
        sketches.add_part(df.where(df.day == day), path, day)
    before = {f: os.path.getmtime(f"{path}/part=d1/{f}") for f in os.listdir(f"{path}/part=d1")}
    sketches.add_part(df.where(df.day == "d3"), path, "d3")
    sketches.add_part(df.where(df.day == "d3"), path, "d3")  # once more replaces it
    assert before == {f: os.path.getmtime(f"{path}/part=d1/{f}") for f in os.listdir(f"{path}/part=d1")}
    got = {(r.city, r.weekend): r for r in sketches.merged_stats(spark.read.parquet(path)).collect()}
    plain = [x for x in rows if x[4] is not None and x[4] == x[4]]
    exact = {(r.city, r.weekend): r for r in segments.segment_stats(spark.createDataFrame(plain, SCHEMA)).collect()}
    for key, want in exact.items():
        prices = sorted(x[4] for x in plain if (x[1], x[3]) == key)
        assert got[key].segment_avg_price == pytest.approx(want.segment_avg_price, rel=1e-9)
        assert got[key].segment_price_std == pytest.approx(want.segment_price_std, rel=1e-9)
        for p, found in ((0.5, got[key].segment_median_price), (0.9, got[key].segment_p90_price), (0.1, got[key].segment_p10_price)):
            below, upto = sum(x < found for x in prices), sum(x <= found for x in prices)
            slack = 0.015 * len(prices) + 1
            assert found in prices and below - slack <= p * len(prices) <= upto + slack
    assert got["a", 0].segment_listing_count == 9002
    assert tuple(got["void", 1])[:5] == ("void", "low", 1, 1, None) and got["void", 1].segment_median_price is None


def test_empty_parts_and_names(spark, tmp_path):
    empty = spark.createDataFrame([], SCHEMA)
    sketches.add_part(empty, f"{tmp_path}/t", "d0")
    assert sketches.merged_stats(spark.read.parquet(f"{tmp_path}/t")).count() == 0
    with pytest.raises(ValueError):
        sketches.add_part(empty, f"{tmp_path}/t", "a/b")

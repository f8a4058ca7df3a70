"""Quantiles and price bins by cells: right for odd values, and few rows are counted by value."""

import math
import random

import pytest
from pyspark.sql import functions as F

from lodgecurve.checks.listings import listings
from lodgecurve.operators import elasticity, scale
from lodgecurve.plans import features


@pytest.fixture(scope="module")
def priced(spark):
    rng = random.Random(11)
    rows = [(k, rng.lognormvariate(5, 0.7), rng.random()) for _ in range(9000) for k in ["a"]]
    rows += [(None, float(rng.randint(20, 24)), rng.random()) for _ in range(500)]
    rows += [("b", p, 0.5) for p in (0.0, -0.0, -0.5, 3.0, 1e-9, float("inf"), None)] + [("a", 50.0, None)]
    return spark.createDataFrame(rows, "k string, listing_price double, occupancy_rate double").repartition(4)


def test_few_rows_are_told_apart(spark, priced):
    known = priced.where("k = 'a' and occupancy_rate is not null")
    cells = scale.materialise(scale.cell_counts(known, ["k"], "listing_price"))
    holding = cells.where((F.col("below") < 4500) & (F.col("below") + F.col("__n") >= 4500))
    found = scale.open_cells(known, holding, ["k"], "listing_price").collect()
    assert 1 < len(found) < 200
    median = sorted(r[0] for r in known.select("listing_price").collect())[4499]
    assert [r["listing_price"] for r in found if r["below"] == 4499] == [median]


def test_quantiles_leave_only_open_cells_to_count(spark, priced):
    """The plan that remains counts no rows of cells without a quantile, and none at all where values are few."""
    few = priced.where("k is null")
    plan = lambda df: scale.aggregate_with_quantiles(df, ["k"], [], {"m": ("listing_price", 0.5)})._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan(few)
    assert "LeftSemi" in plan(priced)


def test_bins_match_ranks(spark, priced):
    found = {(r["k"], r["bin"]): r for r in elasticity.price_bins(priced, ["k"]).collect()}
    for k in ("a", None):
        rows = sorted((r[1], r[2]) for r in priced.collect() if r[0] == k and None not in r[1:])
        mean = {p: sum(o for q, o in rows if q == p) / sum(q == p for q, _ in rows) for p in ({p for p, _ in rows} if k is None else ())}
        short, longer = divmod(len(rows), 20)
        start = 0
        for b in range(1, 21):
            mine = rows[start : (start := start + short + (b <= longer))]
            got = found[k, b]
            assert got["n"] == len(mine)
            assert got["x"] == pytest.approx(sum(math.log1p(p) for p, _ in mine) / len(mine), rel=1e-12)
            assert got["mean_occupancy"] == pytest.approx(sum(mean.get(p, o) for p, o in mine) / len(mine), rel=1e-12)
    assert sum(r["n"] for (k, _), r in found.items() if k == "b") == 6


def test_slopes_are_filled_where_some_are_known(spark):
    rows = [("a", "low", 0, 1.0), ("a", "low", 0, 3.0), ("a", "low", 0, None), ("a", "high", 0, 5.0), ("b", "low", 1, None), (None, "low", 1, None), (None, "low", 1, 2.0)]
    df = spark.createDataFrame(rows, "city string, season string, weekend int, elasticity_slope double")
    out = elasticity.impute_slope(df)
    assert out.columns == df.columns
    want = [2.0 if r == ("a", "low", 0, None) else r[3] for r in rows]
    assert sorted(str(r[3]) for r in out.collect()) == sorted(map(str, want))
    whole = df.where("elasticity_slope is not null")
    assert "Join" not in elasticity.impute_slope(whole)._jdf.queryExecution().optimizedPlan().toString()


def test_preparation_writes_no_copy_of_the_listings(spark, monkeypatch):
    rng = random.Random(3)
    rows = [("a", "low", i % 2, rng.lognormvariate(5, 0.5), 2.0, rng.random(), f"{i}") for i in range(400)]
    raw = spark.createDataFrame(rows, "city string, season string, weekend int, listing_price double, bedrooms double, occupancy_rate double, id string")
    written = []
    monkeypatch.setattr(features, "materialise", lambda df: written.append(df.columns) or scale.materialise(df))
    out, _ = features.prepare_listings(raw, categories={})
    assert out.where("elasticity_slope is null").count() == 0 and "id" in out.columns
    assert not any("id" in columns for columns in written)


def test_segments_with_part_of_their_slopes_are_filled(spark):
    rows = [("a", "low", 0, "low", -0.2, 5.0), ("a", "high", 0, "low", -0.1, 5.0), ("a", "high", 0, "high", -0.3, 5.0), ("b", "low", 0, "all", -0.5, None)]
    known = spark.createDataFrame(rows, "city string, season string, weekend int, price_regime string, elasticity_slope double, breakpoint_log_price double")
    assert [tuple(r) for r in elasticity.partly_known(known).collect()] == [("a", "low", 0)]
    raw = spark.createDataFrame(
        [(c, s, 0, float(p), 1.0, 0.5) for c, s in (("a", "low"), ("a", "high"), ("b", "low"), ("c", "low")) for p in (100, 120, 160, 180)],
        "city string, season string, weekend int, listing_price double, bedrooms double, occupancy_rate double",
    )
    out, _ = features.prepare_listings(raw, known, categories={})
    found = {(r["city"], r["season"], r["listing_price"]): r["elasticity_slope"] for r in out.collect()}
    want = {("a", "low"): [-0.2] * 4, ("a", "high"): [-0.1, -0.1, -0.3, -0.3], ("b", "low"): [-0.5] * 4, ("c", "low"): [None] * 4}
    assert found == {(*k, p): x for k, v in want.items() for p, x in zip((100.0, 120.0, 160.0, 180.0), v)}


def tables(spark, folder):
    """Two orders of one customer and one of nobody known, with repeated and missing keys."""
    day = F.to_timestamp(F.lit("2020-07-04"))
    save = lambda df, name: df.write.parquet(f"{folder}/{name}.parquet")
    lines = [(1, 1), (1, 2), (2, 1), (2, 9), (3, 1), (None, 1), (4, 1)]
    save(spark.createDataFrame(lines, "l_orderkey bigint, l_partkey bigint").select(
        "*", F.lit(1).alias("l_linenumber"), *[F.lit(5.0).alias(f"l_{c}") for c in ("quantity", "extendedprice", "discount", "tax")],
        F.lit("R").alias("l_returnflag"), F.lit("O").alias("l_linestatus")), "lineitem")
    orders = spark.createDataFrame([(1, 7), (2, 7), (2, 7), (3, 8), (None, 7), (4, None)], "o_orderkey bigint, o_custkey bigint")
    save(orders.select("*", day.alias("o_orderdate"), F.lit("P").alias("o_orderstatus")), "orders")
    save(spark.createDataFrame([(7, 1), (None, 1)], "c_custkey bigint, c_nationkey int"), "customer")
    save(spark.createDataFrame([(1, "N1"), (2, "N2")], "n_nationkey int, n_name string"), "nation")
    save(spark.createDataFrame([(1, "T", 3), (2, "T", 4)], "p_partkey bigint, p_type string, p_size int"), "part")


def test_large_orders_meet_customers_before_lines(spark, tmp_path):
    tables(spark, tmp_path)
    small = sorted(map(tuple, listings(spark, str(tmp_path)).collect()))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100")
    try:
        df = listings(spark, str(tmp_path))
        plan = df._jdf.queryExecution().optimizedPlan().toString().splitlines()
        depth = lambda text: next(line.index("Join") for line in plan if "Join" in line and text in line)
        assert depth("(o_custkey") > depth("(l_orderkey")
        assert sorted(map(tuple, df.collect())) == small
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(small) == 4

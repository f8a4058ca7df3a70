import math
import random

import pytest
from pyspark.sql import functions as F

from lodgecurve.operators import elasticity, scale, segments


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of all rows share one key and one value; NULL keys and odd numbers appear."""
    rng = random.Random(7)
    rows = []
    for i in range(6000):
        if i % 3 == 0:
            rows.append(("hot", 100.0, 0.5))
            continue
        key = rng.choice(["hot", "a", "b", None])
        value = rng.choice([rng.lognormvariate(4, 2), float(rng.randint(1, 50)), None, float("nan") if i % 97 == 0 else 3.0])
        rows.append((key, value, rng.random()))
    return spark.createDataFrame(rows, "k string, v double, w double").repartition(4)


QUANTILES = {"p10": ("v", 0.1), "p50": ("v", 0.5), "p90": ("v", 0.9), "w25": ("w", 0.25)}


def expected(rows, column, p):
    known = sorted((r[column] for r in rows if r[column] is not None), key=lambda x: (math.isnan(x), x))
    return known[max(1, math.ceil(p * len(known))) - 1]


def test_quantiles_match_sorting(spark, skewed):
    by_key = {}
    for r in skewed.collect():
        by_key.setdefault(r["k"], []).append(r)
    out = scale.aggregate_with_quantiles(skewed, ["k"], [F.count(F.lit(1)).alias("n")], QUANTILES)
    found = {r["k"]: r for r in out.collect()}
    assert set(found) == set(by_key)
    for k, rows in by_key.items():
        assert found[k]["n"] == len(rows)
        for name, (c, p) in QUANTILES.items():
            assert str(found[k][name]) == str(expected(rows, c, p)), (k, name)


def test_quantiles_without_keys(spark, skewed):
    out = scale.aggregate_with_quantiles(skewed, [], [F.count("w").alias("n")], {"m": ("w", 0.5)}).first()
    assert out["n"] == 6000 and out["m"] == expected(skewed.collect(), "w", 0.5)


@pytest.mark.parametrize("limit", [10**9, 0])
@pytest.mark.parametrize("how", ["left", "inner"])
def test_join_measured_is_a_join(spark, skewed, limit, how):
    right = spark.createDataFrame([("hot", 1), ("a", 2), (None, 3)], "k string, x int")
    out = scale.join_measured(skewed, right, ["k"], how, null_safe=True, limit=limit)
    counts = {(r["k"], r["x"]): r["count"] for r in out.groupBy("k", "x").count().collect()}
    sizes = {r["k"]: r["count"] for r in skewed.groupBy("k").count().collect()}
    want = {("hot", 1): sizes["hot"], ("a", 2): sizes["a"], (None, 3): sizes[None]}
    assert counts == (want | {("b", None): sizes["b"]} if how == "left" else want)


def dealt(rows, bins):
    """Brute force: replace each price's occupancies by their mean, sort, cut into equal bins."""
    rows = sorted(rows)
    mean = {}
    for p, o in rows:
        mean.setdefault(p, []).append(o)
    flat = [(p, sum(mean[p]) / len(mean[p])) for p, _ in rows]
    out, at = [], 0
    for b in range(bins):
        size = len(flat) // bins + (b < len(flat) % bins)
        part = flat[at : at + size]
        at += size
        if part:
            out.append((b + 1, size, sum(math.log1p(p) for p, _ in part) / size, sum(o for _, o in part) / size))
    return out


def test_price_bins_match_brute_force(spark):
    rng = random.Random(3)
    rows = [("hot", 100.0 if i % 3 == 0 else float(rng.randint(20, 400)), round(rng.random(), 3)) for i in range(1003)]
    rows += [("tiny", float(i), 0.5) for i in range(1, 8)] + [("same", 50.0, i / 100) for i in range(1, 64)]
    rows += [("hot", None, 0.3), ("hot", 10.0, None)]
    df = spark.createDataFrame(rows, "k string, listing_price double, occupancy_rate double")
    out = elasticity.price_bins(df, ["k"])
    for k in ("hot", "tiny", "same"):
        found = sorted(tuple(r) for r in out.where(F.col("k") == k).select("bin", "n", "x", "mean_occupancy").collect())
        want = dealt([(p, o) for key, p, o in rows if key == k and p is not None and o is not None], 20)
        assert [f[:2] for f in found] == [w[:2] for w in want]
        for f, w in zip(found, want):
            assert f[2:] == pytest.approx(w[2:], rel=1e-9)


def test_single_row_segment_and_empty_input(spark):
    df = spark.createDataFrame([("a", "high", 1, 50.0)], "city string, season string, weekend int, listing_price double")
    row = segments.segment_stats(df).first()
    assert row["segment_price_std"] is None and row["segment_median_price"] == 50.0 and row["segment_price_spread"] == 0.0
    empty = df.limit(0)
    assert segments.segment_stats(empty).count() == 0
    assert segments.competition_features(empty).count() == 0
    report = segments.removal_report(empty.withColumn("is_inlier", F.lit(True))).first()
    assert tuple(report) == (0, 0, 0, None)


def test_results_do_not_depend_on_partitioning(spark, skewed):
    df = skewed.select(
        F.coalesce("k", F.lit("z")).alias("city"), F.lit("low").alias("season"), F.lit(0).alias("weekend"),
        F.col("v").alias("listing_price"),
    ).where("listing_price < 1e9")
    one = segments.segment_stats(df.repartition(1)).drop("segment_avg_price", "segment_price_std").collect()
    many = segments.segment_stats(df.repartition(7, "listing_price")).drop("segment_avg_price", "segment_price_std").collect()
    assert sorted(one) == sorted(many)


def test_outliers_drop_unknown_values(spark):
    rows = [("a", "low", 0, float(v)) for v in (10, 11, 12, 13, 14, 200)] + [("a", "low", 0, None)]
    df = spark.createDataFrame(rows, "city string, season string, weekend int, price_per_bedroom double")
    kept = sorted(r["price_per_bedroom"] for r in segments.remove_outliers(df).collect())
    assert kept == [10.0, 11.0, 12.0, 13.0, 14.0]


def test_approximate_quantiles_stay_close(spark, skewed):
    exact = scale.aggregate_with_quantiles(skewed, ["k"], [], {"m": ("w", 0.5)})
    rough = scale.aggregate_with_quantiles(skewed, ["k"], [], {"m": ("w", 0.5)}, approx=True)
    a, b = ({r["k"]: r["m"] for r in df.collect()} for df in (exact, rough))
    assert a == pytest.approx(b, abs=0.02)


@pytest.mark.parametrize("kind", ["bigint", "decimal(38,4)", "double", "int", "float"])
def test_quantiles_keep_type_and_value(spark, kind):
    big = 2**53 if kind in ("bigint", "decimal(38,4)") else 1000
    values = [big + i for i in range(-40, 41)] * 3 + [-5, 0, 0, 7, -big]
    df = spark.createDataFrame([("hot" if i % 3 else "b", v) for i, v in enumerate(values)], "k string, v bigint").withColumn("v", F.col("v").cast(kind))
    out = scale.aggregate_with_quantiles(df, ["k"], [], {"m": ("v", 0.5), "lo": ("v", 0.02), "hi": ("v", 1.0)})
    assert [t for c, t in out.dtypes if c != "k"] == [kind] * 3
    for r in out.collect():
        mine = sorted(v for i, v in enumerate(values) if (i % 3 > 0) == (r["k"] == "hot"))
        assert [int(r[c]) for c in ("m", "lo", "hi")] == [mine[max(1, math.ceil(p * len(mine))) - 1] for p in (0.5, 0.02, 1.0)]


def test_cells_rise_with_values(spark):
    values = sorted([random.Random(i).uniform(-1, 1) * 10 ** random.Random(-i).randint(-300, 300) for i in range(500)] + [0.0, -0.0, 1.0, 2.0, -1.0])
    rows = [(float(v),) for v in [float("-inf"), *values, float("inf"), float("nan")]]
    cells = [r["c"] for r in spark.createDataFrame(rows, "v double").coalesce(1).select(scale.value_cell(F.col("v")).alias("c")).collect()]
    assert cells == sorted(cells)


def test_hot_groups_spread_over_tasks(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        groups = spark.range(20000).select(F.lit("hot").alias("k"), (F.col("id") + 1).alias("v"), F.lit(1).alias("n"))
        tasks = scale.running_counts(groups, ["k"], "v", "n").groupBy(F.spark_partition_id()).count().collect()
        assert len(tasks) >= 3 and max(r["count"] for r in tasks) < 15000
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_scratch_tables_go(spark):
    with scale.scratch(spark):
        kept = scale.materialise(spark.range(5))
        path = kept.inputFiles()[0]
        assert kept.count() == 5
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        spark.read.parquet(path).count()

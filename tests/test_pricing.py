import itertools
import json
import math
import tracemalloc
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodgecurve.operators import demand, optimize, report
from lodgecurve.operators.optimize import PriceRules

# A published market. Segment, baseline price and occupancy, days, upper slope, and the
# published optimum: grid index, price, occupancy, yearly revenue, rounded changes and slope.
PUBLISHED = [
    ("high", 0, 120.73, 0.8598, 87.0, -0.6226143915707947, 401, 157.38, 0.6973, 9547.61, 30.4, -18.9, 5.7, -0.623),
    ("high", 1, 142.96, 0.8661, 36.0, -0.478622638494042, 499, 214.44, 0.6588, 5085.92, 50.0, -23.9, 14.1, -0.479),
    ("shoulder", 0, 98.94, 0.751, 108.0, -0.83495695660677, 299, 108.76, 0.6888, 8090.06, 9.9, -8.3, 0.8, -0.835),
    ("shoulder", 1, 117.29, 0.7792, 44.0, -0.7157006214231562, 349, 140.68, 0.668, 4134.75, 19.9, -14.3, 2.8, -0.716),
    ("low", 0, 80.98, 0.5767, 66.0, -0.952609758302235, 262, 83.01, 0.5629, 3083.93, 2.5, -2.4, 0.1, -0.953),
    ("low", 1, 95.77, 0.6955, 24.0, -0.8017170202539985, 311, 107.58, 0.6268, 1618.22, 12.3, -9.9, 1.2, -0.802),
]
PUBLISHED_TOTALS = {
    "baseline_annual_revenue": 30215.02, "annual_revenue": 31560.50, "revenue_lift_pct": 4.453,
    "baseline_weighted_price": 107.23, "optimal_weighted_price": 129.89,
    "baseline_avg_occupancy": 0.7547, "optimal_avg_occupancy": 0.6504,
}


@pytest.fixture(scope="module")
def published(spark):
    rows = [("paris", s, w, p, o, d, e, None, None, None) for s, w, p, o, d, e, *_ in PUBLISHED]
    base = spark.createDataFrame(
        rows, "city string, season string, weekend int, baseline_price double, baseline_occupancy double, "
        "days_in_segment double, slope_all double, slope_low double, slope_high double, breakpoint_log_price double")
    chosen, status = optimize.optimal_prices(demand.annual_revenue(demand.demand_curve(base)))
    assert [tuple(r) for r in status.collect()] == [("paris", "Optimal")]
    return report.lift_report(chosen).persist()


def test_published_prices(published):
    rows = report.price_schedule(published).collect()
    assert [(r["season"], r["weekend"]) for r in rows] == [(p[0], p[1]) for p in PUBLISHED]
    index = {(r["season"], r["weekend"]): r["grid_index"] for r in published.collect()}
    for row, (s, w, p0, o0, days, _, i, price, occ, revenue, dp, do, lift, slope) in zip(rows, PUBLISHED):
        assert index[s, w] == i
        assert row["optimal_price"] == pytest.approx(price, abs=0.02)
        assert row["predicted_occupancy"] == pytest.approx(occ, abs=2e-4)
        assert row["annual_revenue"] == pytest.approx(revenue, abs=1.0)
        assert (row["price_change_pct"], row["elasticity_slope"]) == (dp, slope)
        assert row["occupancy_change_pct"] == pytest.approx(do, abs=0.11) and row["revenue_lift_pct"] == pytest.approx(lift, abs=0.11)
        assert (row["baseline_price"], row["baseline_occupancy"], row["days_in_segment"]) == (p0, o0, days)


def test_published_totals(published):
    kpis = report.portfolio_kpis(published).first()
    for name, value in PUBLISHED_TOTALS.items():
        assert kpis[name] == pytest.approx(value, rel=2e-4), name
    weekend = report.weekend_premium(published).first()
    assert weekend["best_segment"] == "high_season_weekend"
    assert (round(weekend["weekend_price"], 2), round(weekend["premium_pct"], 1)) == (154.23, 32.5)


def test_business_summary(spark, published):
    home = spark.createDataFrame(
        [("paris", 2.0, 1.0, 9.0, 94.0, "Entire home/apt", 1)],
        "city string, person_capacity double, bedrooms double, cleanliness_rating double, "
        "guest_satisfaction_overall double, room_type string, host_is_superhost int")
    doc = json.loads(report.business_summary(published, home).first()["summary"])
    assert doc["property_profile"] == {
        "capacity": 2, "bedrooms": 1, "cleanliness_rating": 9.0, "guest_satisfaction": 94.0,
        "room_type": "Entire home/apt", "superhost": True}
    advice = doc["pricing_recommendations"]
    assert [a["segment"] for a in advice] == [f"{s}_season_{'weekend' if w else 'weekday'}" for s, w, *_ in PUBLISHED]
    assert advice[0]["price_change_vs_baseline"] == "+30.4%" and advice[0]["expected_occupancy"] == "69.7%"
    assert doc["optimization_constraints"] == {
        "price_range_tested": "±50%", "min_occupancy_threshold": "50%", "weekend_premium": "110%",
        "portfolio_price_change_limit": "±50%"}
    assert doc["revenue_lift"]["percentage"] == pytest.approx(4.453, abs=0.002)
    assert doc["insights"]["best_segment"] == "high_season_weekend"
    assert doc["insights"]["yearly_revenue_gained"] == doc["revenue_lift"]["absolute"]


SLOTS = [("low", 0), ("low", 1), ("shoulder", 0), ("shoulder", 1), ("high", 0), ("high", 1)]


def brute_force(market, rules):
    """Best total over all combinations of allowed prices, or None."""
    options = []
    for slot in SLOTS:
        options.append([(p, r) for p, o, r in market[slot] if rules.min_price <= p <= rules.max_price and o >= rules.min_occupancy])
    best = None
    for combo in itertools.product(*options):
        (a, _), (b, _), (c, _), (d, _), (e, _), (f, _) = combo
        if b < rules.weekend_premium * a or d < rules.weekend_premium * c or f < rules.weekend_premium * e:
            continue
        if c < rules.season_gap * a or e < rules.season_gap * c or d < rules.season_gap * b or f < rules.season_gap * d:
            continue
        total = sum(r for _, r in combo)
        best = total if best is None else max(best, total)
    return best


def test_optimum_matches_brute_force(spark):
    rng = random.Random(11)
    rules = PriceRules(min_occupancy=0.3, max_portfolio_change=10.0)
    markets, rows = {}, []
    for m in range(6):
        market = {}
        for slot in SLOTS:
            base = rng.uniform(90, 110)
            prices = [base * (0.5 + i / 6) for i in range(7)]
            occupancy = [rng.uniform(0.2, 1.0) if m != 5 else 0.1 for _ in prices]
            market[slot] = [(p, o, p * o * 30) for p, o in zip(prices, occupancy)]
            rows += [(f"m{m}", *slot, i, p, o, r, base, 30.0) for i, (p, o, r) in enumerate(market[slot])]
        markets[f"m{m}"] = market
    df = spark.createDataFrame(
        rows, "city string, season string, weekend int, grid_index int, price double, predicted_occupancy double, "
        "annual_revenue double, baseline_price double, days_in_segment double")
    chosen, status = optimize.optimal_prices(df, rules)
    found = {r["city"]: (r["n"], r["total"]) for r in chosen.groupBy("city").agg(F.count("*").alias("n"), F.sum("annual_revenue").alias("total")).collect()}
    states = dict(map(tuple, status.collect()))
    for m, market in markets.items():
        best = brute_force(market, rules)
        assert states[m] == ("Infeasible" if best is None else "Optimal")
        if best is None:
            assert m not in found
        else:
            assert found[m] == (6, pytest.approx(best, rel=1e-12))
    assert states["m5"] == "Infeasible" and "Optimal" in states.values()


def options_of(market):
    """The three seasons of a market as the solver takes them."""
    sides = lambda season, w: [list(x) for x in zip(*[(p, r, p * 30.0 * (1 + w)) for p, _, r in market[season, w]])]
    return [optimize.Season(sides(s, 0), sides(s, 1)) for s in ("low", "shoulder", "high")]


def limited_brute(seasons, premium, gap, low, high):
    best = None
    grids = [range(len(s.price[w])) for s in seasons for w in (0, 1)]
    for combo in itertools.product(*grids):
        picks = [combo[0:2], combo[2:4], combo[4:6]]
        if optimize._fits(seasons, picks, premium, gap) and low <= optimize._total(seasons, picks, "spend") <= high:
            value = optimize._total(seasons, picks, "value")
            best = value if best is None else max(best, value)
    return best


@pytest.mark.parametrize("seed", range(30))
def test_binding_limits_equal_brute_force(seed):
    rng = random.Random(seed)
    smooth = seed % 2
    market = {}
    for season, w in SLOTS:
        base, n = rng.uniform(80, 120), rng.randint(2, 6)
        prices = sorted(base * rng.uniform(0.5, 1.5) for _ in range(n))
        slope = rng.uniform(0.002, 0.006)
        share = [max(0.05, 0.9 - slope * p) if smooth else rng.uniform(0.2, 1.0) for p in prices]
        market[season, w] = [(p, o, p * o * 30) for p, o in zip(prices, share)]
    if seed % 5 == 4:
        market["shoulder", 0] = market["high", 1] = [(float("nan"), 0, 0.0)]
    seasons = options_of(market)
    if seed % 5 == 4:
        for s, w in ((1, 0), (2, 1)):
            seasons[s].spend[w][:] = 0.0
            seasons[s].value[w][:] = 0.0
    free = optimize.limited(seasons, 1.1, 1.05, -math.inf, math.inf)
    assert (free is None) == (limited_brute(seasons, 1.1, 1.05, -math.inf, math.inf) is None)
    if free is None:
        return
    spent = optimize._total(seasons, free, "spend")
    assert optimize._total(seasons, free, "value") == pytest.approx(limited_brute(seasons, 1.1, 1.05, -math.inf, math.inf))
    for low, high in ((0.0, 0.99 * spent), (0.0, 0.9 * spent), (0.0, 0.7 * spent), (1.02 * spent, 9 * spent), (1.1 * spent, 1.2 * spent), (0.85 * spent, 0.86 * spent)):
        want = limited_brute(seasons, 1.1, 1.05, low, high)
        found = optimize.limited(seasons, 1.1, 1.05, low, high)
        assert (found is None) == (want is None)
        if want is not None:
            assert optimize._total(seasons, found, "value") == pytest.approx(want, rel=1e-12)
            assert optimize._fits(seasons, found, 1.1, 1.05) and low <= optimize._total(seasons, found, "spend") <= high


def smooth_market(points):
    grid = lambda base: base * np.linspace(0.5, 1.5, points)
    side = lambda base, days: (grid(base), grid(base) * np.clip(0.7 - 0.35 * (grid(base) / base - 1), 0, 1) * days, grid(base) * days)
    return [optimize.Season(side(100.0, 66), side(104.0, 24)), optimize.Season(side(101.0, 108), side(109.0, 44)), optimize.Season(side(103.0, 87), side(112.0, 36))]


def test_large_grids_take_little_memory():
    seasons = smooth_market(3000)
    tracemalloc.start()
    found = optimize.limited(seasons, 1.1, 1.05, 0, math.inf)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 20e6 < 3000 * 3000 * 8 and optimize._fits(seasons, found, 1.1, 1.05)


def test_a_binding_limit_on_a_full_grid():
    """Revenue under the limit lies between that of a coarser grid and the charged bound of the full one."""
    seasons, coarse = smooth_market(401), smooth_market(41)
    spent = optimize._total(seasons, optimize.limited(seasons, 1.1, 1.05, 0, math.inf), "spend")
    found = optimize.limited(seasons, 1.1, 1.05, 0, 0.9 * spent)
    value = optimize._total(seasons, found, "value")
    assert optimize._total(seasons, found, "spend") <= 0.9 * spent
    assert value >= optimize._total(coarse, optimize.limited(coarse, 1.1, 1.05, 0, 0.9 * spent), "value")
    for rate in (0.05, 0.1, 0.2, 0.3, 0.4, 0.6):
        bound = optimize.swept([s.charged(rate) for s in seasons], 1.1, 1.05)[0] + rate * 0.9 * spent
        assert value <= bound + 1e-6


def test_price_limit_on_the_portfolio_is_kept(spark, published):
    base = published.select(
        "city", "season", "weekend", "baseline_price", "baseline_occupancy", "days_in_segment",
        F.col("elasticity_slope").alias("slope_all"), *[F.lit(None).cast("double").alias(c) for c in ("slope_low", "slope_high", "breakpoint_log_price")])
    curve = demand.annual_revenue(demand.demand_curve(base, points=50))
    chosen, status = optimize.optimal_prices(curve, PriceRules(max_portfolio_change=0.05))
    assert status.first()["status"] == "Optimal" and chosen.count() == 6
    moved = chosen.agg(F.sum(F.col("price") * F.col("days_in_segment")) / F.sum(F.col("baseline_price") * F.col("days_in_segment"))).first()[0]
    assert 1.03 < moved <= 1.05 + 1e-8
    chosen, status = optimize.optimal_prices(curve.where("price > baseline_price * 1.2"), PriceRules(max_portfolio_change=0.05))
    assert status.first()["status"] == "Infeasible" and chosen.count() == 0
    incomplete = curve.where("season != 'low'")
    chosen, status = optimize.optimal_prices(incomplete)
    assert status.first()["status"] == "Optimal" and chosen.count() == 4
    impossible = curve.withColumn("predicted_occupancy", F.when(F.col("season") == "low", 0.1).otherwise(F.col("predicted_occupancy")))
    chosen, status = optimize.optimal_prices(impossible)
    assert status.first()["status"] == "Infeasible" and chosen.count() == 0


def test_absent_segments_bind_nothing(spark):
    rng = random.Random(5)
    rules = PriceRules(min_occupancy=0.3, max_portfolio_change=10.0, min_price=0.0)
    gone = [{("low", 0)}, {("shoulder", 0), ("shoulder", 1)}, {("high", 1), ("low", 1)}, {("low", 0), ("low", 1), ("high", 0)}, {("shoulder", 1)}]
    rows, want = [], {}
    for m, missing in enumerate(gone):
        market = {}
        for slot in [x for x in SLOTS if x not in missing]:
            base = rng.uniform(90, 110)
            options = [(base * (0.5 + i / 6), rng.uniform(0.2, 1.0)) for i in range(7)]
            market[slot] = [(p, o, p * o * 30) for p, o in options]
            rows += [(f"m{m}", *slot, i, p, o, p * o * 30, base, 30.0) for i, (p, o) in enumerate(options)]
        best = None
        for combo in itertools.product(*market.values()):
            price = {slot: p for slot, (p, _, _) in zip(market, combo)}
            fine = all(o >= rules.min_occupancy for _, o, _ in combo)
            fine &= all(price[s, 1] >= rules.weekend_premium * price[s, 0] for s in ("low", "shoulder", "high") if {(s, 0), (s, 1)} <= set(price))
            for lower, upper in (("low", "shoulder"), ("shoulder", "high")):
                fine &= all(price[upper, w] >= rules.season_gap * price[lower, w] for w in (0, 1) if {(lower, w), (upper, w)} <= set(price))
            if fine:
                best = max(best or 0.0, sum(r for _, _, r in combo))
        want[f"m{m}"] = best
    df = spark.createDataFrame(
        rows, "city string, season string, weekend int, grid_index int, price double, predicted_occupancy double, "
        "annual_revenue double, baseline_price double, days_in_segment double")
    chosen, status = optimize.optimal_prices(df, rules)
    found = {r["city"]: r["t"] for r in chosen.groupBy("city").agg(F.sum("annual_revenue").alias("t")).collect()}
    states = dict(map(tuple, status.collect()))
    for city, best in want.items():
        assert states[city] == ("Infeasible" if best is None else "Optimal")
        assert best is None or found[city] == pytest.approx(best, rel=1e-12)
    assert "Optimal" in states.values()


def test_grid(spark, published):
    base = published.select(
        "city", "season", "weekend", "baseline_price", "baseline_occupancy",
        F.lit(-0.5).alias("slope_all"), *[F.lit(None).cast("double").alias(c) for c in ("slope_low", "slope_high", "breakpoint_log_price")])
    curve = demand.demand_curve(base, span=0.2, points=5)
    assert curve.count() == 30 and curve.select("candidate_id").distinct().count() == 30
    prices = [r["price"] for r in curve.where("season = 'low' AND weekend = 0").orderBy("grid_index").collect()]
    assert prices == pytest.approx([80.98 * f for f in (0.8, 0.9, 1.0, 1.1, 1.2)])
    for span, points in ((0.0, 10), (1.0, 10), (0.5, 2)):
        with pytest.raises(ValueError):
            demand.demand_curve(base, span, points)

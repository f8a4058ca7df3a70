"""Price queries count listings by cells of prices once, for quantiles and bins alike."""

import random

import pytest
from pyspark.sql import functions as F

from lodgecurve.checks import listings as made
from lodgecurve.checks import queries as q
from lodgecurve.operators import elasticity, scale, segments
from lodgecurve.schemas import SEGMENT_COLS


@pytest.fixture(scope="module")
def listed(spark):
    rng = random.Random(5)
    rows = [(c, s, w, rng.lognormvariate(5, 0.6), rng.random(), 30.0) for c in ("a", None) for s in ("low", "high") for w in (0, 1) for _ in range(700)]
    rows += [("a", "low", 0, p, o, 30.0) for p, o in ((0.0, 0.5), (-0.0, None), (None, 0.4), (None, None), (80.0, None), (80.0, 0.2), (float("nan"), 0.3))]
    rows += [("b", "low", 0, 40.0, None, None), ("c", "low", 1, None, 0.7, 10.0)]
    schema = "city string, season string, weekend int, listing_price double, occupancy_rate double, days_in_period double"
    return scale.materialise(spark.createDataFrame(rows, schema).repartition(3))


def same(one, other):
    one, other = ({tuple(map(str, r[:4])): r for r in df.collect()} for df in (one, other))
    assert one.keys() == other.keys()
    for k, r in one.items():
        for x, y in zip(r[4:], other[k][4:], strict=True):
            assert x is y is None or x == pytest.approx(y, rel=1e-12, nan_ok=True)


def test_shared_cells_change_no_quantile_and_no_bin(listed):
    cells = elasticity.price_cells(listed)
    extra = [F.avg("occupancy_rate").alias("baseline_occupancy")]
    columns = [*SEGMENT_COLS, "listing_count", "segment_median_price", "segment_p90_price", "segment_p10_price", "baseline_occupancy", "avg_days_in_period"]
    stats = [segments.pricing_segment_stats(listed, extra=extra, **more).select(columns) for more in ({}, {"cells": cells})]
    same(*stats)
    same(*[elasticity.price_bins(listed, **more).select(*SEGMENT_COLS, "bin", "n", "x", "mean_occupancy") for more in ({}, {"cells": cells})])


def test_baseline_counts_cells_once(listed, monkeypatch):
    counted, was = [], scale.value_cell
    monkeypatch.setattr(scale, "value_cell", lambda value: counted.append(value) or was(value))
    q.baseline(listed)
    assert len(counted) <= 3  # one count of all cells, and open cells of quantiles and of bins


@pytest.mark.parametrize("limit", [scale.BROADCAST_BYTES, 0])
def test_open_cells_tell_groups_apart(listed, monkeypatch, limit):
    """Few cells are found by a hash of group and cell, many by the cell alone; either way only rows of open cells are left."""
    known = listed.where("listing_price is not null")
    cells = scale.materialise(scale.cell_counts(known, SEGMENT_COLS, "listing_price"))
    some = cells.where("city is null and season = 'low' and weekend = 1 and __n > 3")
    monkeypatch.setattr(scale, "BROADCAST_BYTES", limit)
    found = scale.open_cells(known, some, SEGMENT_COLS, "listing_price")
    assert ("xxhash64" in found._jdf.queryExecution().optimizedPlan().toString()) == (limit > 0)
    assert sorted(set(map(str, found.select(*SEGMENT_COLS).collect()))) == sorted(set(map(str, some.select(*SEGMENT_COLS).collect())))
    assert found.agg(F.sum("__n")).first()[0] == some.agg(F.sum("__n")).first()[0]


def test_seasons_are_worked_out_on_orders(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(made, "_sent_to_all", lambda df: False)
    plan = made.listings(spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    above = plan[: plan.index("Join")]
    assert "month(" not in above and "lower(" not in above

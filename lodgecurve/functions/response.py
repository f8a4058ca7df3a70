"""Demand response: which slope holds at a price, and what occupancy a new price brings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lodgecurve.functions.values import clip


def slope_at(position: Column, breakpoint: Column, single: Column, low: Column, high: Column) -> Column:
    """The slope of the only regime, or of the regime ``position`` lies in.

    A position equal to the breakpoint belongs to the high regime.
    """
    return F.coalesce(single, F.when(position < breakpoint, low).otherwise(high))


def _moved(occupancy: Column, start: Column, end: Column, slope: Column) -> Column:
    return occupancy * (F.lit(1.0) + slope * ((end - start) / start))


def occupancy_at(
    price: Column,
    base_price: Column,
    base_occupancy: Column,
    breakpoint_price: Column,
    single: Column,
    low: Column,
    high: Column,
) -> Column:
    """Occupancy at ``price``, moving from the base along the slope of each regime passed.

    A move across the breakpoint is made in two steps, each with its own regime's slope; only
    the end result is bounded to [0, 1].
    """
    here = slope_at(base_price, breakpoint_price, single, low, high)
    there = slope_at(price, breakpoint_price, single, low, high)
    crosses = single.isNull() & ((base_price < breakpoint_price) != (price < breakpoint_price))
    at_breakpoint = _moved(base_occupancy, base_price, breakpoint_price, here)
    moved = F.when(crosses, _moved(at_breakpoint, breakpoint_price, price, there)).otherwise(
        _moved(base_occupancy, base_price, price, here)
    )
    return clip(moved, 0.0, 1.0)

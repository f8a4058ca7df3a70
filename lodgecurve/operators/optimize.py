"""Choice of one price per segment that maximises a market's yearly revenue under business rules.

Rules: price and occupancy bounds per segment, weekends dearer than weekdays by a factor, each
season dearer than the next lower one by a factor, and a limit on how far the day-weighted
average price of a market may move.

Segments are first optimised alone. Where those prices already respect the rules across segments
they are the optimum, because dropping rules can only raise revenue. The remaining markets go to
an exact programme over the seasons, one market per group. It sweeps over weekday prices and
keeps a running best for every weekend price, so a task holds a few rows of a grid's length,
never a grid squared, and a grid may have any number of points.

Where the limit on the average price binds, prices are charged for what they spend (a Lagrange
multiplier). That bounds what every price can still lead to: prices that cannot reach the best choice
known go, and the few left are searched exactly.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodgecurve.operators.scale import join_measured, materialise
from lodgecurve.schemas import SEASONS_ASCENDING, SEGMENT_COLS

# Executors get the solver with the task, so they need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


SLACK = 1e-9  # sums of the same terms in another order may differ in the last digits


@dataclass(frozen=True)
class PriceRules:
    # The default business rules.
    min_price: float = 10.0
    max_price: float = 1000.0
    min_occupancy: float = 0.5
    weekend_premium: float = 1.10
    season_gap: float = 1.05
    max_portfolio_change: float = 0.5


class Season:
    """Price options of one season, by rising price: weekdays and weekends, each with prices, values and what they spend."""

    def __init__(self, day, end) -> None:
        self.price, self.value, self.spend = zip(*[[np.asarray(x, dtype=float) for x in part] for part in (day, end)])

    def charged(self, rate: float) -> "Season":
        return Season(*[(p, v - rate * s, s) for p, v, s in zip(self.price, self.value, self.spend)])

    def kept(self, day, end) -> "Season":
        return Season(*[(p[k], v[k], s[k]) for p, v, s, k in zip(self.price, self.value, self.spend, (day, end))])

    def mirrored(self) -> "Season":
        """The same options with the order of prices reversed, in which weekdays take the place of weekends."""
        return Season(*[(-p[::-1], v[::-1], s[::-1]) for p, v, s in reversed(list(zip(self.price, self.value, self.spend)))])


class Sweep:
    """Best choices of a season and all lower ones, for weekday prices up to a moving one and every weekend price.

    ``best[j]`` is the largest value with a weekday price swept so far and the j-th weekend price at
    most; ``picks`` are its choices, weekday and weekend for this season, then the lower ones. The
    prices of a segment that a market lacks are NaN, which no rule binds. Ties go to lower prices.
    """

    def __init__(self, season: Season, lower: "Sweep | None", premium: float, gap: float) -> None:
        (day, end), (self.day_value, self.end_value) = season.price, season.value
        self.first = np.where(np.isnan(day) | np.isnan(end[:1]), 0, np.searchsorted(end, premium * day, side="left"))
        self.lower, self.done = lower, 0
        self.best = np.full(len(end), -np.inf)
        self.picks = np.zeros((2 + (len(lower.picks) if lower else 0), len(end)), dtype=np.int64)
        if lower:
            self.reach = [
                np.where(np.isnan(mine), len(theirs), np.searchsorted(gap * np.nan_to_num(theirs, nan=-np.inf), mine, side="right")) - 1
                for theirs, mine in zip(lower.prices, (day, end))
            ]
        self.prices = (day, end)

    def row(self, i: int):
        """Value of the i-th weekday price with every weekend price."""
        value = self.end_value + self.day_value[i]
        if self.lower:
            self.lower.advance(self.reach[0][i])
            value = value + np.where(self.reach[1] < 0, -np.inf, self.lower.best[self.reach[1]]) if self.reach[0][i] >= 0 else np.full_like(value, -np.inf)
        value[: self.first[i]] = -np.inf
        return value

    def advance(self, upto: int) -> None:
        for i in range(self.done, upto + 1):
            value = self.row(i)
            top = np.maximum.accumulate(value)
            better = np.flatnonzero(top > self.best)
            if len(better):
                new = np.concatenate([[True], value[1:] > top[:-1]])
                at = np.maximum.accumulate(np.where(new, np.arange(len(value)), 0))[better]
                self.best[better] = top[better]
                self.picks[0, better], self.picks[1, better] = i, at
                if self.lower:
                    self.picks[2:, better] = self.lower.picks[:, self.reach[1][at]]
        self.done = max(self.done, upto + 1)


def swept(seasons: list[Season], premium: float, gap: float):
    """The best value, its choices by season from low to high, and the best value with each price of the highest season."""
    top = None
    for season in seasons:
        top = Sweep(season, top, premium, gap)
    days, ends = np.full(len(top.day_value), -np.inf), np.full(len(top.end_value), -np.inf)
    best, picks = -np.inf, None
    for i in range(len(days)):
        value = top.row(i)
        j = int(value.argmax())
        days[i] = value[j]
        ends = np.maximum(ends, value)
        if value[j] > best:
            lower = top.lower.picks[:, top.reach[1][j]].tolist() if top.lower else []
            best, picks = value[j], [i, j, *lower]
    if picks is None:
        return -np.inf, None, days, ends
    return best, [tuple(picks[k : k + 2]) for k in range(len(picks) - 2, -1, -2)], days, ends


def _total(seasons: list[Season], picks, what: str) -> float:
    return sum(float(getattr(s, what)[w][p[w]]) for s, p in zip(seasons, picks) for w in (0, 1))


def _fits(seasons: list[Season], picks, premium: float, gap: float) -> bool:
    """Whether the choices respect the rules between segments; comparisons with a missing segment's NaN bind nothing."""
    at = [[s.price[w][p[w]] for w in (0, 1)] for s, p in zip(seasons, picks)]
    return not any(end < premium * day for day, end in at) and not any(u[w] < gap * l[w] for l, u in zip(at, at[1:]) for w in (0, 1))


def _stepped(seasons: list[Season], picks, premium: float, gap: float, low: float, high: float):
    """Choices stepped one price at a time, each the cheapest for its spend, until the spend lies between the limits."""
    picks = [list(p) for p in picks]
    while not low <= _total(seasons, picks, "spend") <= high:
        down = _total(seasons, picks, "spend") > high
        open_steps = []
        for n, (s, p) in enumerate(zip(seasons, picks)):
            for w in (0, 1):
                to = p[w] - 1 if down else p[w] + 1
                if 0 <= to < len(s.price[w]):
                    was, p[w] = p[w], to
                    if _fits(seasons, picks, premium, gap):
                        moved = abs(s.spend[w][to] - s.spend[w][was])
                        open_steps.append(((s.value[w][was] - s.value[w][to]) / max(moved, 1e-12), n, w, to))
                    p[w] = was
        if not open_steps:
            return None
        _, n, w, to = min(open_steps)
        picks[n][w] = to
        if (_total(seasons, picks, "spend") > high) != down and not low <= _total(seasons, picks, "spend") <= high:
            return None  # one step goes past both limits
    return picks


def _improved(seasons: list[Season], picks, premium: float, gap: float, low: float, high: float):
    """Choices that no change of a single price betters."""
    picks, again = [list(p) for p in picks], True
    while again:
        again = False
        for s, p in zip(seasons, picks):
            for w in (0, 1):
                now = p[w]
                for to in range(max(0, now - 50), min(len(s.price[w]), now + 51)):
                    if s.value[w][to] > s.value[w][p[w]]:
                        was, p[w] = p[w], to
                        if not _fits(seasons, picks, premium, gap) or not low <= _total(seasons, picks, "spend") <= high:
                            p[w] = was
                again |= p[w] != now
    return picks


def _left(seasons: list[Season], premium: float, gap: float, least: float):
    """For each of three seasons the options whose best completion reaches ``least``."""
    loose = 1e-12
    _, _, days, ends = swept(seasons, premium, gap)
    keep = [(np.arange(len(s.price[0])), np.arange(len(s.price[1]))) for s in seasons]
    keep[-1] = (np.flatnonzero(days >= least), np.flatnonzero(ends >= least))
    # rules read from the other end, a hair looser so that rounding removes nothing
    back = [s.mirrored() for s in reversed(seasons)]
    _, _, days, ends = swept(back, (1 + loose) / premium, (1 + loose) / gap)
    n_day, n_end = len(ends), len(days)
    keep[0] = (np.sort(n_day - 1 - np.flatnonzero(ends >= least)), np.sort(n_end - 1 - np.flatnonzero(days >= least)))
    out = [s.kept(*k) for s, k in zip(seasons, keep)]
    if all(len(x) for x in (*keep[0], *keep[2])):
        keep[1] = _middle(out, premium, gap, least)
    return keep


def _middle(seasons: list[Season], premium: float, gap: float, least: float):
    """Options of the middle of three seasons whose best completion reaches ``least``; the outer seasons are few options by now."""
    low, mid, high = seasons

    def table(season: Season, tail: bool):
        day, end = season.price
        value = season.value[0][:, None] + season.value[1][None, :]
        value[end[None, :] < premium * day[:, None]] = -np.inf
        value = value[::-1, ::-1] if tail else value
        value = np.maximum.accumulate(np.maximum.accumulate(value, axis=0), axis=1)
        return value[::-1, ::-1] if tail else value

    below, above = table(low, False), table(high, True)
    known = lambda p: np.nan_to_num(p, nan=-np.inf)
    reach = [np.where(np.isnan(m), len(t), np.searchsorted(gap * known(t), m, side="right")) - 1 for t, m in zip(low.price, mid.price)]
    need = [np.where(np.isnan(m) | np.isnan(t[:1]), 0, np.searchsorted(t, gap * m, side="left")) for t, m in zip(high.price, mid.price)]
    day, end = mid.price
    days, ends = np.full(len(day), -np.inf), np.full(len(end), -np.inf)
    for i in range(len(day)):
        if reach[0][i] < 0 or need[0][i] >= len(above):
            continue
        value = mid.value[1] + mid.value[0][i]
        value = value + np.where(reach[1] < 0, -np.inf, below[reach[0][i]][reach[1]])
        value = value + np.where(need[1] >= above.shape[1], -np.inf, above[need[0][i]][np.minimum(need[1], above.shape[1] - 1)])
        value[end < premium * day[i]] = -np.inf
        days[i] = value.max()
        ends = np.maximum(ends, value)
    return np.flatnonzero(days >= least), np.flatnonzero(ends >= least)


def _searched(seasons: list[Season], charged: list[Season], premium: float, gap: float, low: float, high: float, least: float, shift: float, known):
    """The best choices within the limits, among few options: partial choices go once even the charged rest cannot reach the best known.

    ``shift`` is what the charge gives back at the limit; pairs of a season are met in blocks.
    """
    best, picks = least, known
    pairs, floor = [], 1e-9 * max(1.0, abs(least))
    for s, c in zip(seasons, charged):
        i, j = np.nonzero(~(s.price[1][None, :] < premium * s.price[0][:, None]))
        table = np.stack([
            s.price[0][i], s.price[1][j], s.value[0][i] + s.value[1][j], s.spend[0][i] + s.spend[1][j], c.value[0][i] + c.value[1][j], i, j,
        ])
        pairs.append(table[:, np.argsort(-table[4], kind="stable")])
    if not all(p.shape[1] for p in pairs):
        return None
    rest = np.cumsum([0.0, *[p[4].max() for p in reversed(pairs)]])[::-1][1:]  # what the seasons above can add at most
    found = []

    def extend(depth: int, chosen: list, price, value: float, spend: float, charge: float) -> None:
        nonlocal best, picks
        table = pairs[depth]
        able = charge + table[4] + rest[depth] + shift >= best - floor
        if price is not None:
            able &= ~(table[0] < gap * price[0]) & ~(table[1] < gap * price[1])
        if depth == len(pairs) - 1:
            total = spend + table[3]
            able &= (total >= low) & (total <= high) & (value + table[2] > best)
            if able.any():
                at = np.flatnonzero(able)
                k = at[np.argmax(table[2][at])]
                best, picks = value + table[2][k], [*chosen, (int(table[5][k]), int(table[6][k]))]
            return
        for k in np.flatnonzero(able):
            if charge + table[4][k] + rest[depth] + shift < best - floor:
                break  # the rest of the pairs is charged more
            extend(
                depth + 1, [*chosen, (int(table[5][k]), int(table[6][k]))], (table[0][k], table[1][k]), value + table[2][k], spend + table[3][k],
                charge + table[4][k],
            )

    extend(0, [], None, 0.0, 0.0, 0.0)
    return picks


def limited(seasons: list[Season], premium: float, gap: float, low: float, high: float):
    """The best choices by season whose spend lies between ``low`` and ``high``, or None."""
    _, picks, _, _ = swept(seasons, premium, gap)
    if picks is None:
        return None
    spent = _total(seasons, picks, "spend")
    if low <= spent <= high:
        return picks
    sign, limit = (1.0, high) if spent > high else (-1.0, low)  # what is spent in excess of the limit is charged
    over = lambda p: sign * (_total(seasons, p, "spend") - limit)
    _, far, _, _ = swept([Season(*[(p, -sign * s, s) for p, s in zip(x.price, x.spend)]) for x in seasons], premium, gap)
    if over(far) > 0:
        return None  # even the least spend lies past the limit
    known = []
    hard, easy, rate = picks, far, 0.0
    for _ in range(60):
        gain = _total(seasons, hard, "value") - _total(seasons, easy, "value")
        rate = max(0.0, gain / (over(hard) - over(easy)))
        value, now, _, _ = swept([s.charged(sign * rate) for s in seasons], premium, gap)
        known += [now, easy]
        reached = _total(seasons, easy, "value") - rate * sign * _total(seasons, easy, "spend")
        if value <= reached + 1e-12 * max(1.0, abs(reached)):
            break
        hard, easy = (now, easy) if over(now) > 0 else (hard, now)
    starts = [x for x in (_stepped(seasons, p, premium, gap, low, high) for p in (hard, easy, *known[-2:])) if x is not None]
    starts = [_improved(seasons, x, premium, gap, low, high) for x in starts]
    start = max(starts, key=lambda x: _total(seasons, x, "value"), default=None)
    least = -np.inf if start is None else _total(seasons, start, "value")
    charged = [s.charged(sign * rate) for s in seasons]
    shift = rate * sign * limit
    keep = _left(charged, premium, gap, least - shift - 1e-9 * max(1.0, abs(least))) if start is not None else [
        (np.arange(len(s.price[0])), np.arange(len(s.price[1]))) for s in seasons
    ]
    few, few_charged = ([s.kept(*k) for s, k in zip(x, keep)] for x in (seasons, charged))
    inside = None if start is None else [
        tuple(int(np.searchsorted(k[w], p[w])) for w in (0, 1)) for k, p in zip(keep, start)
    ]
    picks = _searched(few, few_charged, premium, gap, low, high, least, shift, inside)
    return None if picks is None else [(int(k[0][p[0]]), int(k[1][p[1]])) for k, p in zip(keep, picks)]


def _market_optimum(pdf, seasons: list[str], premium: float, gap: float, change: float | None):
    """Best price per segment of one market as (season, weekend, grid_index), or no rows."""
    parts = [[pdf[(pdf["season"] == s) & (pdf["weekend"] == w)].sort_values("price") for w in (0, 1)] for s in seasons]
    absent = ([np.nan], [0.0], [0.0])  # bound by no rule
    options = [Season(*[absent if p.empty else (p["price"], p["annual_revenue"], p["spend"]) for p in pair]) for pair in parts]
    low, high = -np.inf, np.inf
    if change is not None:
        base = float(pdf["base"].iloc[0])
        low, high = base * (1 - change), base * (1 + change)
    picks = limited(options, premium, gap, low, high) or []
    chosen = [
        (pdf["city"].iloc[0], s, w, int(pair[w]["grid_index"].iloc[p[w]]))
        for s, pair, p in zip(seasons, parts, picks) for w in (0, 1) if not pair[w].empty
    ]
    return pd.DataFrame(chosen, columns=["city", "season", "weekend", "grid_index"])


def choose_prices(candidates: DataFrame, rules: PriceRules = PriceRules()) -> DataFrame:
    """The chosen ``grid_index`` of every segment of each solvable market.

    ``candidates`` needs the segment columns, ``grid_index``, ``price``,
    ``predicted_occupancy`` and ``annual_revenue``; the limit on the average price holds if there are
    ``baseline_price`` and ``days_in_segment`` too. Segments a market does not have bind nothing;
    a market with a segment that has candidates but no allowed price is not solvable, nor is one without
    prices that respect all rules.
    """
    limited_too = {"baseline_price", "days_in_segment"} <= set(candidates.columns)
    change = rules.max_portfolio_change + SLACK if limited_too else None
    days = F.col("days_in_segment").cast("double") if limited_too else F.lit(0.0)
    usable = (
        F.col("price").between(rules.min_price, rules.max_price)
        & (F.col("predicted_occupancy") >= rules.min_occupancy)
        & F.col("annual_revenue").isNotNull()
    )
    known = candidates.withColumns({"spend": F.col("price") * days, "base": F.col("baseline_price") * days if limited_too else F.lit(0.0)})
    allowed = known.where(usable).select(*SEGMENT_COLS, "grid_index", "price", "annual_revenue", "spend")

    option = F.struct("annual_revenue", (-F.col("price")).alias("minus_price"), "grid_index", "price", "spend")
    alone = known.groupBy(*SEGMENT_COLS).agg(F.max(F.when(usable, option)).alias("best"), F.max("base").alias("base"))
    slots = {(s, w): f"{s}_{w}" for s in SEASONS_ASCENDING for w in (0, 1)}
    pivoted = alone.groupBy("city").agg(
        *[F.max(F.when((F.col("season") == s) & (F.col("weekend") == w), F.col("best"))).alias(n) for (s, w), n in slots.items()],
        F.every(F.col("best").isNotNull()).alias("solvable"), F.sum("base").alias("base"), F.sum("best.spend").alias("spend"),
    )
    price = lambda s, w: F.col(f"{slots[s, w]}.price")
    coupled = F.lit(True) if change is None else F.abs(F.col("spend") - F.col("base")) <= F.col("base") * F.lit(change)
    for s in SEASONS_ASCENDING:
        coupled &= F.coalesce(price(s, 1) >= rules.weekend_premium * price(s, 0), F.lit(True))
    for lower, upper in zip(SEASONS_ASCENDING, SEASONS_ASCENDING[1:]):
        for w in (0, 1):
            coupled &= F.coalesce(price(upper, w) >= rules.season_gap * price(lower, w), F.lit(True))
    markets = materialise(pivoted.where("solvable").withColumn("coupled", F.coalesce(coupled, F.lit(False))))

    picks = F.array(
        *[F.struct(F.lit(s).alias("season"), F.lit(w).alias("weekend"), F.col(f"{n}.grid_index").alias("grid_index"))
          for (s, w), n in slots.items()]
    )
    chosen = markets.where("coupled").select("city", F.explode(picks).alias("p")).select("city", "p.*").where(F.col("grid_index").isNotNull())
    rest = markets.where(~F.col("coupled")).select("city", "base")
    if rest.isEmpty():
        return chosen

    seasons, premium, gap = list(SEASONS_ASCENDING), rules.weekend_premium, rules.season_gap
    types = dict(allowed.dtypes)
    solved = (
        join_measured(allowed, rest, ["city"], "inner", stored=True)
        .groupBy("city")
        .applyInPandas(
            lambda pdf: _market_optimum(pdf, seasons, premium, gap, change),
            f"city {types['city']}, season string, weekend int, grid_index int",
        )
    )
    return chosen.unionByName(solved)


def optimal_prices(candidates: DataFrame, rules: PriceRules = PriceRules()) -> tuple[DataFrame, DataFrame]:
    """The chosen candidate rows, and one status row per market.

    Status is 'Optimal', or 'Infeasible' when no prices satisfy the rules, the limit on the
    average price included.
    """
    keys = [*SEGMENT_COLS, "grid_index"]
    rows = materialise(join_measured(candidates, choose_prices(candidates, rules), keys, "inner"))
    solved = rows.select("city").distinct().withColumn("solved", F.lit(True))
    status = (
        candidates.select("city").distinct().join(solved, "city", "left")
        .select("city", F.when(F.col("solved"), "Optimal").otherwise("Infeasible").alias("status"))
    )
    return rows, status

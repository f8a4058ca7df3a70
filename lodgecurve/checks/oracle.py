"""SQL oracles for the registered queries."""

from __future__ import annotations

from lodgecurve.checks.listings import CLIPPED_SQL, FEATURES_SQL, LISTINGS_SQL, STATS_SQL


def _with(*parts: str) -> str:
    return "WITH " + ", ".join(p.strip() for p in parts) + "\n"


LISTED = _with(LISTINGS_SQL)
CLIPPED = _with(LISTINGS_SQL, CLIPPED_SQL)
FEATURED = _with(LISTINGS_SQL, CLIPPED_SQL, FEATURES_SQL)
STATED = _with(LISTINGS_SQL, CLIPPED_SQL, FEATURES_SQL, STATS_SQL)


def r(names: str, digits: int = 6) -> str:
    return ", ".join(f"round({n}, {digits}) AS {n}" for n in names.split())


def _hot(column: str, **values: str) -> str:
    return ", ".join(f"cast({column} = '{v}' AS INT) AS cat_{column}_{n}" for n, v in values.items())


ROOMS = {v.lower(): v for v in ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]}

SEG = "city, season, weekend"

# Twenty equal-count price bins; listings of one price are shared out over bin edges by count.
BINS_SQL = """
hist AS (SELECT city, season, weekend, listing_price AS p, count(*) AS c, sum(occupancy_rate) AS so
         FROM clipped GROUP BY ALL),
run AS (SELECT *, cast(sum(c) OVER (PARTITION BY city, season, weekend ORDER BY p) AS BIGINT) AS upto,
          cast(sum(c) OVER (PARTITION BY city, season, weekend) AS BIGINT) AS total FROM hist),
piece AS (SELECT city, season, weekend, b AS bin, p, so / c AS occ,
            least(upto, b * (total // 20) + least(b, total % 20))
            - greatest(upto - c, (b - 1) * (total // 20) + least(b - 1, total % 20)) AS m
          FROM run CROSS JOIN range(1, 21) AS t(b)),
bins AS (SELECT city, season, weekend, cast(bin AS INT) AS bin, cast(sum(m) AS BIGINT) AS n,
           sum(m * ln(1e0 + p)) / sum(m) AS x, sum(m * occ) / sum(m) AS mean_occupancy,
           ln(sum(m * occ) / sum(m)) AS y
         FROM piece WHERE m > 0 GROUP BY city, season, weekend, bin)
"""


def _error(side: str) -> str:
    x, y, xx, xy, yy, n = (f"{side}{k}" for k in ("x", "y", "xx", "xy", "yy", "n"))
    return (
        f"greatest(({yy} - {y} * {y} / {n}) - coalesce(({xy} - {x} * {y} / {n}) * ({xy} - {x} * {y} / {n})"
        f" / nullif({xx} - {x} * {x} / {n}, 0e0), 0e0), 0e0)"
    )


def _fit(two: str) -> str:
    """Best one-breakpoint fit per segment; ``two`` says when two lines are used."""
    terms = {"n": "1e0", "x": "cx", "y": "cy", "xx": "cx * cx", "xy": "cx * cy", "yy": "cy * cy"}
    whole = "PARTITION BY city, season, weekend"
    sums = ", ".join(
        f"sum({t}) OVER ({whole} ORDER BY bin ROWS UNBOUNDED PRECEDING) AS l{k}, sum({t}) OVER ({whole}) AS t{k}"
        for k, t in terms.items()
    )
    rest = ", ".join(f"t{k} - l{k} AS r{k}" for k in terms)
    return f"""
centred AS (SELECT *, x - avg(x) OVER ({whole}) AS cx, y - avg(y) OVER ({whole}) AS cy FROM bins),
summed AS (SELECT *, row_number() OVER ({whole} ORDER BY bin) AS k,
             lead(x) OVER ({whole} ORDER BY bin) AS next_x, {sums} FROM centred),
rested AS (SELECT *, {rest} FROM summed),
errors AS (SELECT *, CASE WHEN k >= 3 AND tn - k >= 3 THEN {_error("l")} + {_error("r")} END AS e2, {_error("t")} AS e1
           FROM rested),
best AS (SELECT city, season, weekend, max(tn) AS nb, max(e1) AS e1, min(e2) AS e2, arg_min(k, e2) AS split,
           arg_min((x + next_x) / 2e0, e2) AS bp FROM errors GROUP BY city, season, weekend),
choice AS (SELECT *, coalesce(e2 IS NOT NULL AND {two}, false) AS two FROM best),
labelled AS (SELECT s.*, CASE WHEN NOT two THEN 0 WHEN k <= split THEN 1 ELSE 2 END AS side,
               CASE WHEN two THEN bp END AS bp
             FROM summed s JOIN choice USING (city, season, weekend)),
fit AS (SELECT city, season, weekend, side, CASE WHEN var_pop(x) > 0 THEN regr_slope(y, x) END AS slope,
          CASE WHEN var_pop(x) > 0 THEN regr_intercept(y, x) END AS intercept,
          CASE WHEN var_pop(x) > 0 THEN regr_r2(y, x) END AS r_squared, count(*) AS n_bins, max(bp) AS breakpoint_log_price,
          CASE side WHEN 0 THEN 'all' WHEN 1 THEN 'low' ELSE 'high' END AS price_regime
        FROM labelled GROUP BY city, season, weekend, side)
"""


FIT_SQL = _fit("nb * ln(e2 / nb) + 5e0 * ln(nb) < nb * ln(e1 / nb) + 2e0 * ln(nb)")
BINNED = _with(LISTINGS_SQL, CLIPPED_SQL, BINS_SQL)
FITTED = _with(LISTINGS_SQL, CLIPPED_SQL, BINS_SQL, FIT_SQL)
REGIMES_SQL = """
regimes AS (SELECT city, season, weekend, max(CASE WHEN side = 0 THEN slope END) AS slope_all,
  max(CASE WHEN side = 1 THEN slope END) AS slope_low, max(CASE WHEN side = 2 THEN slope END) AS slope_high,
  max(breakpoint_log_price) AS bp FROM fit GROUP BY city, season, weekend)
"""
LOOKED_UP = _with(LISTINGS_SQL, CLIPPED_SQL, FEATURES_SQL, BINS_SQL, FIT_SQL, REGIMES_SQL)

BASE_SQL = """
base AS (SELECT city, season, weekend, quantile_disc(listing_price, 0.5) AS p0, avg(occupancy_rate) AS o0,
           avg(days_in_period) AS days FROM clipped GROUP BY city, season, weekend),
armed AS (SELECT *, exp(bp) - 1e0 AS b, coalesce(slope_all, CASE WHEN p0 < exp(bp) - 1e0 THEN slope_low ELSE slope_high END) AS s0
          FROM base JOIN regimes USING (city, season, weekend))
"""


def _curve(points: int) -> str:
    last = points - 1
    return f"""
grid AS (SELECT *, CASE WHEN g = {last} THEN p0 * 1.5e0 ELSE p0 * 0.5e0 + g * ((p0 * 1.5e0 - p0 * 0.5e0) / {last}e0) END AS p
         FROM armed CROSS JOIN range(0, {points}) AS t(g)),
sloped AS (SELECT *, coalesce(slope_all, CASE WHEN p < b THEN slope_low ELSE slope_high END) AS s1 FROM grid),
moved AS (SELECT *, CASE WHEN slope_all IS NULL AND (p0 < b) != (p < b)
            THEN o0 * (1e0 + s0 * ((b - p0) / p0)) * (1e0 + s1 * ((p - b) / b))
            ELSE o0 * (1e0 + s0 * ((p - p0) / p0)) END AS raw FROM sloped),
curve AS (SELECT city, season, weekend, cast(g AS INT) AS grid_index, p AS price, p0, o0, days, s1 AS slope,
            season || '_season_' || CASE weekend WHEN 1 THEN 'weekend' ELSE 'weekday' END AS segment_name,
            cast((CASE season WHEN 'high' THEN 0 WHEN 'shoulder' THEN 2 ELSE 4 END + weekend) * {points} + g AS BIGINT)
              AS candidate_id,
            CASE WHEN raw < 0 THEN 0e0 WHEN raw > 1 THEN 1e0 ELSE raw END AS occ,
            p * CASE WHEN raw < 0 THEN 0e0 WHEN raw > 1 THEN 1e0 ELSE raw END AS daily FROM moved)
"""


def _curved(points: int) -> str:
    return _with(LISTINGS_SQL, CLIPPED_SQL, BINS_SQL, FIT_SQL, REGIMES_SQL, BASE_SQL, _curve(points))


# Weekday and weekend prices of a season meet as a table; the best choice up to each cell is a running maximum along both
# axes, which the season above reads at the last prices it may stand over. A segment a market lacks is one option without a price.
def _season(name: str, lower: str | None) -> str:
    below = f"JOIN {lower}_best b ON b.city = d.city AND b.i = d.reach AND b.j = e.reach" if lower else ""
    value = "d.revenue + e.revenue" + (" + b.m" if lower else "")
    kept = [f"{k}{v}" for v in _lower(lower) for k in "ij"]
    carried = "".join(f", b.{k} AS {k}" for k in kept)
    reach = (
        f"(SELECT count(*) FROM sides l WHERE l.city = s.city AND l.weekend = s.weekend AND l.season = '{lower}'"
        " AND (l.price IS NULL OR s.price IS NULL OR s.price >= 1.05e0 * l.price))"
        if lower else "0"
    )
    along = "".join(f", arg_max({k}, v) OVER w AS {k}" for k in [f"i{name}", f"j{name}", *kept])
    across = along.replace(", v)", ", m)")
    return f"""
{name}_sides AS (SELECT s.*, {reach} AS reach FROM sides s WHERE season = '{name}'),
{name}_cells AS (SELECT d.city, d.n AS i, e.n AS j, d.n AS i{name}, e.n AS j{name},
    CASE WHEN e.price < 1.1e0 * d.price THEN -1e300 ELSE {value} END AS v{carried}
  FROM {name}_sides d JOIN {name}_sides e ON d.city = e.city AND d.weekend = 0 AND e.weekend = 1 {below}),
{name}_rows AS (SELECT city, i, j, max(v) OVER w AS m{along} FROM {name}_cells
  WINDOW w AS (PARTITION BY city, i ORDER BY j)),
{name}_best AS (SELECT city, i, j, max(m) OVER w AS m{across} FROM {name}_rows
  WINDOW w AS (PARTITION BY city, j ORDER BY i))"""


def _lower(name: str | None) -> list[str]:
    return [] if name is None else [name, *_lower({"high": "shoulder", "shoulder": "low", "low": None}[name])]


SOLVED_SQL = (
    """
sides AS (SELECT city, season, weekend, price, grid_index, daily * days AS revenue,
    row_number() OVER (PARTITION BY city, season, weekend ORDER BY price) AS n
  FROM curve WHERE price BETWEEN 10 AND 1000 AND occ >= 0.5e0
  UNION ALL SELECT city, season, weekend, NULL, NULL, 0e0, 1 FROM (SELECT DISTINCT city FROM curve)
    CROSS JOIN (VALUES ('low'), ('shoulder'), ('high')) AS a(season) CROSS JOIN (VALUES (0), (1)) AS b(weekend)
    WHERE (city, season, weekend) NOT IN (SELECT (city, season, weekend) FROM curve)),"""
    + ",".join(_season(n, l) for n, l in (("low", None), ("shoulder", "low"), ("high", "shoulder")))
    + """,
pick AS (SELECT city, max(v) AS v, unnest([{s: 'high', w: 0, n: arg_max(ihigh, v)}, {s: 'high', w: 1, n: arg_max(jhigh, v)},
    {s: 'shoulder', w: 0, n: arg_max(ishoulder, v)}, {s: 'shoulder', w: 1, n: arg_max(jshoulder, v)},
    {s: 'low', w: 0, n: arg_max(ilow, v)}, {s: 'low', w: 1, n: arg_max(jlow, v)}]) AS p FROM high_cells GROUP BY city),
picked AS (SELECT s.city, s.season, s.weekend, s.grid_index FROM pick
  JOIN sides s ON s.city = pick.city AND s.season = p.s AND s.weekend = p.w AND s.n = p.n WHERE v > -1e200 AND s.price IS NOT NULL),
solved AS (SELECT c.*, daily * days AS annual, p0 * o0 * days AS base_annual
           FROM curve c JOIN picked USING (city, season, weekend, grid_index))
"""
)
SOLVED = _curved(500).rstrip() + ", " + SOLVED_SQL.strip() + "\n"

def _json_number(v: str) -> str:
    """A double of six decimals as JSON text: below a thousandth in scientific form."""
    digits = f"cast(cast(round(abs({v}) * 1e6) AS INT) AS VARCHAR)"
    rest = f"coalesce(nullif(rtrim(substr({digits}, 2), '0'), ''), '0')"
    small = f"CASE WHEN {v} < 0 THEN '-' ELSE '' END || substr({digits}, 1, 1) || '.' || {rest} || 'E-' || (7 - length({digits}))"
    return f"CASE WHEN abs({v}) >= 1e-3 OR {v} = 0 THEN cast({v} AS VARCHAR) ELSE {small} END"


MEDIANS_SQL = """
property AS (SELECT city, quantile_disc(listing_price, 0.5) AS listing_price,
  quantile_disc(person_capacity, 0.5) AS person_capacity, quantile_disc(bedrooms, 0.5) AS bedrooms,
  quantile_disc(cleanliness_rating, 0.5) AS cleanliness_rating,
  quantile_disc(guest_satisfaction_overall, 0.5) AS guest_satisfaction_overall,
  quantile_disc(city_center_dist, 0.5) AS city_center_dist, quantile_disc(metro_dist, 0.5) AS metro_dist
  FROM clipped GROUP BY city)
"""


def _repriced(satisfaction: str, reach: str, versus: str, volatility: str) -> str:
    return (
        _with(LISTINGS_SQL, CLIPPED_SQL, FEATURES_SQL, STATS_SQL, BINS_SQL, FIT_SQL, REGIMES_SQL, MEDIANS_SQL)
        + f""", now AS (SELECT *, segment_median_price * 1.2e0 AS p FROM stats
            JOIN (SELECT * EXCLUDE (listing_price) FROM property) USING (city) LEFT JOIN regimes USING (city, season, weekend))
      SELECT city, season, weekend, round(p, 6) AS listing_price, round(ln(1e0 + p), 6) AS log_price,
      round(p / greatest(person_capacity, 1e0), 6) AS price_per_person,
      round(p / greatest(bedrooms, 1e0), 6) AS price_per_bedroom,
      round({satisfaction}, 6) AS price_x_satisfaction, round(p / {reach}, 6) AS price_per_dist_km,
      round({versus.format("segment_median_price")}, 6) AS price_vs_segment_median,
      round({versus.format("segment_avg_price")}, 6) AS price_vs_segment_avg,
      round({volatility}, 6) AS relative_price_volatility,
      round(coalesce(slope_all, CASE WHEN p < exp(bp) - 1e0 THEN slope_low ELSE slope_high END), 6) AS elasticity_slope
      FROM now"""
    )


def _hash(salt: int) -> str:
    return f"cast('0x' || substr(md5(concat_ws('|', listing_key, '{salt}')), 1, 8) AS BIGINT)"


ORACLE = {
    "clip_ranges": LISTED
    + """SELECT listing_key,
      CASE WHEN listing_price < 10 THEN 1e1 WHEN listing_price > 10000 THEN 1e4 ELSE listing_price END AS listing_price,
      least(greatest(bedrooms * 4e0 - 2e0, 0e0), 15e0) AS bedrooms,
      round(least(greatest(cleanliness_rating + 3e0, 0e0), 1e1), 9) AS cleanliness_rating,
      round(occupancy_rate, 9) AS occupancy_rate, days_in_period FROM listings""",
    "clip_to_column": LISTED
    + """SELECT listing_key, days_in_period,
      round(CASE WHEN days_booked * 1.3e0 - 5e0 < 0 THEN 0e0
                 WHEN days_booked * 1.3e0 - 5e0 > days_in_period THEN days_in_period
                 ELSE days_booked * 1.3e0 - 5e0 END, 9) AS days_booked FROM listings""",
    "clip_binary": LISTED
    + """SELECT listing_key, host_is_superhost, multi, 1 AS biz, weekend FROM listings""",
    "bool_flags": LISTED
    + """SELECT listing_key, CASE WHEN biz = 1 THEN NULL ELSE host_is_superhost END AS host_is_superhost,
      CASE WHEN weekend = 1 THEN 1 END AS weekend, CASE WHEN multi = 1 THEN 2 ELSE 0 END AS multi, biz FROM listings""",
    "tolerant_casts": LISTED
    + """SELECT listing_key, CASE WHEN biz = 0 THEN days_booked END AS days_booked,
      CASE WHEN multi = 0 THEN person_capacity END AS person_capacity, cast(NULL AS DOUBLE) AS bedrooms FROM listings""",
    "sanitize_categories": LISTED
    + """SELECT CASE WHEN biz = 1 THEN 'unknown' ELSE lower(room_type) || '_' || season END AS category,
      count(*) AS listing_count FROM listings GROUP BY ALL""",
    "segment_key_roundtrip": LISTED
    + """SELECT city || '_' || season || '_season_' || CASE weekend WHEN 1 THEN 'weekend' ELSE 'weekday' END AS segment_key,
      count(*) AS listing_count, city, season, weekend,
      season || '_season_' || CASE weekend WHEN 1 THEN 'weekend' ELSE 'weekday' END AS segment_name
      FROM listings GROUP BY ALL""",
    "safe_fill": LISTED
    + """SELECT listing_key, CASE WHEN biz = 1 OR multi = 1 THEN -1e0 ELSE bedrooms END AS bedrooms,
      CASE WHEN biz = 1 OR multi = 1 THEN 0e0 ELSE metro_dist END AS metro_dist FROM listings""",
    "label_rows": LISTED + "SELECT listing_key, round(occupancy_rate, 9) AS label FROM listings WHERE biz = 0",
    "market_filter": LISTED
    + """SELECT listing_key, city, season, weekend, listing_price FROM listings
      WHERE city = 'nation_7' AND season = 'shoulder' AND weekend = 1""",
    "listing_features": FEATURED
    + "SELECT listing_key, capacity_bin, is_weekend, host_is_superhost, multi, biz, "
    + r("log_price price_per_person price_per_bedroom quality_score price_x_satisfaction price_per_dist_km log_metro_dist log_bookings", 9)
    + " FROM features",
    "one_hot": FEATURED
    + "SELECT listing_key, "
    + ", ".join(
        [
            _hot("room_type", **ROOMS),
            _hot("season", high="high", low="low", shoulder="shoulder"),
            ", ".join(f"cast(capacity_bin LIKE '{n}%' AS INT) AS cat_capacity_bin_{n}" for n in "12345"),
        ]
    )
    + " FROM features",
    "reverse_one_hot": LISTED + "SELECT listing_key, city, season, weekend FROM listings",
    "one_hot_apply": LISTED
    + "SELECT listing_key, "
    + _hot("room_type", **{n: v for n, v in ROOMS.items() if v < "PROMO"})
    + " FROM listings",
    "segment_stats": STATED
    + "SELECT city, season, weekend, segment_listing_count, "
    + r("segment_avg_price segment_price_std segment_median_price segment_p90_price segment_p10_price segment_price_spread")
    + " FROM stats",
    "segment_dataset": FEATURED
    + """SELECT city, season, weekend, count(*) AS listing_count, round(avg(listing_price), 6) AS avg_price,
      round(stddev_samp(listing_price), 6) AS std_price,
      round(quantile_disc(listing_price, 0.5), 6) AS median_price,
      round(quantile_disc(listing_price, 0.1), 6) AS p10_price,
      round(quantile_disc(listing_price, 0.9), 6) AS p90_price,
      round(avg(guest_satisfaction_overall), 6) AS avg_satisfaction, round(avg(cleanliness_rating), 6) AS avg_cleanliness,
      round(avg(city_center_dist), 6) AS avg_city_center_dist, round(avg(metro_dist), 6) AS avg_metro_dist,
      round(avg(person_capacity), 6) AS avg_capacity, round(avg(bedrooms), 6) AS avg_bedrooms,
      round(avg(price_per_person), 6) AS avg_price_per_person, round(avg(quality_score), 6) AS avg_quality_score,
      round(avg(host_is_superhost), 6) AS host_is_superhost_rate, round(avg(biz), 6) AS biz_rate,
      round(avg(multi), 6) AS multi_rate, round(avg(n_bookings), 6) AS avg_bookings,
      round(ln(1e0 + count(*)), 6) AS log_demand FROM features GROUP BY city, season, weekend""",
    "iqr_bounds": FEATURED
    + """, q AS (SELECT city, season, weekend, quantile_disc(price_per_bedroom, 0.25) AS q1,
      quantile_disc(price_per_bedroom, 0.75) AS q3 FROM features GROUP BY ALL)
      SELECT city, season, weekend, round(q1, 9) AS q1, round(q3, 9) AS q3, round(q3 - q1, 9) AS iqr,
      round(q1 - 1.5e0 * (q3 - q1), 9) AS lower_bound, round(q3 + 1.5e0 * (q3 - q1), 9) AS upper_bound FROM q""",
    "outlier_filter": FEATURED
    + """, q AS (SELECT city, season, weekend, quantile_disc(price_per_bedroom, 0.25) AS q1,
      quantile_disc(price_per_bedroom, 0.75) AS q3 FROM features GROUP BY ALL)
      SELECT listing_key, city, season, weekend, round(price_per_bedroom, 9) AS price_per_bedroom
      FROM features JOIN q USING (city, season, weekend)
      WHERE price_per_bedroom BETWEEN q1 - 1.5e0 * (q3 - q1) AND q3 + 1.5e0 * (q3 - q1)""",
    "outlier_report": FEATURED
    + """, q AS (SELECT city, season, weekend, quantile_disc(price_per_bedroom, 0.25) AS q1,
      quantile_disc(price_per_bedroom, 0.75) AS q3 FROM features GROUP BY ALL),
      c AS (SELECT count(*) AS rows_before, cast(sum(CASE WHEN price_per_bedroom
        BETWEEN q1 - 1.5e0 * (q3 - q1) AND q3 + 1.5e0 * (q3 - q1) THEN 1 ELSE 0 END) AS BIGINT) AS rows_after
        FROM features JOIN q USING (city, season, weekend))
      SELECT rows_before, rows_after, rows_before - rows_after AS rows_removed,
      round(1e2 * (rows_before - rows_after) / rows_before, 6) AS pct_removed FROM c""",
    "competition_features": STATED
    + "SELECT listing_key, segment_listing_count, "
    + r("segment_avg_price segment_price_std segment_median_price segment_p90_price segment_p10_price segment_price_spread")
    + """, round(listing_price / greatest(segment_median_price, 1e0), 9) AS price_vs_segment_median,
      round(listing_price / greatest(segment_avg_price, 1e0), 6) AS price_vs_segment_avg,
      round(segment_price_spread / greatest(segment_median_price, 1e0), 9) AS relative_price_volatility
      FROM features JOIN stats USING (city, season, weekend)""",
    "column_profile": FEATURED
    + """, v AS (SELECT CASE WHEN biz = 0 THEN price_per_dist_km END AS v FROM features)
      SELECT count(v) AS total_listings, count(*) - count(v) AS null_count, count(DISTINCT v) AS unique_values,
      round(avg(v), 6) AS mean_value, round(stddev_samp(v), 6) AS std_value, round(min(v), 9) AS min_value,
      round(max(v), 9) AS max_value FROM v""",
    "summary_table": FEATURED
    + """, v AS (SELECT unnest(['listing_price', 'price_per_bedroom', 'quality_score', 'occupancy_rate']) AS column_name,
      unnest([listing_price, price_per_bedroom, quality_score, occupancy_rate]) AS v FROM features)
      SELECT column_name, count(v) AS row_count, round(avg(v), 6) AS mean_value, round(stddev_samp(v), 6) AS std_value,
      round(min(v), 9) AS min_value, round(max(v), 9) AS max_value, round(quantile_disc(v, 0.25), 9) AS p25,
      round(quantile_disc(v, 0.5), 9) AS p50, round(quantile_disc(v, 0.75), 9) AS p75 FROM v GROUP BY column_name""",
    "segment_breakdown": FEATURED
    + """SELECT city, season, weekend, count(*) AS listing_count, round(avg(price_per_person), 6) AS avg_value,
      round(min(price_per_person), 9) AS min_value, round(max(price_per_person), 9) AS max_value
      FROM features GROUP BY ALL ORDER BY city, season, weekend""",
    "avg_price_by_city_season": CLIPPED
    + "SELECT city, season, round(avg(listing_price), 6) AS avg_price FROM clipped GROUP BY ALL ORDER BY avg_price",
    "market_size": CLIPPED
    + """SELECT city, season, round(sum(listing_price * occupancy_rate), 3) AS total_market_value,
      count(*) AS listing_count, round(avg(listing_price), 6) AS avg_price FROM clipped GROUP BY ALL ORDER BY avg_price""",
    "preview": CLIPPED
    + """SELECT city, season, round(sum(listing_price * occupancy_rate), 3) AS total_market_value,
      cast(count(*) AS INT) AS listing_count, round(avg(listing_price), 6) AS avg_price FROM clipped GROUP BY ALL
      ORDER BY avg(listing_price), city, season LIMIT 2000""",
    "market_profile": CLIPPED
    + """SELECT city, round(quantile_disc(listing_price, 0.5), 6) AS median_price,
      round(quantile_disc(person_capacity, 0.5), 6) AS median_capacity,
      round(quantile_disc(bedrooms, 0.5), 6) AS median_bedrooms,
      round(quantile_disc(cleanliness_rating, 0.5), 6) AS median_cleanliness,
      round(quantile_disc(guest_satisfaction_overall, 0.5), 6) AS median_satisfaction,
      round(quantile_disc(city_center_dist, 0.5), 6) AS median_city_dist,
      round(quantile_disc(metro_dist, 0.5), 6) AS median_metro_dist FROM clipped GROUP BY city""",
    "pricing_segment_stats": STATED
    + "SELECT city, season, weekend, segment_listing_count AS listing_count, "
    + r("segment_avg_price segment_price_std segment_median_price segment_p90_price segment_p10_price segment_price_spread avg_days_in_period")
    + """, round(CASE WHEN segment_avg_price > 0 THEN segment_price_std / segment_avg_price ELSE 0e0 END, 6)
      AS segment_relative_price_volatility FROM stats""",
    "days_per_segment": LISTED
    + """, d AS (SELECT city, season, weekend,
      coalesce(avg(CASE WHEN NOT (season = 'low' AND weekend = 1) THEN days_in_period END),
        CASE season WHEN 'high' THEN 12e1 WHEN 'shoulder' THEN 15e1 ELSE 95e0 END
        * CASE weekend WHEN 1 THEN 2e0 / 7e0 ELSE 5e0 / 7e0 END) AS days FROM listings GROUP BY city, season, weekend)
      SELECT city, season, weekend, round(days, 6) AS days_in_segment,
      abs(sum(days) OVER (PARTITION BY city) - 365e0) <= 1e1 AS plausible_year FROM d""",
    "distinct_values": FEATURED
    + """SELECT DISTINCT unnest(['room_type', 'city', 'season', 'capacity_bin']) AS column_name,
      unnest([room_type, city, season, capacity_bin]) AS category FROM features""",
    "price_deciles": CLIPPED
    + "SELECT city, count(*) AS listing_count, round(avg(listing_price), 6) AS avg_price, "
    + ", ".join(f"round(quantile_disc(listing_price, {i / 10}), 6) AS p{10 * i}" for i in range(1, 10))
    + " FROM clipped GROUP BY city",
    "feature_dataset": STATED
    + """SELECT listing_key, city, season, weekend, cast(season = 'high' AS INT) AS cat_season_high,
      cast(season = 'low' AS INT) AS cat_season_low, cast(season = 'shoulder' AS INT) AS cat_season_shoulder,
      segment_listing_count, round(quality_score, 9) AS quality_score, round(price_per_bedroom, 9) AS price_per_bedroom, """
    + r("segment_avg_price segment_price_std segment_median_price segment_p90_price segment_p10_price segment_price_spread")
    + """, round(listing_price / greatest(segment_median_price, 1e0), 9) AS price_vs_segment_median,
      round(listing_price / greatest(segment_avg_price, 1e0), 6) AS price_vs_segment_avg,
      round(segment_price_spread / greatest(segment_median_price, 1e0), 9) AS relative_price_volatility
      FROM features JOIN stats USING (city, season, weekend)""",
    "price_bins": BINNED + f"SELECT {SEG}, bin, n, {r('x y')} FROM bins",
    "segment_ols": BINNED
    + f"""SELECT {SEG}, count(*) AS n_bins, round(CASE WHEN var_pop(x) > 0 THEN regr_slope(y, x) END, 6) AS slope,
      round(CASE WHEN var_pop(x) > 0 THEN regr_intercept(y, x) END, 6) AS intercept,
      round(CASE WHEN var_pop(x) > 0 THEN regr_r2(y, x) END, 6) AS r_squared FROM bins GROUP BY {SEG}""",
    "breakpoint_search": FITTED
    + f"""SELECT {SEG}, greatest(side, 1) AS regime, price_regime, n_bins,
      {r('slope intercept r_squared breakpoint_log_price')} FROM fit""",
    "slope_classes": _with(LISTINGS_SQL, CLIPPED_SQL, BINS_SQL, _fit("true"))
    + """SELECT city || '_' || season || '_season_' || CASE weekend WHEN 1 THEN 'weekend' ELSE 'weekday' END AS segment,
      side AS regime, CASE WHEN slope > 0.15e0 THEN 'positive' WHEN slope >= -0.15e0 THEN 'highly_inelastic'
        WHEN slope > -0.95e0 THEN 'inelastic' WHEN slope >= -1.05e0 THEN 'unit_elastic' ELSE 'elastic' END AS regime_type,
      round(slope, 6) AS slope, round(r_squared, 6) AS r_squared, n_bins,
      CASE side WHEN 1 THEN 'lower' ELSE 'upper' END AS price_range FROM fit""",
    "elasticity_flatten": FITTED
    + f"""SELECT {SEG}, price_regime, round(slope, 6) AS elasticity_slope,
      round(breakpoint_log_price, 6) AS breakpoint_log_price FROM fit WHERE slope IS NOT NULL""",
    "elasticity_json": FITTED
    + f""", slopes AS (SELECT city, season, weekend, side, round(slope, 6) AS slope, round(breakpoint_log_price, 6) AS bp
        FROM fit WHERE slope IS NOT NULL),
      parts AS (SELECT city, city || '_' || season || '_season_' || CASE weekend WHEN 1 THEN 'weekend' ELSE 'weekday' END AS key, max(bp) AS bp,
          string_agg('{{"slope":' || {_json_number("slope")} || '}}', ',' ORDER BY side) AS regimes FROM slopes GROUP BY city, season, weekend)
      SELECT city, '{{' || string_agg('"' || key || '":{{' || coalesce('"breakpoint_log_price":' || {_json_number("bp")} || ',', '')
        || '"regimes":[' || regimes || ']}}', ',' ORDER BY key) || '}}' AS value FROM parts GROUP BY city""",
    "regime_lookup": LOOKED_UP
    + """SELECT listing_key, city, season, weekend,
      round(coalesce(slope_all, CASE WHEN log_price < bp THEN slope_low ELSE slope_high END), 6) AS elasticity_slope
      FROM features LEFT JOIN regimes USING (city, season, weekend)""",
    "impute_slope": LOOKED_UP
    + """, known AS (SELECT listing_key, city, season, weekend, coalesce(slope_all, CASE WHEN log_price < bp THEN slope_low
        WHEN weekend = 0 THEN slope_high END) AS s FROM features LEFT JOIN regimes USING (city, season, weekend))
      SELECT listing_key, city, season, weekend,
      round(coalesce(s, avg(s) OVER (PARTITION BY city, season, weekend)), 6) AS elasticity_slope FROM known""",
    "hash_split": LISTED
    + f"SELECT listing_key, CASE WHEN {_hash(42)} % 10000 < 8000 THEN 'train' ELSE 'test' END AS split FROM listings",
    "three_way_split": LISTED
    + f"""SELECT listing_key, CASE WHEN {_hash(42)} % 10000 < 2000 THEN 'test'
      WHEN {_hash(43)} % 10000 < 1250 THEN 'validation' ELSE 'train' END AS split FROM listings""",
    "chunk_split": LISTED
    + f"""SELECT cast({_hash(45)} % 5 AS INT) AS chunk, count(*) AS listing_count, min(listing_key) AS first_key,
      max(listing_key) AS last_key FROM listings GROUP BY 1""",
    "top_k": CLIPPED
    + "SELECT listing_key, city, listing_price FROM clipped ORDER BY listing_price DESC, listing_key LIMIT 25",
    "hash_sample_topn": LISTED
    + f"SELECT listing_key, city, listing_price FROM listings ORDER BY {_hash(42)}, listing_key LIMIT 100",
    "season_order": LISTED
    + """SELECT city, season, weekend, count(*) AS listing_count,
      CASE season WHEN 'high' THEN 0 WHEN 'shoulder' THEN 1 ELSE 2 END AS season_rank
      FROM listings GROUP BY city, season, weekend ORDER BY city, season_rank, weekend""",
    "representative_property": _with(LISTINGS_SQL, CLIPPED_SQL, MEDIANS_SQL)
    + """SELECT city, 1 AS host_is_superhost, 0 AS multi, 0 AS biz, 'STANDARD' AS room_type,
      CASE WHEN person_capacity >= 5 THEN '5+' ELSE cast(cast(person_capacity AS INT) AS VARCHAR) END AS capacity_bin,
      round(listing_price, 9) AS listing_price, person_capacity, bedrooms, round(cleanliness_rating, 9) AS cleanliness_rating,
      round(guest_satisfaction_overall, 9) AS guest_satisfaction_overall, city_center_dist, metro_dist,
      round(ln(1e0 + metro_dist), 9) AS log_metro_dist,
      round(least(1e2, greatest(0e0, guest_satisfaction_overall * 0.5e0 + cleanliness_rating * 0.3e0
        + greatest(0e0, 5e0 - city_center_dist) * 4e0)), 9) AS quality_score FROM property""",
    "price_grid": _curved(500)
    + f"SELECT {SEG}, segment_name, candidate_id, grid_index, round(price, 9) AS price FROM curve",
    "reprice_features": _repriced(
        "p * guest_satisfaction_overall / 1e2", "(city_center_dist + 0.1e0)", "p / greatest({}, 1e0)",
        "segment_price_spread / greatest(segment_median_price, 1e0)",
    ),
    "reprice_features_serving": _repriced(
        "p * guest_satisfaction_overall", "greatest(city_center_dist, 0.1e0)", "(p - {0}) / greatest({0}, 1e0)",
        "CASE WHEN segment_avg_price > 0 THEN segment_price_std / segment_avg_price ELSE 0e0 END",
    ),
    "demand_curve": _curved(500)
    + f"""SELECT {SEG}, candidate_id, round(price, 9) AS price, round(occ, 6) AS predicted_occupancy,
      round(daily, 6) AS daily_revenue, round(slope, 6) AS elasticity_slope FROM curve""",
    "annual_revenue": _curved(500)
    + f"""SELECT {SEG}, candidate_id, round(days, 6) AS days_in_segment, round(daily * days, 4) AS annual_revenue
      FROM curve""",
    "optimal_prices": SOLVED
    + f"""SELECT {SEG}, grid_index, round(price, 9) AS price, round(occ, 6) AS predicted_occupancy,
      round(annual, 4) AS annual_revenue FROM solved""",
    "solution_status": SOLVED
    + """SELECT city, CASE WHEN n > 0 THEN 'Optimal' ELSE 'Infeasible' END AS status
      FROM (SELECT c.city, count(p.city) AS n FROM (SELECT DISTINCT city FROM curve) c LEFT JOIN pick p ON c.city = p.city
        GROUP BY c.city)""",
    "lift_report": SOLVED
    + f"""SELECT {SEG}, segment_name, round((price - p0) / p0 * 1e2, 5) + 0e0 AS price_change_pct,
      round((occ - o0) / o0 * 1e2, 5) + 0e0 AS occupancy_change_pct,
      round((annual - base_annual) / base_annual * 1e2, 5) + 0e0 AS revenue_lift_pct,
      round(base_annual, 4) AS baseline_annual_revenue, round(annual, 4) AS annual_revenue,
      round(annual - base_annual, 4) + 0e0 AS revenue_lift FROM solved""",
    "portfolio_kpis": SOLVED
    + """SELECT city, round(sum(base_annual), 4) AS baseline_annual_revenue, round(sum(annual), 4) AS annual_revenue,
      round(sum(annual - base_annual), 4) AS revenue_lift,
      round(sum(annual - base_annual) / sum(base_annual) * 1e2, 4) AS revenue_lift_pct,
      round(sum(p0 * days) / sum(days), 4) AS baseline_weighted_price,
      round(sum(price * days) / sum(days), 4) AS optimal_weighted_price,
      round(avg(o0), 4) AS baseline_avg_occupancy, round(avg(occ), 4) AS optimal_avg_occupancy,
      round(avg((price - p0) / p0 * 1e2), 4) AS avg_price_change_pct,
      round(avg((occ - o0) / o0 * 1e2), 4) AS avg_occupancy_change_pct FROM solved GROUP BY city""",
    "weekend_premium": SOLVED
    + """SELECT city, round(avg(CASE WHEN weekend = 1 THEN price END), 5) AS weekend_price,
      round(avg(CASE WHEN weekend = 0 THEN price END), 5) AS weekday_price,
      round((avg(CASE WHEN weekend = 1 THEN price END) / avg(CASE WHEN weekend = 0 THEN price END) - 1e0) * 1e2, 5) AS premium_pct,
      arg_max(segment_name, (annual - base_annual) / base_annual) AS best_segment,
      round(max((annual - base_annual) / base_annual * 1e2), 5) AS best_lift_pct FROM solved GROUP BY city""",
    "standardise": FEATURED
    + "SELECT listing_key, "
    + ", ".join(
        f"round(({c} - avg({c}) OVER ()) / stddev_samp({c}) OVER (), 6) AS {c}_scaled"
        for c in ("listing_price", "quality_score", "price_per_person")
    )
    + " FROM features",
    "linear_fit": CLIPPED
    + """, c AS (SELECT avg(listing_price) AS mp, avg(n_bookings) AS mb, avg(occupancy_rate) AS my,
        var_pop(listing_price) AS pp, var_pop(n_bookings) AS bb, covar_pop(listing_price, n_bookings) AS pb,
        covar_pop(occupancy_rate, listing_price) AS yp, covar_pop(occupancy_rate, n_bookings) AS yb FROM clipped),
      s AS (SELECT *, (yp * bb - yb * pb) / (pp * bb - pb * pb) AS cp, (yb * pp - yp * pb) / (pp * bb - pb * pb) AS cb FROM c)
      SELECT 'intercept' AS term, round(my - cp * mp - cb * mb, 6) AS coefficient FROM s
      UNION ALL SELECT 'listing_price', round(cp, 6) FROM s UNION ALL SELECT 'n_bookings', round(cb, 6) FROM s""",
    "regression_metrics": CLIPPED
    + """, g AS (SELECT season, occupancy_rate AS y, 0.9e0 - 0.0004e0 * listing_price AS p FROM clipped)
      SELECT season, round(sqrt(avg((p - y) * (p - y))), 6) AS rmse, round(avg(abs(p - y)), 6) AS mae,
      round(1e0 - avg((p - y) * (p - y)) / var_pop(y), 6) AS r2 FROM g GROUP BY season""",
    "log_scale_metrics": CLIPPED
    + """, g AS (SELECT season, occupancy_rate AS y, 0.9e0 - 0.0004e0 * listing_price AS p FROM clipped),
      l AS (SELECT *, ln(1e0 + y) AS ly, ln(1e0 + p) AS lp FROM g)
      SELECT season, round(sqrt(avg((p - y) * (p - y))), 6) AS rmse, round(avg(abs(p - y)), 6) AS mae,
      round(1e0 - avg((p - y) * (p - y)) / var_pop(y), 6) AS r2,
      round(avg((lp - ly) * (lp - ly)), 6) AS log_mse FROM l GROUP BY season""",
    "prepared_listings": _with(LISTINGS_SQL, CLIPPED_SQL, FEATURES_SQL, STATS_SQL)
    + """, quarts AS (SELECT city, season, weekend, quantile_disc(price_per_bedroom, 0.25) AS q1,
        quantile_disc(price_per_bedroom, 0.75) AS q3 FROM features GROUP BY ALL),
      inliers AS (SELECT * FROM features JOIN quarts USING (city, season, weekend)
        WHERE price_per_bedroom BETWEEN q1 - 1.5e0 * (q3 - q1) AND q3 + 1.5e0 * (q3 - q1)), """
    + ", ".join([BINS_SQL.replace("FROM clipped", "FROM inliers").strip(), FIT_SQL.strip(), REGIMES_SQL.strip()])
    + """
      SELECT listing_key, city, season, weekend, cast(season = 'high' AS INT) AS cat_season_high, segment_listing_count,
      round(segment_avg_price, 6) AS segment_avg_price, round(price_per_bedroom, 9) AS price_per_bedroom,
      round(listing_price / greatest(segment_median_price, 1e0), 9) AS price_vs_segment_median,
      round(coalesce(slope_all, CASE WHEN log_price < bp THEN slope_low ELSE slope_high END), 6) AS elasticity_slope
      FROM inliers JOIN stats USING (city, season, weekend) JOIN regimes USING (city, season, weekend)""",
    "ingest_csv": LISTED
    + """SELECT listing_key, listing_price, room_type, CASE WHEN biz = 0 THEN host_is_superhost END AS host_is_superhost,
      weekend, multi, biz, days_booked, season FROM listings""",
    "elasticity_files": FITTED
    + f"""SELECT {SEG}, price_regime, round(slope, 6) AS elasticity_slope,
      round(breakpoint_log_price, 6) AS breakpoint_log_price FROM fit WHERE slope IS NOT NULL""",
    "segment_frame": """SELECT lower(n_name) AS city, season, weekend,
      season || '_season_' || CASE weekend WHEN 1 THEN 'weekend' ELSE 'weekday' END AS segment_name
      FROM (SELECT DISTINCT n_name FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)
      CROSS JOIN (VALUES ('high'), ('shoulder'), ('low')) AS s(season) CROSS JOIN (VALUES (0), (1)) AS w(weekend)""",
}

_EXPORTED = {"baseline_price": ("p0", 2), "optimal_price": ("price", 2), "price_change_pct": ("(price - p0) / p0 * 1e2", 1),
    "baseline_occupancy": ("o0", 4), "predicted_occupancy": ("occ", 4), "occupancy_change_pct": ("(occ - o0) / o0 * 1e2", 1),
    "baseline_annual_revenue": ("base_annual", 2), "annual_revenue": ("annual", 2), "revenue_lift": ("annual - base_annual", 2),
    "revenue_lift_pct": ("(annual - base_annual) / base_annual * 1e2", 1), "elasticity_slope": ("slope", 3)}
ORACLE["price_schedule"] = (
    SOLVED + f"SELECT {SEG}, segment_name, days AS days_in_segment, "
    + ", ".join(f"round_even({e}, {d}) + 0e0 AS {c}" for c, (e, d) in _EXPORTED.items()) + " FROM solved"
)
ORACLE |= {f"{name}_full_grid": ORACLE[name] for name in ("optimal_prices", "solution_status", "lift_report", "portfolio_kpis", "weekend_premium")}

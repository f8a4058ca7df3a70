"""Price elasticity of demand per segment: bins, one-breakpoint fits, documents and lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodgecurve.functions.response import slope_at
from lodgecurve.functions.values import parse_segment_key, segment_key
from lodgecurve.operators.scale import join_measured, materialise, open_cells, ranked_cells, value_cells
from lodgecurve.schemas import ELASTICITY_DOCUMENT_SCHEMA, SEGMENT_COLS

BINS = 20
MIN_BINS = 3

# Slopes that separate the elasticity classes.
POSITIVE_ABOVE = 0.15
HIGHLY_INELASTIC_WITHIN = 0.15
UNIT_WITHIN = 0.05


def slope_class(slope: Column) -> Column:
    """Name of the demand reaction a slope stands for."""
    return (
        F.when(slope > POSITIVE_ABOVE, "positive")
        .when(slope >= -HIGHLY_INELASTIC_WITHIN, "highly_inelastic")
        .when(slope > -1.0 + UNIT_WITHIN, "inelastic")
        .when(slope >= -1.0 - UNIT_WITHIN, "unit_elastic")
        .when(slope.isNotNull(), "elastic")
    )


def _last_rank(n: Column, k: Column, bins: int) -> Column:
    """Rank of the last row of bin ``k`` when n rows go to equal bins, longer bins first."""
    return k * F.floor(n / F.lit(bins)).cast("bigint") + F.least(k, F.pmod(n, F.lit(bins)))


def _bin_of(n: Column, rank: Column, bins: int) -> Column:
    """The bin that the row with this rank goes to."""
    short = F.floor(n / F.lit(bins)).cast("bigint")
    longer = F.pmod(n, F.lit(bins))
    in_longer = longer * (short + 1)
    late = longer + F.ceil(F.try_divide(rank - in_longer, short))
    return F.when(rank <= in_longer, F.ceil(rank / (short + 1))).otherwise(late).cast("int")


def _dealt(groups: DataFrame, keys: list[str], bins: int) -> DataFrame:
    """Deal groups of equal prices to bins by rank, in parts where a group straddles an edge.

    A group has ``n`` listings of ``total``, ``below`` cheaper ones, and the sums ``x`` and
    ``occupancy``; a part takes its share of the sums.
    """
    upto = F.col("below") + F.col("n")
    span = F.sequence(_bin_of(F.col("total"), F.col("below") + 1, bins), _bin_of(F.col("total"), upto, bins))
    first, last = (_last_rank(F.col("total"), F.col("bin") - back, bins) for back in (1, 0))
    part = F.least(last, upto) - F.greatest(first, F.col("below"))
    return groups.withColumn("bin", F.explode(span)).withColumn("part", part).select(
        *keys, "bin", F.col("part").alias("n"),
        (F.col("x") * F.col("part") / F.col("n")).alias("x"),
        (F.col("occupancy") * F.col("part") / F.col("n")).alias("occupancy"),
    )


def price_cells(
    df: DataFrame, keys: list[str] = SEGMENT_COLS, price: str = "listing_price", occupancy: str = "occupancy_rate"
) -> DataFrame:
    """Listings with a price, summed by segment, cell of prices and whether their occupancy is known, and stored.

    Price bins and quantiles of the price both start from these, so one pass serves both.
    """
    known = df.where(F.col(price).isNotNull()).select(
        *keys, F.col(occupancy).isNotNull().alias("__known"), price, F.col(occupancy).cast("double").alias("__occupancy")
    )
    sums = [F.sum(F.log1p(F.col(price).cast("double"))).alias("x"), F.sum("__occupancy").alias("occupancy")]
    return materialise(value_cells(known, [*keys, "__known"], price, sums))


def price_bins(
    df: DataFrame,
    keys: list[str] = SEGMENT_COLS,
    price: str = "listing_price",
    occupancy: str = "occupancy_rate",
    bins: int = BINS,
    cells: DataFrame | None = None,
) -> DataFrame:
    """Equal-count price bins per segment with mean log price ``x`` and log mean occupancy ``y``.

    Listings of one price that straddle a bin edge are shared out by count, each standing for
    the mean occupancy at that price, so the result depends on no tie-break. Listings are summed
    by cells of prices first, while the plan is built; only cells of several prices that straddle
    an edge are read again and told apart by price, so hold ``df`` if it is dear. ``cells`` are the
    ``price_cells`` of ``df``, where they were summed already.
    """
    known = df.where(F.col(price).isNotNull() & F.col(occupancy).isNotNull()).select(
        *keys, F.col(price).cast("double").alias("price"), F.col(occupancy).cast("double").alias("occupancy")
    )
    sums = [F.sum(F.log1p("price")).alias("x"), F.sum("occupancy").alias("occupancy")]
    summed = value_cells(known, keys, "price", sums) if cells is None else cells.where("__known").drop("__known")
    cells = materialise(ranked_cells(summed, keys))
    one_bin = _bin_of(F.col("total"), F.col("below") + 1, bins) == _bin_of(F.col("total"), F.col("below") + F.col("__n"), bins)
    whole = one_bin | F.col("__lo").eqNullSafe(F.col("__hi"))
    columns = [*keys, F.col("__n").alias("n"), "below", "total", "x", "occupancy"]
    groups = cells.where(whole).select(columns).unionByName(open_cells(known, cells.where(~whole), keys, "price", sums).select(columns))
    parts = _dealt(groups, keys, bins)
    count = F.sum("n")
    return (
        parts.groupBy(*keys, "bin")
        .agg(count.alias("n"), (F.sum("x") / count).alias("x"), (F.sum("occupancy") / count).alias("mean_occupancy"))
        .withColumn("y", F.ln("mean_occupancy"))
    )


def segment_ols(bins: DataFrame, keys: list[str] = SEGMENT_COLS) -> DataFrame:
    """One log-log line per segment."""
    return bins.groupBy(*keys).agg(
        F.regr_slope("y", "x").alias("slope"),
        F.regr_intercept("y", "x").alias("intercept"),
        F.regr_r2("y", "x").alias("r_squared"),
        F.regr_count("y", "x").alias("n_bins"),
    )


def _line_error(s: dict[str, Column]) -> Column:
    """Squared error of the best line, from the sums of a set of points."""
    sxx = s["xx"] - s["x"] * s["x"] / s["n"]
    sxy = s["xy"] - s["x"] * s["y"] / s["n"]
    syy = s["yy"] - s["y"] * s["y"] / s["n"]
    return F.greatest(syy - F.coalesce(F.try_divide(sxy * sxy, sxx), F.lit(0.0)), F.lit(0.0))


def breakpoint_fit(bins: DataFrame, keys: list[str] = SEGMENT_COLS, min_bins: int = MIN_BINS, force_two: bool = False) -> DataFrame:
    """One or two log-log lines per segment, split after the bin that leaves the least error.

    Two lines need ``min_bins`` bins each and, unless ``force_two``, a lower Bayes information
    criterion than one line (five parameters against two). The breakpoint is the midpoint
    between the bins next to the split. A segment has at most a few dozen bins, so windows over
    segments stay short however many listings a segment has.
    """
    segment = Window.partitionBy(*keys)
    ordered = segment.orderBy("bin")
    upto = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    points = (
        bins.where(F.col("x").isNotNull() & F.col("y").isNotNull())
        .withColumns({"cx": F.col("x") - F.avg("x").over(segment), "cy": F.col("y") - F.avg("y").over(segment)})
    )
    terms = {
        "n": F.lit(1.0),
        "x": F.col("cx"),
        "y": F.col("cy"),
        "xx": F.col("cx") * F.col("cx"),
        "xy": F.col("cx") * F.col("cy"),
        "yy": F.col("cy") * F.col("cy"),
    }
    left = {k: F.sum(t).over(upto) for k, t in terms.items()}
    total = {k: F.sum(t).over(segment) for k, t in terms.items()}
    summed = points.withColumns(
        {f"l_{k}": c for k, c in left.items()}
        | {f"t_{k}": c for k, c in total.items()}
        | {"k": F.row_number().over(ordered), "next_x": F.lead("x").over(ordered)}
    )
    lsums = {k: F.col(f"l_{k}") for k in terms}
    tsums = {k: F.col(f"t_{k}") for k in terms}
    rsums = {k: tsums[k] - lsums[k] for k in terms}
    n = F.col("t_n")
    allowed = (F.col("k") >= min_bins) & (n - F.col("k") >= min_bins)
    candidate = F.when(
        allowed,
        F.struct((_line_error(lsums) + _line_error(rsums)).alias("error"), F.col("k").alias("k"),
                 ((F.col("x") + F.col("next_x")) / 2.0).alias("breakpoint")),
    )
    tiny = F.lit(1e-300)
    one = n * F.ln(F.greatest(_line_error(tsums), tiny) / n) + 2.0 * F.ln(n)
    two = n * F.ln(F.greatest(F.col("best.error"), tiny) / n) + 5.0 * F.ln(n)
    splits = F.col("best").isNotNull()
    pays = splits if force_two else splits & (two < one)
    split = (
        summed.withColumn("candidate", candidate)
        .withColumn("best", F.min("candidate").over(segment))
        .withColumn("regime", F.when(~pays, 0).when(F.col("k") <= F.col("best.k"), 1).otherwise(2))
    )
    fitted = split.groupBy(*keys, "regime").agg(
        F.regr_slope("y", "x").alias("slope"),
        F.regr_intercept("y", "x").alias("intercept"),
        F.regr_r2("y", "x").alias("r_squared"),
        F.count(F.lit(1)).alias("n_bins"),
        F.max(F.when(F.col("regime") > 0, F.col("best.breakpoint"))).alias("breakpoint_log_price"),
    )
    pick = lambda zero, first, second: (
        F.when(F.col("regime") == 0, zero).when(F.col("regime") == 1, first).otherwise(second)
    )
    return fitted.select(
        *keys,
        F.greatest("regime", F.lit(1)).alias("regime"),
        pick("all", "low", "high").alias("price_regime"),
        pick("all", "lower", "upper").alias("price_range"),
        slope_class(F.col("slope")).alias("regime_type"),
        "slope", "intercept", "r_squared", "n_bins", "breakpoint_log_price",
    )


def elasticity_summary(fit: DataFrame) -> DataFrame:
    """The fitted regimes under their segment keys."""
    return fit.select(
        segment_key(F.col("city"), F.col("season"), F.col("weekend")).alias("segment"),
        "regime", "regime_type", "slope", "r_squared", "n_bins", "price_range",
    )


def elasticity_rows(fit: DataFrame) -> DataFrame:
    """The fitted regimes as elasticity rows."""
    return fit.where(F.col("slope").isNotNull()).select(
        *SEGMENT_COLS, "price_regime", F.col("slope").alias("elasticity_slope"), "breakpoint_log_price"
    )


def elasticity_documents(rows: DataFrame) -> DataFrame:
    """Nested JSON, one line per city: segment key -> breakpoint and regime slopes, low price first."""
    order = F.when(F.col("price_regime") == "high", 1).otherwise(0)
    segments = rows.groupBy(*SEGMENT_COLS).agg(
        F.max("breakpoint_log_price").alias("breakpoint_log_price"),
        F.sort_array(F.collect_list(F.struct(order.alias("o"), F.col("elasticity_slope").alias("slope")))).alias("r"),
    )
    body = F.struct("breakpoint_log_price", F.transform("r", lambda x: F.struct(x["slope"].alias("slope"))).alias("regimes"))
    key = segment_key(F.col("city"), F.col("season"), F.col("weekend"))
    entries = F.sort_array(F.collect_list(F.struct(key.alias("key"), body.alias("value"))))
    return segments.groupBy("city").agg(F.to_json(F.map_from_entries(entries)).alias("value"))


def flatten_documents(documents: DataFrame, column: str = "value", city: str | None = None) -> DataFrame:
    """Elasticity rows from nested JSON text, one document or one line per city.

    Segments without regimes or with a malformed key are left out. One regime, or two without
    a breakpoint, gives an 'all' row; two give 'low' and 'high'. More than two raise.
    """
    parsed = documents.select(F.explode(F.from_json(column, ELASTICITY_DOCUMENT_SCHEMA)).alias("segment_key", "body"))
    parts = parse_segment_key(F.col("segment_key"))
    count = F.size("body.regimes")
    segments = parsed.select(
        *[c.alias(n) for n, c in parts.items()],
        "body.breakpoint_log_price",
        F.when(count > 2, F.raise_error(F.concat(F.lit("more than two regimes: "), "segment_key")).cast("boolean"))
        .otherwise((count == 2) & F.col("body.breakpoint_log_price").isNotNull()).alias("two"),
        "body.regimes",
    ).where(F.col("city").isNotNull())
    if city is not None:
        segments = segments.where(F.col("city") == city)
    regimes = segments.select(
        *SEGMENT_COLS, "two", "breakpoint_log_price", F.posexplode("regimes").alias("position", "regime")
    )
    regime = F.when(~F.col("two"), "all").when(F.col("position") == 0, "low").otherwise("high")
    return regimes.where((F.col("position") == 0) | F.col("two")).select(
        *SEGMENT_COLS,
        regime.alias("price_regime"),
        F.col("regime.slope").alias("elasticity_slope"),
        F.when(F.col("two"), F.col("breakpoint_log_price")).alias("breakpoint_log_price"),
    )


def regime_table(rows: DataFrame, keys: list[str] = SEGMENT_COLS) -> DataFrame:
    """One row per segment: its only slope, or low and high slope with the breakpoint."""
    slope = lambda regime: F.max(F.when(F.col("price_regime") == regime, F.col("elasticity_slope")))
    return rows.groupBy(*keys).agg(
        slope("all").alias("slope_all"),
        slope("low").alias("slope_low"),
        slope("high").alias("slope_high"),
        F.max(F.when(F.col("price_regime") == "low", F.col("breakpoint_log_price"))).alias("breakpoint_log_price"),
    )


def with_elasticity(df: DataFrame, rows: DataFrame, keys: list[str] = SEGMENT_COLS) -> DataFrame:
    """Add the slope that holds at each listing's ``log_price``."""
    joined = join_measured(df, regime_table(rows, keys), keys, "left")
    slope = slope_at(
        F.col("log_price"), F.col("breakpoint_log_price"), F.col("slope_all"), F.col("slope_low"), F.col("slope_high")
    )
    return joined.withColumn("elasticity_slope", slope).drop("slope_all", "slope_low", "slope_high", "breakpoint_log_price")


def partly_known(rows: DataFrame, keys: list[str] = SEGMENT_COLS) -> DataFrame:
    """The segments in which a price can lie in a regime without a slope."""
    both = F.col("slope_low").isNotNull() & F.col("slope_high").isNotNull()
    return regime_table(rows, keys).where(F.col("slope_all").isNull() & ~both).select(*keys)


def mean_slopes(df: DataFrame, keys: list[str] = SEGMENT_COLS) -> DataFrame:
    """Mean slope of the segments that know some slopes and miss others."""
    slope = F.col("elasticity_slope")
    found = df.groupBy(*keys).agg(F.avg(slope).alias("mean_slope"), F.count_if(slope.isNull()).alias("__missing"))
    return found.where((F.col("__missing") > 0) & F.col("mean_slope").isNotNull()).drop("__missing")


def impute_slope(df: DataFrame, keys: list[str] = SEGMENT_COLS, slopes: DataFrame | None = None) -> DataFrame:
    """Fill missing slopes with the mean of the segment's known ones.

    ``slopes`` has the keys and slopes of the rows of all segments that know some and miss others,
    where those are known beforehand. Nothing is joined where no segment needs it.
    """
    means = materialise(mean_slopes(df if slopes is None else slopes, keys))
    if means.isEmpty():
        return df
    joined = join_measured(df, means, keys, "left", stored=True)
    return joined.withColumn("elasticity_slope", F.coalesce("elasticity_slope", "mean_slope")).drop("mean_slope")

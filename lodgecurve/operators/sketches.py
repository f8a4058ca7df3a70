"""Segment statistics that can be merged: a stored table to which new listings are added without reading old ones.

The table has one row for each part (such as a day) and segment: the count, mean and squared
deviations of a number, and a KLL quantile sketch of it, whose size is set by ``k`` and not by the
rows behind it. Adding a part writes that part's directory and nothing else; adding it again replaces
it. Statistics over any parts merge the rows of the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodgecurve.schemas import SEGMENT_COLS, price_column, require_columns

K = 400  # quantiles lie within about 0.7 % of the wanted rank, 99 times in 100


def segment_sketches(df: DataFrame, segment_cols: list[str] = SEGMENT_COLS, value: str | None = None, k: int = K) -> DataFrame:
    """Count, mean, squared deviations and sketch of ``value`` (the price by default) in each segment; NULL and NaN count as rows only."""
    value = price_column(df) if value is None else value
    require_columns(df, [*segment_cols, value])
    known = F.nanvl(F.col(value).cast("double"), F.lit(None).cast("double"))
    return df.select(*segment_cols, known.alias("__v")).groupBy(*segment_cols).agg(
        F.count(F.lit(1)).alias("listings"), F.count("__v").alias("n"), F.avg("__v").alias("mean"),
        (F.var_pop("__v") * F.count("__v")).alias("squares"), F.kll_sketch_agg_double("__v", F.lit(k)).alias("sketch"),
    )


def add_part(df: DataFrame, path: str, part: str, segment_cols: list[str] = SEGMENT_COLS, value: str | None = None, k: int = K) -> None:
    """Add the listings of one part to the table at ``path``, or replace those it held; other parts are neither read nor written."""
    if not part or "/" in part:
        raise ValueError("a part needs a name without a slash")
    segment_sketches(df, segment_cols, value, k).write.mode("overwrite").parquet(f"{path}/part={part}")


def merged_stats(table: DataFrame, segment_cols: list[str] = SEGMENT_COLS) -> DataFrame:
    """The statistics of ``segments.segment_stats`` over all rows of a table of sketches; quantiles are approximate, the rest exact."""
    mean = F.try_divide(F.sum(F.col("n") * F.col("mean")), F.sum("n"))
    merged = table.groupBy(*segment_cols).agg(
        F.sum("listings").alias("segment_listing_count"), mean.alias("segment_avg_price"), F.sum("n").alias("__n"),
        F.sum("squares").alias("__within"), F.sum(F.col("n") * F.col("mean") * F.col("mean")).alias("__about_zero"),
        F.kll_merge_agg_double(F.when(F.col("n") > 0, F.col("sketch"))).alias("__sketch"),
    )
    between = F.col("__about_zero") - F.col("__n") * F.col("segment_avg_price") * F.col("segment_avg_price")
    deviation = F.sqrt(F.try_divide(F.col("__within") + F.greatest(between, F.lit(0.0)), F.col("__n") - F.lit(1)))
    quantile = lambda p: F.when(F.col("__n") > 0, F.kll_sketch_get_quantile_double("__sketch", F.lit(p)))
    return merged.select(
        *segment_cols, "segment_listing_count", "segment_avg_price", deviation.alias("segment_price_std"),
        quantile(0.5).alias("segment_median_price"), quantile(0.9).alias("segment_p90_price"), quantile(0.1).alias("segment_p10_price"),
    ).withColumn("segment_price_spread", F.col("segment_p90_price") - F.col("segment_p10_price"))

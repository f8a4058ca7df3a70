"""From raw listings to model-ready features."""

from __future__ import annotations

from pyspark.sql import DataFrame

from lodgecurve.operators import cleaning, elasticity, encoding, segments
from lodgecurve.operators.scale import compiled_rows, join_measured, materialise
from lodgecurve.schemas import SEGMENT_COLS

CATEGORIES = ["room_type", "city", "season", "capacity_bin"]


def feature_dataset(
    df: DataFrame,
    segment_cols: list[str] = SEGMENT_COLS,
    encode: bool = True,
    categories: dict[str, dict[str, list[str]]] | encoding.SparseCategories | None = None,
    max_categories: int = encoding.MAX_CATEGORIES,
) -> tuple[DataFrame, DataFrame]:
    """Listing features with segment statistics and one-hot columns, and the segment dataset.

    Both results share one aggregation over the segments. ``max_categories`` bounds the one-hot
    columns that are fitted where no ``categories`` are given; ``encoding.fit_sparse_categories``
    gives categories without a bound, as vector columns.
    """
    compiled_rows(df.sparkSession)
    listed = segments.listing_features(df)
    dataset = materialise(segments.segment_dataset(listed, segment_cols))
    if encode:
        fitted = encoding.fit_categories(listed, CATEGORIES, max_categories) if categories is None else categories
        listed = encoding.apply_one_hot(listed, fitted)
    stats = segments.stats_from_dataset(dataset, segment_cols)
    out = segments.competition_features(listed, segment_cols, stats)
    return cleaning.drop_present(out, "room_type"), dataset


def prepare_listings(
    raw: DataFrame,
    elasticity_rows: DataFrame | None = None,
    segment_cols: list[str] = SEGMENT_COLS,
    categories: dict[str, dict[str, list[str]]] | encoding.SparseCategories | None = None,
    max_categories: int = encoding.MAX_CATEGORIES,
) -> tuple[DataFrame, DataFrame]:
    """Clip, derive, drop outliers and add price elasticity; gives listings and the segment dataset.

    One aggregation yields the dataset, the segment statistics and the outlier fences, and one
    join brings the latter two to the listings. Without ``elasticity_rows`` elasticities are
    estimated from the prepared listings. Listings are read several times, so hold ``raw`` if it is dear.
    """
    compiled_rows(raw.sparkSession)
    listed = segments.listing_features(cleaning.clip_listings(raw))
    known = materialise(segments.segment_dataset(listed, segment_cols, segments.quartiles()).withColumns(segments.fences()))
    fitted = encoding.fit_categories(listed, CATEGORIES, max_categories) if categories is None else categories
    stats = segments.stats_from_dataset(known, segment_cols, "lower_bound", "upper_bound")
    joined = segments.competition_features(encoding.apply_one_hot(listed, fitted), segment_cols, stats)
    kept = joined.where(segments.inside_fences()).drop("lower_bound", "upper_bound", "room_type")
    if elasticity_rows is None:
        priced = materialise(kept.select(*segment_cols, "listing_price", "occupancy_rate"))  # bins read it twice
        elasticity_rows = elasticity.elasticity_rows(elasticity.breakpoint_fit(elasticity.price_bins(priced)))
    found = elasticity.with_elasticity(kept, elasticity_rows)
    partly = join_measured(found, elasticity.partly_known(elasticity_rows), SEGMENT_COLS, "inner")  # other segments miss all slopes or none
    out = elasticity.impute_slope(found, slopes=partly)
    return out, known.drop("q1", "q3", "iqr", "lower_bound", "upper_bound")


# Columns the stored training table leaves out.
NOT_STORED = ["capacity_bin", "season", "weekend", "city", "room_shared", "room_private", "log_bookings"]


def training_table(prepared: DataFrame) -> DataFrame:
    """Prepared listings without the columns that one-hot columns replace."""
    return cleaning.drop_present(prepared, *NOT_STORED)

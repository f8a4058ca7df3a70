"""From raw CSV files to a cleaned table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from lodgecurve.operators.cleaning import clean_listings
from lodgecurve.sources.readers import read_listings_csv, read_table
from lodgecurve.sources.writers import write_table


def ingest(spark: SparkSession, csv_path: str, out_path: str, *copies: str, schema: T.StructType | None = None) -> DataFrame:
    """Read, clean and write listings; gives the written table."""
    write_table(clean_listings(read_listings_csv(spark, csv_path, schema)), out_path, *copies)
    return read_table(spark, out_path)

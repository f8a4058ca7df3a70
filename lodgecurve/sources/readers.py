"""Readers and generated rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodgecurve.functions.values import segment_name
from lodgecurve.operators.elasticity import flatten_documents
from lodgecurve.schemas import ELASTICITY_SCHEMA, SEASONS_ASCENDING


def read_listings_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """CSV with a header. Without a schema types are inferred, which reads the files twice.

    A path that does not exist raises.
    """
    reader = spark.read.option("header", True)
    return (reader.schema(schema) if schema else reader.option("inferSchema", True)).csv(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_elasticity_rows(spark: SparkSession, path: str) -> DataFrame:
    """JSON Lines of elasticity rows, in their declared schema."""
    return spark.read.schema(ELASTICITY_SCHEMA).json(path)


def read_elasticity_documents(spark: SparkSession, path: str, whole_files: bool = False, city: str | None = None) -> DataFrame:
    """Elasticity rows from nested JSON: one object per line, or one per file with ``whole_files``."""
    return flatten_documents(spark.read.text(path, wholetext=whole_files), city=city)


def literal_row(spark: SparkSession, **values) -> DataFrame:
    """A single row of literal values."""
    return spark.range(1).select(*[(v if isinstance(v, Column) else F.lit(v)).alias(n) for n, v in values.items()])


def segment_frame(markets: DataFrame) -> DataFrame:
    """The six segments, season by day type, of every row of ``markets``."""
    slots = F.array(
        *[F.struct(F.lit(s).alias("season"), F.lit(w).alias("weekend")) for s in reversed(SEASONS_ASCENDING) for w in (0, 1)]
    )
    out = markets.withColumn("slot", F.explode(slots)).select(*markets.columns, "slot.*")
    return out.withColumn("segment_name", segment_name(F.col("season"), F.col("weekend")))

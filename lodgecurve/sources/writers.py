"""Writers. All replace what the path held before."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodgecurve.operators.elasticity import elasticity_documents

PREVIEW_ROWS = 2000


def write_table(df: DataFrame, *paths: str) -> None:
    """Parquet to one or more places; the rows are computed once and copied from the first."""
    first, *copies = paths
    df.write.mode("overwrite").parquet(first)
    for path in copies:
        df.sparkSession.read.schema(df.schema).parquet(first).write.mode("overwrite").parquet(path)


def write_json_lines(df: DataFrame, path: str) -> None:
    """One object per row; NULL fields are written out."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header, in as many files as ``df`` has partitions."""
    df.write.mode("overwrite").option("header", True).csv(path)


def write_preview(df: DataFrame, path: str, rows: int = PREVIEW_ROWS) -> None:
    """The first rows as one small CSV file."""
    df.limit(rows).coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def write_documents(df: DataFrame, path: str, column: str = "value") -> None:
    """A column of JSON text, one document per line."""
    df.select(F.col(column).alias("value")).write.mode("overwrite").text(path)


def write_rows_as_documents(df: DataFrame, path: str) -> None:
    """Every row, nested fields included, as one JSON document per line."""
    write_documents(df.select(F.to_json(F.struct("*")).alias("value")), path)


def write_elasticity(rows: DataFrame, path: str) -> None:
    """Elasticity rows as nested JSON, one line per city."""
    write_documents(elasticity_documents(rows), path)

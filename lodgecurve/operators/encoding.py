"""Text categories as one-hot columns, and back, or as sparse vectors where values are many."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodgecurve.functions.values import category_suffix
from lodgecurve.schemas import string_columns

MAX_CATEGORIES = 2000


def distinct_values(df: DataFrame, columns: list[str]) -> DataFrame:
    """All non-NULL values of the columns as (column, value), found in one distributed job."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns]))
    return df.select(pairs.alias("p")).select("p.column", "p.value").where(F.col("value").isNotNull()).distinct()


def fit_categories(df: DataFrame, columns: list[str] | None = None, max_categories: int = MAX_CATEGORIES) -> dict[str, dict[str, list[str]]]:
    """One-hot output columns per input column, each with the values it stands for.

    Values with the same safe name share an output column. Categories become columns, so their
    number has to be bounded: more than ``max_categories`` in all raises.
    """
    columns = string_columns(df) if columns is None else [c for c in columns if c in df.columns]
    if not columns:
        return {}
    found = distinct_values(df, columns).limit(max_categories + 1).collect()
    if len(found) > max_categories:
        raise ValueError(f"more than {max_categories} categories in {columns}")
    fitted: dict[str, dict[str, list[str]]] = {c: {} for c in columns}
    for column, value in sorted((r["column"], r["value"]) for r in found):
        fitted[column].setdefault(f"cat_{column}_{category_suffix(value)}", []).append(value)
    return fitted


def categories_frame(spark, fitted: dict[str, dict[str, list[str]]]) -> DataFrame:
    """The fitted categories as a small table that can be written and read back."""
    rows = [(c, out, v) for c, outs in fitted.items() for out, vals in outs.items() for v in vals]
    return spark.createDataFrame(rows, "column string, output string, value string")


def load_categories(df: DataFrame) -> dict[str, dict[str, list[str]]]:
    fitted: dict[str, dict[str, list[str]]] = {}
    for row in df.orderBy("column", "value").collect():
        fitted.setdefault(row["column"], {}).setdefault(row["output"], []).append(row["value"])
    return fitted


def apply_one_hot(df: DataFrame, fitted: dict[str, dict[str, list[str]]] | SparseCategories, drop_originals: bool = False) -> DataFrame:
    """0/1 columns, or vectors, for fitted categories; values and columns not seen at fitting give zeros."""
    if isinstance(fitted, SparseCategories):
        out = fitted.apply(df)
        return out.drop(*fitted.columns) if drop_originals else out
    flags = {}
    for column, outputs in fitted.items():
        for output, vals in outputs.items():
            hit = F.col(column).cast("string").isin(vals) if column in df.columns else F.lit(False)
            flags[output] = F.when(hit, 1).otherwise(0)
    out = df.withColumns(flags) if flags else df
    return out.drop(*fitted) if drop_originals else out


def one_hot(
    df: DataFrame, columns: list[str] | None = None, drop_originals: bool = False, max_categories: int = MAX_CATEGORIES
) -> DataFrame:
    return apply_one_hot(df, fit_categories(df, columns, max_categories), drop_originals)


def indexed_categories(df: DataFrame, columns: list[str]) -> PipelineModel:
    """A fitted encoder of text columns to sparse 0/1 vectors ``{column}_vector``, for columns with many values.

    One vector column stands for all values of a column, so a table of thousands of cities keeps
    its width. Values not seen at fitting, and NULL, share a place of their own.
    """
    names = [f"__index_{c}" for c in columns]
    index = StringIndexer(inputCols=columns, outputCols=names, handleInvalid="keep", stringOrderType="alphabetAsc")
    vectors = OneHotEncoder(inputCols=names, outputCols=[f"{c}_vector" for c in columns], handleInvalid="keep", dropLast=False)
    return Pipeline(stages=[index, vectors]).fit(df)


@dataclass
class SparseCategories:
    """Fitted text columns as sparse 0/1 vectors ``cat_{column}``, a place for each value, named by the vector's metadata.

    Takes the place of fitted one-hot columns in every plan. A table keeps its width whatever the number of
    values; the driver and each task hold the values themselves, as they hold a model's weights.
    Values with the same safe name keep places of their own. Values not seen at fitting, NULL, and
    columns a table lacks give a vector of zeros.
    """

    columns: list[str]
    model: PipelineModel | None

    @property
    def outputs(self) -> list[str]:
        return [f"cat_{c}" for c in self.columns]

    def apply(self, df: DataFrame) -> DataFrame:
        if self.model is None:
            return df
        text = {c: F.col(c).cast("string") if c in df.columns else F.lit(None).cast("string") for c in self.columns}
        helpers = [f"__{kind}_{c}" for c in self.columns for kind in ("text", "index")]
        given = df.drop(*self.outputs).withColumns({f"__text_{c}": value for c, value in text.items()})
        return self.model.transform(given).drop(*helpers)

    def save(self, path: str) -> None:
        if self.model is None:
            raise ValueError("no column to save")
        self.model.write().overwrite().save(path)

    @classmethod
    def load(cls, path: str) -> SparseCategories:
        model = PipelineModel.load(path)
        return cls([c.removeprefix("__text_") for c in model.stages[0].getInputCols()], model)


def fit_sparse_categories(df: DataFrame, columns: list[str] | None = None) -> SparseCategories:
    """Learn the values of text columns, however many. Columns that are absent or hold no value are left out."""
    wanted = string_columns(df) if columns is None else [c for c in columns if c in df.columns]
    known = df.agg(*[F.count(c).alias(c) for c in wanted]).first() if wanted else {}
    columns = [c for c in wanted if known[c]]
    if not columns:
        return SparseCategories([], None)
    texts, places = [f"__text_{c}" for c in columns], [f"__index_{c}" for c in columns]
    index = StringIndexer(inputCols=texts, outputCols=places, handleInvalid="keep", stringOrderType="alphabetAsc")
    # the last place is that of unknown values; dropping it leaves them zeros
    vectors = OneHotEncoder(inputCols=places, outputCols=[f"cat_{c}" for c in columns], handleInvalid="error", dropLast=True)
    named = df.select(*[F.col(c).cast("string").alias(t) for c, t in zip(columns, texts)])
    return SparseCategories(columns, Pipeline(stages=[index, vectors]).fit(named))


def reverse_one_hot(df: DataFrame, column: str) -> DataFrame:
    """Rebuild ``column`` from its 0/1 columns: the safe name of the first one set."""
    prefix = f"cat_{column}_"
    flags = [c for c in df.columns if c.startswith(prefix)]
    if not flags:
        return df
    return df.withColumn(column, F.coalesce(*[F.when(F.col(c) == 1, c.removeprefix(prefix)) for c in flags]))


def restore_weekend(df: DataFrame) -> DataFrame:
    return df.withColumn("weekend", F.col("is_weekend").cast("int"))

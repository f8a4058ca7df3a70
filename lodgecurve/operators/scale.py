"""Building blocks that keep jobs whole when one key holds a large part of the rows.

``materialise``              cuts lineage with a table written to the shared checkpoint folder.
``scratch``                  a scope at whose end the tables written in it are deleted.
``join_measured``            joins a summary table back: broadcast only when its size allows it.
``running_counts``           rows below each value of a group, without one task seeing a whole group.
``value_cells``              rows, extremes and sums by cells of values, which are few however many values there are.
``cell_counts``              the same with the rows below each cell.
``open_cells``               rows of cells whose values have to be told apart, with what lies below them.
``aggregate_with_quantiles`` a grouped aggregation with exact quantiles on top of it.
``compiled_rows``            keeps plans of wide rows in code that the JVM compiles.
"""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BROADCAST_BYTES = 32 * 1024 * 1024
UNPACKED = 10  # times a Parquet file's size that its rows take up in a hash table, at most
CELLS_PER_OCTAVE = 64
LONGEST_METHOD = "spark.sql.codegen.hugeMethodLimit"
COMPILED_BYTES = 8000  # longest method that HotSpot compiles
_scopes: list[list[str]] = []


def shared_folder(spark) -> str:
    """The folder ``spark.checkpoint.dir`` names; a temporary one only in local sessions without it."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
            folder = tempfile.mkdtemp(prefix="lodgecurve-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def scratch_path(spark, kind: str) -> str:
    """A new path in the shared folder, deleted with the ``scratch`` scope that is open, if one is."""
    path = f"{shared_folder(spark)}/{kind}-{uuid.uuid4().hex}"
    if _scopes:
        _scopes[-1].append(path)
    return path


def materialise(df: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Write ``df`` once as a table in the shared folder and read it from there ever after.

    What follows no longer depends on executors that computed ``df``, reads only the columns
    it needs and knows the table's size. ``by`` names columns to partition the table by.
    """
    path = scratch_path(df.sparkSession, "table")
    (df.write.partitionBy(*by) if by else df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def compiled_rows(spark) -> None:
    """Let a stage whose generated code the JVM would leave interpreted run operator by operator instead.

    A table of a hundred columns makes methods of more than ``COMPILED_BYTES``, which HotSpot never
    compiles; Spark by default runs them all the same. Results are the same either way. A session
    that sets the limit itself keeps it.
    """
    if spark.conf.get(LONGEST_METHOD, None) is None:
        spark.conf.set(LONGEST_METHOD, str(COMPILED_BYTES))


@contextmanager
def scratch(spark):
    """Delete the tables that ``materialise`` writes within, once what was wanted from them is written or collected."""
    _scopes.append([])
    try:
        yield
    finally:
        for path in _scopes.pop():
            target = spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def stored_bytes(table: DataFrame) -> int:
    """Upper estimate of what a stored table takes up in memory, from the size of its files; starts no job."""
    return UNPACKED * int(str(table._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def join_measured(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    how: str = "left",
    null_safe: bool = False,
    extra=None,
    limit: int | None = None,
    stored: bool = False,
) -> DataFrame:
    """Join the summary ``right`` onto ``left`` (``how`` is inner or left) without moving ``left``.

    ``right`` is materialised, unless it is ``stored`` already. Up to ``limit`` bytes, by its files,
    it is broadcast. Beyond, it is a shuffled join with nothing between the shuffles and the join,
    so that adaptive execution can split the partitions of hot keys on the left.

    ``on`` columns come out once, from ``left``. ``null_safe`` lets NULL keys meet. ``extra``
    gets ``(left column function, right column function)`` and returns one more condition.
    """
    if how not in ("inner", "left"):
        raise ValueError("how must be inner or left")
    right = right if stored else materialise(right)
    small = stored_bytes(right) <= (BROADCAST_BYTES if limit is None else limit)

    renamed = right.withColumnsRenamed({c: f"__r_{c}" for c in right.columns})
    keep = [c for c in right.columns if c not in on]
    conditions = []
    for c in on:
        l, r = F.col(c), F.col(f"__r_{c}")
        conditions.append(l.eqNullSafe(r) if null_safe else l == r)
    if extra is not None:
        conditions.append(extra(F.col, lambda c: F.col(f"__r_{c}")))
    side = F.broadcast(renamed) if small else renamed
    joined = left.join(side, reduce(lambda a, b: a & b, conditions), how)
    return joined.select(*left.columns, *[F.col(f"__r_{c}").alias(c) for c in keep])


def value_cell(value: Column) -> Column:
    """A number that never falls as ``value`` (a number of any type) rises: ``CELLS_PER_OCTAVE`` cells to a doubling.

    Zero has a cell of its own, NaN goes with the largest.
    """
    d = value.cast("double")
    far = F.lit(1 << 20)  # above the largest cell number of a magnitude
    size = F.least(F.floor(F.log2(F.abs(d)) * CELLS_PER_OCTAVE), F.lit(1 << 17)).cast("bigint")  # infinity too
    return F.when(F.isnan(d), F.lit(1 << 62)).when(d == 0, F.lit(0)).when(d > 0, far + size).otherwise(-far - size).cast("bigint")


def running_counts(groups: DataFrame, keys: list[str], value: str, count: str) -> DataFrame:
    """Add ``below``, rows with a smaller value in the same group, and ``total``, rows of the group.

    ``groups`` has one row per group of ``keys`` and ``value``, which stands for ``count`` rows.
    Counts run over the cells of a group first and then within each cell, so the work on a hot
    group spreads over as many tasks as it has cells.
    """
    held = groups.withColumn("__cell", value_cell(F.col(value)))
    cells = ranked_cells(held.groupBy(*keys, "__cell").agg(F.sum(count).alias("__in")), keys, "__in")
    cells = cells.select(*[F.col(k).alias(f"__k_{k}") for k in keys], F.col("__cell").alias("__c"), F.col("below").alias("__before"), "total")
    same = F.col("__cell") == F.col("__c")
    for k in keys:
        same &= F.col(k).eqNullSafe(F.col(f"__k_{k}"))
    return held.join(cells, same).withColumn("below", _below(keys, value, count)).select(*groups.columns, "below", "total")


def ranked_cells(cells: DataFrame, keys: list[str], count: str = "__n") -> DataFrame:
    """Add ``below`` and ``total`` to one row per cell of a group; a group has few cells."""
    whole = Window.partitionBy(*keys)
    return cells.withColumns(
        {"below": F.sum(count).over(whole.orderBy("__cell")) - F.col(count), "total": F.sum(count).over(whole)}
    )


def _below(keys: list[str], value: str, count: str) -> Column:
    """Rows below a value, from those below its cell (``__before``) and the smaller values in it."""
    within = Window.partitionBy(*keys, "__cell").orderBy(value)
    return F.col("__before") + F.sum(count).over(within) - F.col(count)


def value_cells(df: DataFrame, keys: list[str], value: str, sums: list[Column] = []) -> DataFrame:
    """One row per group of ``keys`` and cell of ``value``, which is not NULL.

    A row has the cell's ``__n`` rows, its least and largest value ``__lo`` and ``__hi``, and ``sums``. Cells are few, so
    they combine map-side and little is shuffled.
    """
    cells = df.groupBy(*keys, value_cell(F.col(value)).alias("__cell")).agg(
        F.count(F.lit(1)).alias("__n"), F.min(value).alias("__lo"), F.max(value).alias("__hi"), *sums
    )
    plain = lambda c: F.when(F.col("__cell") == 0, F.abs(c)).otherwise(F.col(c))  # noqa: E731  zero without its sign
    return cells.withColumns({"__lo": plain("__lo"), "__hi": plain("__hi")})


def cell_counts(df: DataFrame, keys: list[str], value: str, sums: list[Column] = []) -> DataFrame:
    """``value_cells`` with ``below`` and ``total`` as ``running_counts`` gives them."""
    return ranked_cells(value_cells(df, keys, value, sums), keys)


def _joined_cells(cells: DataFrame, keys: list[str]) -> DataFrame:
    """``cell_counts`` by ``keys`` from stored ``value_cells`` by these and more keys."""
    summed = cells.groupBy(*keys, "__cell").agg(F.sum("__n").alias("__n"), F.min("__lo").alias("__lo"), F.max("__hi").alias("__hi"))
    return ranked_cells(summed, keys)


def open_cells(df: DataFrame, cells: DataFrame, keys: list[str], value: str, sums: list[Column] = []) -> DataFrame:
    """The rows of ``df`` that lie in ``cells``, a stored part of its ``cell_counts``: one row per value, with ``__n``, ``below``, ``total`` and ``sums``."""
    found = cells.select(*keys, "__cell", F.col("below").alias("__before"), "total")
    # One number rules out most rows before keys are compared: a hash of keys and cell, or the cell alone where the cells are many.
    mark = F.xxhash64(*keys, "__cell") if stored_bytes(found) <= BROADCAST_BYTES else F.col("__cell")
    some = F.broadcast(cells.select(mark.alias("__mark")).distinct())
    held = df.withColumn("__cell", value_cell(F.col(value))).withColumn("__mark", mark).join(some, "__mark", "left_semi").drop("__mark")
    rows = join_measured(held, found, [*keys, "__cell"], "inner", null_safe=True, stored=True)
    groups = rows.groupBy(*keys, "__cell", "__before", "total", value).agg(F.count(F.lit(1)).alias("__n"), *sums)
    return groups.withColumn("below", _below(keys, value, "__n")).drop("__cell", "__before")


def aggregate_with_quantiles(
    df: DataFrame,
    keys: list[str],
    aggregates: list[Column],
    quantiles: dict[str, tuple[str, float]],
    approx: bool = False,
    cells: dict[str, DataFrame] | None = None,
) -> DataFrame:
    """``groupBy(keys)`` with ordinary aggregates plus exact discrete quantiles.

    ``quantiles`` maps an output name to (column, probability). A quantile is an observed value,
    of the column's own type: the smallest whose cumulative share reaches the probability. A column's
    rows are counted by cells first; only the cells that hold a quantile and several values are read
    again and counted by value. The first count runs while the plan is built, and ``df`` is read for
    every column with quantiles, so hold it if it is dear. ``cells`` holds stored ``value_cells`` of
    columns, by ``keys`` and any others, that were counted already. ``approx`` trades exactness for
    one mergeable sketch.
    """
    if approx:
        built_in = [F.percentile_approx(c, p).alias(name) for name, (c, p) in quantiles.items()]
        return df.groupBy(*keys).agg(*aggregates, *built_in)
    kinds = dict(df.dtypes)
    out = df.groupBy(*keys).agg(*aggregates) if aggregates else df.select(*keys).distinct() if keys else df.groupBy().agg(F.lit(1).alias("__one"))
    for kind in sorted({kinds[c] for c, _ in quantiles.values()}):
        wanted = {name: (c, p) for name, (c, p) in quantiles.items() if kinds[c] == kind}
        found = _quantiles(df, keys, wanted, cells or {})
        if keys:
            renamed = found.withColumnsRenamed({k: f"__k_{k}" for k in keys})
            same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__k_{k}")) for k in keys])
            out = out.join(renamed, same, "left").select(*out.columns, *wanted)
        else:
            out = out.crossJoin(found)  # one row each
    return out.select(*[c for c in out.columns if c not in (*quantiles, "__one")], *quantiles)


def _quantiles(df: DataFrame, keys: list[str], wanted: dict[str, tuple[str, float]], counted: dict[str, DataFrame]) -> DataFrame:
    measures = sorted({c for c, _ in wanted.values()})
    rank = lambda p: F.greatest(F.ceil(F.col("total") * F.lit(float(p))), F.lit(1))
    hit = lambda p: (rank(p) > F.col("below")) & (rank(p) <= F.col("below") + F.col("__n"))
    known = {m: df.select(*keys, F.col(m).alias("__v")).where(F.col("__v").isNotNull()) for m in measures}
    ranked = {m: _joined_cells(counted[m], keys) if m in counted else cell_counts(known[m], keys, "__v") for m in measures}
    holding = [
        cells.where(reduce(lambda a, b: a | b, [hit(p) for c, p in wanted.values() if c == m])).withColumn("__measure", F.lit(m))
        for m, cells in ranked.items()
    ]
    cells = materialise(reduce(DataFrame.unionByName, holding))
    several = cells.where(~F.col("__lo").eqNullSafe(F.col("__hi")))
    found = [cells.where(F.col("__lo").eqNullSafe(F.col("__hi"))).withColumnRenamed("__lo", "__v")]
    for m in sorted(r[0] for r in several.select("__measure").distinct().collect()):  # at most all measures
        found.append(open_cells(known[m], several.where(F.col("__measure") == m), keys, "__v").withColumn("__measure", F.lit(m)))
    values = reduce(DataFrame.unionByName, [f.select(*keys, "__measure", "__v", "__n", "below", "total") for f in found])
    pick = [F.max(F.when((F.col("__measure") == c) & hit(p), F.col("__v"))).alias(name) for name, (c, p) in wanted.items()]
    return values.groupBy(*keys).agg(*pick)

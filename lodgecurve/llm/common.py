"""Small helpers shared by the corpus operators.

Identity of a document row. Operators that go through a text more than once find the row again by
``uid``, a hash of id and text, together with the id itself. Repeated rows (same id, same text)
share a uid and therefore get the same decision; rows that share an id but differ in text do not.
Input columns are carried in one struct, so extra columns of any name cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
SHORT_BATCH = 2 << 20


def short_batches(spark) -> None:
    """Let texts go to Python and back in batches of some ``SHORT_BATCH`` bytes, where Spark goes by 10,000 rows or 64 MB.

    A task holds a batch several times, in the JVM and in Python. Results do not depend on it. A session
    that sets the limit itself keeps it.
    """
    if spark.conf.get(BATCH_BYTES, None) is None:
        spark.conf.set(BATCH_BYTES, str(SHORT_BATCH))


def quoted(name: str) -> str:
    """A column name as Spark reads it, whatever characters it has."""
    return "`" + name.replace("`", "``") + "`"


def texts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``uid long, id long, body string``: every row of ``docs``; null texts become empty."""
    body = F.coalesce(F.col(quoted(text)).cast("string"), F.lit(""))
    return docs.select(F.col(quoted(key)).cast("long").alias("id"), body.alias("body")).select(
        F.xxhash64("id", "body").alias("uid"), "id", "body"
    )


def with_rows(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """As ``texts``, plus the whole input row in the struct column ``row``."""
    body = F.coalesce(F.col(quoted(text)).cast("string"), F.lit(""))
    return docs.select(
        F.struct(*[F.col(quoted(c)) for c in docs.columns]).alias("row"), F.col(quoted(key)).cast("long").alias("id"), body.alias("body")
    ).select(F.xxhash64("id", "body").alias("uid"), "id", "body", "row")


def many(df: DataFrame) -> int:
    """Partitions for an explicit shuffle of ``df``: the session's setting."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def signed(values: np.ndarray) -> np.ndarray:
    """Unsigned 64-bit values as Spark's longs."""
    return values.astype(np.uint64, copy=False).view(np.int64)


def longs(values) -> pa.Array:
    return pa.array(np.asarray(values, dtype=np.int64), type=pa.int64())


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def rows_of(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple]:
    """The named columns of each row, one after another, holding one batch at a time."""
    for batch in batches:
        step = 256  # a slice of Python objects at a time, not the whole batch
        for at in range(0, batch.num_rows, step):
            part = batch.slice(at, step)
            yield from zip(*[column(part, n).to_pylist() for n in names])


SPLIT_BITS = 7
MOST_RANGES = 4096


def balanced_borders(df: DataFrame, key: str, size: str, target: int, most: int = MOST_RANGES) -> list[int]:
    """First keys of ranges of ``key`` (a long) that hold about ``target`` of ``size`` each, but for the first range.

    Sizes are summed over cells of equal width, 128 at first, and again over 128 parts of each cell over
    the target, until a cell is small enough or a single key. A key's cell is the key without its lowest
    bits, so the cells still open reach their rows by an equality. Exact and the same for the
    same rows, however they are partitioned. There are about ``most`` ranges at most, which grow beyond that, and the
    driver holds 128 sums for each at most. ``df`` is read once for each level. Null keys are in no range.
    """
    sized = df.select(F.col(key).cast("long").alias("key"), F.col(size).alias("size")).where(F.col("key").isNotNull())
    whole = sized.agg(F.min("key").alias("lo"), F.max("key").alias("hi"), F.sum("size").alias("n")).first()
    if whole["lo"] is None:
        return []
    lo, hi = int(whole["lo"]), int(whole["hi"])
    target = max(1, target, -(-int(whole["n"] or 0) // most))
    bits, inside, done = max(0, (hi - lo).bit_length() - SPLIT_BITS), sized, []
    while True:
        cells = inside.groupBy(F.shiftright("key", bits).alias("cell")).agg(F.sum("size").alias("n")).collect()
        large = [r["cell"] for r in cells if bits and (r["n"] or 0) > target]
        still = set(large)
        done += [(max(lo, r["cell"] << bits), int(r["n"] or 0)) for r in cells if r["cell"] not in still]
        if not large:
            break
        zones = df.sparkSession.createDataFrame([(cell,) for cell in sorted(large)], "cell long")
        inside = sized.join(F.broadcast(zones), F.shiftright("key", bits) == F.col("cell"), "left_semi")
        bits = max(0, bits - SPLIT_BITS)
    out, held = [], 0
    for at, n in sorted(done):
        if held and held + n > target:
            out.append(at)
            held = 0
        held += n
    return out

"""Removal of repeated passages of a given number of bytes or words.

Suffixes that share their first ``length`` tokens are exactly the places of a repeated window, so
nothing beyond that depth needs to be told apart. A depth-limited radix sort would split all
suffixes digit by digit and shuffle a row for each byte of text (README: bytes of both ways). Here
suffixes are not sorted: runs of neighbouring windows with a common anchor travel as one row, rows
are grouped by hashes of what their windows have in common, in ever smaller runs of neighbours,
at last the whole window (see ``windows``). A group of one leaves at once, and runs that are equal as
a whole are settled together, so rows are few: one or two for every ``width / 2`` tokens at first.

Nothing is capped: copies meet in aggregations that combine map-side, and a hot group is at worst
one counted row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodgecurve.llm.common import longs, quoted, rows_of, short_batches, texts, with_rows
from lodgecurve.llm.repeats import covered, first_pass, next_pass, spans_by_document, with_texts, without
from lodgecurve.llm.substring_dedup import Words, shape_of
from lodgecurve.llm.windows import Shape, mixed
from lodgecurve.operators.scale import materialise

LENGTH = 400
MOST = 4000
BYTE = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))


class Unit:
    """What a text is counted in, the tokens of a task, and a text without spans of them."""

    def __init__(self, name: str) -> None:
        if name not in ("bytes", "words"):
            raise ValueError("unit must be bytes or words")
        self.words = name == "words"
        self.size = 8 if self.words else 1

    def tokens(self):
        return Words() if self.words else byte_tokens

    def without(self, body: bytes, spans: list[tuple[int, int]]) -> bytes:
        """Words that are left of a touched text are joined by one space."""
        if not self.words or not spans:
            return without(body, spans)
        words, kept, at = body.split(), [], 0
        for a, b in spans:
            kept += words[at:a]
            at = b
        return b" ".join(kept + words[at:])


def byte_tokens(body: bytes) -> tuple[np.ndarray, bytes]:
    return BYTE[np.frombuffer(body, dtype=np.uint8)], body


def passes(length: int) -> tuple[Shape, list[int]]:
    """Shape of the windows and the block size of each pass, from half the width down to one."""
    width = max(2, length - max(1, length // 13))
    width += width % 2
    shape = Shape(length, max(1, length - width + 1))
    blocks = [max(1, shape.width // 2)]
    while blocks[-1] > 1:
        blocks.append(max(1, -(-blocks[-1] // 14)) if blocks[-1] > 14 else 1)
    return shape, blocks


def repeated_pieces(docs: DataFrame, length: int = LENGTH, unit: str = "bytes") -> DataFrame:
    """``uid, pos``: pieces whose windows all occur at least twice; ``docs`` has ``uid, id, body``."""
    if not 2 <= length <= MOST:
        raise ValueError(f"length must be from 2 to {MOST}")
    counted = Unit(unit)
    tokens, size = counted.tokens(), counted.size
    shape, blocks = passes(length) if unit == "bytes" else shape_of(length)
    settled, rows = [], first_pass(docs, tokens, size, shape, blocks[0])
    for block in [*blocks[1:], None]:
        rows = materialise(rows.drop("id"))
        again = rows.groupBy("core").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1).select("core")
        again = materialise(again)  # its own table, so that the join's hot partitions can be split
        rows = materialise(rows.join(again, "core"))
        groups = materialise(rows.groupBy("core", "hull").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("uid", "pos")).alias("one")))
        equal = groups.where(F.col("n") > 1).select("core", "hull")
        settled.append(rows.join(equal, ["core", "hull"]).select("uid", "pos"))
        if block is None:
            break
        single = groups.where(F.col("n") == 1)
        witness = groups.where(F.col("n") > 1).join(single.select("core").distinct(), "core", "left_semi")
        pieces = single.select("one.*").unionByName(witness.select("one.*"))
        rows = next_pass(docs, pieces, tokens, size, shape, block)
    return reduce(DataFrame.unionByName, settled)


def judged(docs: DataFrame, length: int, unit: str, work, schema) -> DataFrame:
    short_batches(docs.sparkSession)
    found = spans_by_document(repeated_pieces(docs.select("uid", "id", "body"), length, unit))
    return with_texts(docs, found, "left").mapInArrow(work, schema)


def repeated_spans(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """Per row of ``docs``: ``id``, the text's ``n_bytes``, the ``spans`` to remove and a digest of the rest.

    A byte goes if a run of ``length`` bytes that covers it also starts anywhere else in the
    table, the same document included. Texts are judged as given, as UTF-8 bytes; null and shorter
    texts lose nothing. Repeated rows count as separate documents, so both lose what they share.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, sizes, spans, digests = [], [], [], []
            for id_, body, positions in rows_of([batch], "id", "body", "positions"):
                cut = covered(positions, length)
                ids.append(id_)
                sizes.append(len(body))
                spans.append([{"from": a, "to": b} for a, b in cut])
                digests.append(hashlib.sha256(without(body, cut)).hexdigest())
            kind = pa.list_(pa.struct([("from", pa.int64()), ("to", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), longs(sizes), pa.array(spans, kind), pa.array(digests, pa.string())], ["id", "n_bytes", "spans", "kept_sha256"]
            )

    schema = "id long, n_bytes long, spans array<struct<from: long, to: long>>, kept_sha256 string"
    return judged(texts(docs, key, text), length, "bytes", work, schema)


def without_repeats(
    docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, chars: str | None = None, unit: str = "bytes"
) -> DataFrame:
    """``docs`` with passages of ``length`` bytes or words that also start anywhere else cut from the text column.

    All rows and columns are kept. Bytes of a character that is only partly repeated go with it, so
    the rest stays valid UTF-8. Words are runs of anything but ASCII white space, taken as they are;
    what is left of a text that loses some is joined by one space.
    ``chars`` names a column that holds the text's length, to be counted anew.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [counted.without(b, covered(p, length)).decode("utf-8", "ignore") for b, p in rows_of([batch], "body", "positions")]
            row = batch.column(batch.schema.get_field_index("row"))
            yield pa.RecordBatch.from_arrays([row, pa.array(kept, pa.string())], ["row", "kept"])

    counted, rows = Unit(unit), with_rows(docs, key, text)
    schema = rows.select("row").schema.add("kept", "string")
    cut = judged(rows, length, unit, work, schema)
    now = {text: F.col("kept")} | ({chars: F.length("kept").cast(docs.schema[chars].dataType)} if chars in docs.columns else {})
    was = lambda c: F.col(f"row.{quoted(c)}")
    return cut.select(*[F.when(was(text).isNotNull(), now[c]).otherwise(was(c)).alias(c) if c in now else was(c).alias(c) for c in docs.columns])


def op6_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    """What 400-byte repeats leave of every document."""
    found = repeated_spans(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["to"] - s["from"])
    return found.select(
        F.col("id").alias("doc_id"), "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), "kept_sha256"
    )

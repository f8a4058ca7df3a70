"""Removal of word windows that an earlier document has too, behind a count-min prefilter.

First pass: every task counts the anchor grams of its windows (see ``windows``) in a count-min
sketch; the sketches are merged by slices. A window occurs no more often than its anchor gram, and
a count-min count is never too low, so a window whose estimate is below two occurs once. Second
pass: the windows left, as pieces, are grouped exactly. The sketch only saves work: with any
width the result is the same.

The sketch has ``depth`` rows of ``cells`` cells, one bit each once merged (counted at least twice
or not), and is all that the driver holds: ``depth * cells / 8`` bytes, 8 MB by default, whatever
the input. Beyond some 100 million windows give it more cells; too few only let more windows pass.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodgecurve.llm.common import column, longs, many, quoted, rows_of, texts, with_rows
from lodgecurve.llm.repeats import covered, first_pass, next_pass, spans_by_document, with_texts
from lodgecurve.llm.windows import Shape, gram_hashes, mixed, owners
from lodgecurve.operators.scale import materialise

WINDOW = 50
MOST = 4000
CELLS = 1 << 25
DEPTH = 2
SLICES = 256
PENDING = 1 << 20


class Words:
    """64-bit hashes of words, remembered for the words seen lately."""

    def __init__(self, limit: int = 150_000) -> None:
        self.known: dict[bytes, int] = {}
        self.limit = limit

    def __call__(self, body: bytes) -> tuple[np.ndarray, bytes]:
        words, known = body.split(), self.known
        if len(known) > self.limit:
            known.clear()
        for w in set(words).difference(known):
            known[w] = xxhash.xxh3_64_intdigest(w)
        out = np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=len(words))
        return out, out.tobytes()


def shape_of(window: int) -> tuple[Shape, list[int]]:
    """Shape of the windows and block sizes of the grouping passes."""
    width = max(2, window - window // 7)
    width += width % 2
    shape = Shape(window, max(1, window - width + 1))
    half = max(1, shape.width // 2)
    return shape, [half, max(1, half // 5), 1] if half > 5 else [half, 1] if half > 1 else [1]


def cells_of(grams: np.ndarray, depth: int, cells: int) -> list[np.ndarray]:
    """The cell of every gram in each row of the sketch."""
    salts = [np.uint64((2 * row + 1) * 0xD1B54A32D192ED03 % (1 << 64)) for row in range(depth)]
    return [(mixed(grams + salt) % np.uint64(cells)).astype(np.int64) for salt in salts]


def repeated_cells(docs: DataFrame, shape: Shape, cells: int, depth: int) -> np.ndarray:
    """Packed bits, ``depth * cells`` of them: cells that count at least two anchors over all documents."""
    if cells % (8 * SLICES):
        raise ValueError(f"cells must be a multiple of {8 * SLICES}")
    part = depth * cells // SLICES

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, held, n = Words(), [], 0

        def sketch() -> pa.RecordBatch:
            cell, times = np.unique(np.concatenate(held) if held else np.zeros(0, dtype=np.int64), return_counts=True)
            at = np.searchsorted(cell, np.arange(SLICES + 1) * part)
            full = np.flatnonzero(np.diff(at))
            once = [(cell[at[i] : at[i + 1]] - i * part).astype(np.uint32) for i in full]
            more = [np.packbits(times[at[i] : at[i + 1]] > 1) for i in full]
            return pa.RecordBatch.from_arrays(
                [pa.array(full, pa.int32()), pa.array([a.tobytes() for a in once], pa.binary()), pa.array([a.tobytes() for a in more], pa.binary())],
                ["slice", "touched", "twice"],
            )

        for (body,) in rows_of(batches, "body"):
            grams = gram_hashes(tokens(body)[0], shape.gram)
            anchors = grams[np.unique(owners(grams, shape.width))]
            held.extend(c + row * cells for row, c in enumerate(cells_of(anchors, depth, cells)))
            n += len(anchors)
            if n > PENDING:
                yield sketch()
                held, n = [], 0
        yield sketch()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, counts = None, None

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([np.packbits(counts > 1).tobytes()], pa.binary())], ["slice", "bits"])

        for at, touched, twice in rows_of(batches, "slice", "touched", "twice"):
            if at != now:
                if now is not None:
                    yield done()
                now, counts = at, np.zeros(part, dtype=np.uint8)
            cell = np.frombuffer(touched, dtype=np.uint32)
            more = np.unpackbits(np.frombuffer(twice, dtype=np.uint8), count=len(cell))
            counts[cell] = np.minimum(counts[cell] + 1 + more, 2)
        if now is not None:
            yield done()

    sketches = docs.select(F.col("body").cast("binary").alias("body")).mapInArrow(count, "slice int, touched binary, twice binary")
    merged = sketches.repartition(min(SLICES, many(docs)), "slice").sortWithinPartitions("slice").mapInArrow(merge, "slice int, bits binary")
    bits = np.zeros(depth * cells // 8, dtype=np.uint8)
    for row in merged.toLocalIterator():  # SLICES rows of a fixed size
        bits[row["slice"] * part // 8 : (row["slice"] + 1) * part // 8] = np.frombuffer(row["bits"], dtype=np.uint8)
    return bits


def estimated_repeated(bits: np.ndarray, cells: int, depth: int):
    """A test whether anchor grams count at least two in every row of the sketch."""

    def test(grams: np.ndarray) -> np.ndarray:
        keep = np.ones(len(grams), dtype=bool)
        for row, cell in enumerate(cells_of(grams, depth, cells)):
            at = cell + row * cells
            keep &= (bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1
        return keep

    return test


def earlier_pieces(docs: DataFrame, window: int = WINDOW, cells: int = CELLS, depth: int = DEPTH) -> DataFrame:
    """``uid, pos``: pieces whose windows all start in a document with a smaller id too."""
    if not 2 <= window <= MOST:
        raise ValueError(f"window must be from 2 to {MOST}")
    shape, blocks = shape_of(window)
    shared = docs.sparkSession.sparkContext.broadcast(repeated_cells(docs, shape, cells, depth))
    tokens = Words()
    settled = []
    rows = first_pass(docs, tokens, 8, shape, blocks[0], lambda grams: estimated_repeated(shared.value, cells, depth)(grams))
    for block in [*blocks[1:], None]:
        rows = materialise(rows)
        # a core of one document only has no earlier place
        again = rows.groupBy("core").agg(F.min("id").alias("low"), F.max("id").alias("high")).where(F.col("low") < F.col("high")).select("core")
        again = materialise(again)  # its own table, so that the join's hot partitions can be split
        rows = materialise(rows.join(again, "core"))
        groups = materialise(rows.groupBy("core", "hull").agg(F.min("id").alias("first")))
        placed = rows.join(groups, ["core", "hull"])
        settled.append(placed.where(F.col("id") > F.col("first")).select("uid", "pos"))
        if block is None:
            break
        several = materialise(groups.groupBy("core").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1).select("core"))
        open_rows = placed.where(F.col("id") == F.col("first")).join(several, "core", "left_semi")
        rows = next_pass(docs, open_rows.select("uid", "pos"), tokens, 8, shape, block)
    return reduce(DataFrame.unionByName, settled)


def judged(docs: DataFrame, window: int, cells: int, depth: int, work, schema) -> DataFrame:
    found = spans_by_document(earlier_pieces(docs.select("uid", "id", "body"), window, cells, depth))
    return with_texts(docs, found, "left").mapInArrow(work, schema)


def kept_words(body: bytes, positions: list[int] | None, window: int) -> tuple[int, int, bytes]:
    """Words, words removed, and the rest joined by one space."""
    words, at, kept, gone = body.split(), 0, [], 0
    for a, b in covered(positions, window):
        kept += words[at:a]
        gone += b - a
        at = b
    return len(words), gone, b" ".join([*kept, *words[at:]])


def repeated_words(
    docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW, cells: int = CELLS, depth: int = DEPTH
) -> DataFrame:
    """``id, n_words, n_removed, kept_sha256`` per row of ``docs``.

    A word goes if a window of ``window`` words that covers it also starts in a document with a
    smaller id. Words are runs of anything but ASCII white space, taken as they are. Null, empty
    and shorter texts lose nothing; rows with one id are one document in this comparison; a null
    id is neither smaller nor larger than any, so such rows lose nothing.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [kept_words(b, p, window) for b, p in rows_of([batch], "body", "positions")]
            digests = [hashlib.sha256(k).hexdigest() for _, _, k in out]
            yield pa.RecordBatch.from_arrays(
                [column(batch, "id"), longs([o[0] for o in out]), longs([o[1] for o in out]), pa.array(digests, pa.string())],
                ["id", "n_words", "n_removed", "kept_sha256"],
            )

    return judged(texts(docs, key, text), window, cells, depth, work, "id long, n_words long, n_removed long, kept_sha256 string")


def without_repeated_words(
    docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW, cells: int = CELLS, depth: int = DEPTH
) -> DataFrame:
    """``docs`` with those words cut from the text column; touched texts are joined by single spaces."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [kept_words(b, p, window)[2] if p else b for b, p in rows_of([batch], "body", "positions")]
            yield pa.RecordBatch.from_arrays([column(batch, "row"), pa.array([k.decode() for k in kept], pa.string())], ["row", "kept"])

    rows = with_rows(docs, key, text)
    cut = judged(rows, window, cells, depth, work, rows.select("row").schema.add("kept", "string"))
    columns = [F.when(F.col(f"row.{quoted(c)}").isNotNull(), F.col("kept")).alias(c) if c == text else F.col(f"row.{quoted(c)}").alias(c) for c in docs.columns]
    return cut.select(*columns)


def op8_substring_dedup(spark, sf_dir: str) -> DataFrame:
    """What windows of 50 words seen in earlier documents leave of every document."""
    found = repeated_words(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select(F.col("id").alias("doc_id"), "n_words", "n_removed", "kept_sha256")

"""Distributed passes over window pieces (see ``windows``), shared by the repeated-passage operators.

A pass turns candidate pieces into rows ``uid, id, pos, core, hull`` and keeps those whose core
occurs at least twice. Which of the survivors are settled and which go on to the next pass, in
smaller blocks, is the calling operator's rule.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodgecurve.llm.common import longs, rows_of, signed
from lodgecurve.llm.windows import Shape, cut_piece, gram_hashes, owners, packed, piece_keys, runs, union_spans, unpacked
from lodgecurve.operators.scale import materialise

PIECES = "uid long, id long, pos long, core long, hull long"
FLUSH = 1 << 17
BITMAP = 1 << 26


class Rows:
    """Piece rows gathered into record batches of bounded size."""

    def __init__(self) -> None:
        self.parts: list[tuple] = []
        self.n = 0

    def add(self, uid: int, id_: int | None, pos, core, hull) -> None:
        self.parts.append((uid, id_, pos, core, hull))
        self.n += len(pos)

    def batch(self) -> pa.RecordBatch:
        sizes = [len(p[2]) for p in self.parts]
        each = lambda i: np.concatenate([p[i] for p in self.parts]) if self.parts else np.zeros(0, dtype=np.int64)
        uid = np.repeat(np.array([p[0] for p in self.parts], dtype=np.int64), sizes)
        known = np.repeat(np.array([p[1] is not None for p in self.parts], dtype=bool), sizes)
        ids = np.repeat(np.array([p[1] or 0 for p in self.parts], dtype=np.int64), sizes)
        out = [longs(uid), pa.array(ids, mask=~known), longs(each(2)), longs(signed(each(3))), longs(signed(each(4)))]
        self.__init__()
        return pa.RecordBatch.from_arrays(out, ["uid", "id", "pos", "core", "hull"])


def first_pass(
    docs: DataFrame, tokens: Callable, size: int, shape: Shape, block: int, wanted: Callable[[np.ndarray], np.ndarray] | None = None
) -> DataFrame:
    """Pieces of all windows of all documents (``uid, id, body``).

    ``tokens(body) -> (64-bit tokens, bytes of size per token)``. ``wanted`` may discard pieces by
    the hash of their anchor gram.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = Rows()
        for uid, id_, body in rows_of(batches, "uid", "id", "body"):
            hashed, data = tokens(body)
            grams = gram_hashes(hashed, shape.gram)
            s, e, x = runs(owners(grams, shape.width), 0, block)
            if wanted is not None and len(s):
                keep = wanted(grams[x])
                s, e, x = s[keep], e[keep], x[keep]
            if len(s):
                rows.add(uid, id_, packed(s, e, x), *piece_keys(data, size, s, e, x, shape, block))
            if rows.n >= FLUSH:
                yield rows.batch()
        yield rows.batch()

    return docs.select("uid", "id", F.col("body").cast("binary").alias("body")).mapInArrow(work, PIECES)


def next_pass(docs: DataFrame, pieces: DataFrame, tokens: Callable, size: int, shape: Shape, block: int) -> DataFrame:
    """The given pieces (``uid, pos``) in blocks of ``block``; reads only documents that have some."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = Rows()
        for uid, id_, body, positions in rows_of(batches, "uid", "id", "body", "positions"):
            _, data = tokens(body)
            for s, e, x in zip(*(v.tolist() for v in unpacked(np.array(sorted(set(positions)), dtype=np.int64)))):
                starts, ends, anchors = cut_piece(s, e, x, block)
                rows.add(uid, id_, packed(starts, ends, anchors), *piece_keys(data, size, starts, ends, anchors, shape, block))
                if rows.n >= FLUSH:
                    yield rows.batch()
        yield rows.batch()

    by_document = pieces.groupBy("uid").agg(F.collect_list("pos").alias("positions"))
    return with_texts(docs, by_document, "inner").mapInArrow(work, PIECES)


def filtered(docs: DataFrame, uids: DataFrame, bits: int = BITMAP) -> tuple[DataFrame, DataFrame]:
    """``docs`` in two: rows whose uid may be among ``uids``, and rows whose uid is surely not.

    Keeps the texts of uninvolved documents out of shuffles. ``uids`` become a bitmap of at most
    ``bits`` bits (8 MB by default, however many they are), which is what is broadcast; if it
    fills up, more rows count as possible ones.
    """
    slot = F.pmod(F.col("uid"), F.lit(bits))
    bitmap = uids.groupBy(F.bitmap_bucket_number(slot).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("bits"))
    byte = F.conv(F.hex(F.substring("bits", F.floor(F.bitmap_bit_position(slot) / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    hit = F.coalesce(F.getbit(byte, F.pmod(F.bitmap_bit_position(slot), F.lit(8)).cast("int")), F.lit(0)) == 1
    marked = docs.withColumn("bucket", F.bitmap_bucket_number(slot)).join(F.broadcast(bitmap), "bucket", "left").withColumn("hit", hit)
    return marked.where("hit").select(*docs.columns), marked.where(~F.col("hit")).select(*docs.columns)


def with_texts(docs: DataFrame, by_document: DataFrame, how: str) -> DataFrame:
    """``docs`` with per-document findings joined on; with ``how="left"`` the other documents too."""
    found = materialise(by_document)
    docs = docs.withColumn("body", F.col("body").cast("binary"))
    maybe, rest = filtered(docs, found.select("uid"))
    joined = maybe.join(found, "uid", how)
    if how == "inner":
        return joined
    return joined.unionByName(rest, allowMissingColumns=True)


def spans_by_document(settled: DataFrame) -> DataFrame:
    """``uid, positions``: the settled pieces of each document."""
    return settled.groupBy("uid").agg(F.collect_set("pos").alias("positions"))


def covered(positions: list[int] | None, length: int) -> list[tuple[int, int]]:
    """Token spans that windows of the given pieces cover."""
    if not positions:
        return []
    s, e, _ = unpacked(np.array(positions, dtype=np.int64))
    return union_spans(list(zip(s.tolist(), (e + length).tolist())))


def without(data: bytes, spans: list[tuple[int, int]]) -> bytes:
    """``data`` without the spans."""
    if not spans:
        return data
    kept, at = [], 0
    for a, b in spans:
        kept.append(data[at:a])
        at = b
    return b"".join([*kept, data[at:]])

"""Near-duplicate groups by SimHash fingerprints and pigeonhole blocks.

Every document gets a 64-bit fingerprint of its word shingles. Two fingerprints that differ in at
most ``distance`` bits agree in at least ``blocks - distance`` of ``blocks`` bit ranges, whichever
bits differ, so joining on every choice of that many ranges loses no pair. The distances are then
verified and documents are grouped by connected components.

Equal fingerprints meet first, so copies cost one row. Documents whose rows in a join bucket are
many are not paired: a bucket emits a spanning forest of its links, found by searching outwards
from one fingerprint at a time, and a bucket of over ``BUCKET`` fingerprints is dealt to several
tasks as pairs of its parts. Nothing is capped.

Rows with null or empty text have fingerprint zero and link like others. Rows that share an id
share a component if any of their fingerprints do; each row keeps its own fingerprint.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodgecurve.llm.common import column, longs, many, rows_of, short_batches, signed, texts, with_rows
from lodgecurve.llm.components import components
from lodgecurve.operators.scale import join_measured, materialise

BITS = 64
BUCKET = 4096
SEED = 42


def fingerprint(text: bytes, words: int) -> int:
    """SimHash of the ``words``-word shingles of a UTF-8 text, A-Z lower-cased.

    Words are runs of anything but ASCII white space, shingles are joined by one space; a shorter
    text is one shingle, a text without words has fingerprint zero.
    """
    tokens = text.lower().split()
    if not tokens:
        return 0
    size = min(words, len(tokens))
    line = b" ".join(tokens)
    ends = np.cumsum(np.fromiter(map(len, tokens), dtype=np.int64, count=len(tokens)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = len(tokens) - size + 1
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(line[a:b], SEED) for a, b in zip(starts[:n].tolist(), ends[size - 1 :].tolist())], dtype=np.uint64)
    counts = np.zeros(BITS, dtype=np.int64)
    for at in range(0, n, 1 << 16):  # bounded memory for long texts
        part = hashes[at : at + (1 << 16)]
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.uint32)
    return int(np.packbits(counts * 2 > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 3) -> DataFrame:
    """``uid, id, fp``: the fingerprint of every row, as a signed 64-bit number."""
    schema = "uid long, id long, fp long"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(t, words) for (t,) in rows_of([batch], "body")]
            yield pa.RecordBatch.from_arrays([column(batch, "uid"), column(batch, "id"), longs(signed(np.array(fps, dtype=np.uint64)))], ["uid", "id", "fp"])

    short_batches(docs.sparkSession)
    return texts(docs, key, text).select("uid", "id", F.col("body").cast("binary").alias("body")).mapInArrow(work, schema)


def block_masks(distance: int, blocks: int) -> list[int]:
    """Bit masks of which one at least keeps two fingerprints within ``distance`` equal."""
    if not distance < blocks <= BITS:
        raise ValueError("blocks must be over the distance and at most 64")
    cuts = [BITS * i // blocks for i in range(blocks + 1)]
    ranges = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(cuts, cuts[1:])]
    return [sum(chosen) for chosen in combinations(ranges, blocks - distance)]


def links(fps: DataFrame, distance: int = 3, blocks: int = 5, bucket: int = BUCKET) -> DataFrame:
    """Edges ``a, b`` between distinct values of ``fp`` that connect all within ``distance`` of each other.

    Pairs are left out only where other edges of the same bucket already connect them.
    """
    keys = F.array(*[
        F.struct(F.lit(i).alias("mask"), F.col("fp").bitwiseAND(F.lit(int(np.uint64(m).astype(np.int64)))).alias("part"))
        for i, m in enumerate(block_masks(distance, blocks))
    ])
    return bucket_links(fps.select("fp", F.explode(keys).alias("k")).select("fp", "k.mask", "k.part"), distance, bucket)


def bucket_links(keyed: DataFrame, distance: int, bucket: int) -> DataFrame:
    """Edges ``a, b`` that connect what is within ``distance`` among the rows ``fp`` of each bucket ``mask, part``."""
    shared = materialise(keyed.groupBy("mask", "part").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1))
    parts = F.ceil(F.col("n") / F.lit(bucket)).cast("int")
    own = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
    # a part meets every part, itself included: the pair (i, j) of parts with i <= j is one group
    pairs = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda j: F.struct(F.least(j, F.col("own")).alias("i"), F.greatest(j, F.col("own")).alias("j")))
    rows = join_measured(keyed, shared, ["mask", "part"], "inner", stored=True).withColumn("parts", parts).withColumn("own", own)
    group = ["mask", "part", "i", "j"]
    rows = rows.select("mask", "part", F.explode(pairs).alias("p"), "fp").select("mask", "part", "p.i", "p.j", "fp")
    dealt = rows.repartition(many(keyed), *group).sortWithinPartitions(*group, "fp")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: np.ndarray | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = np.stack([column(batch, c).to_numpy(zero_copy_only=False).astype(np.int64) for c in (*group, "fp")])
            if held is not None:
                table = np.concatenate([held, table], axis=1)
            cut = np.flatnonzero((table[:4, 1:] != table[:4, :-1]).any(axis=0)) + 1
            last = cut[-1] if len(cut) else 0
            held = table[:, last:]  # the last group may go on; it has 2 * bucket rows or so at most
            yield from emitted(table[4, :last], cut[:-1], distance)
        if held is not None:
            yield from emitted(held[4], np.zeros(0, dtype=np.int64), distance)

    return dealt.mapInArrow(work, "a long, b long")


def near(one: np.ndarray, other: np.ndarray, distance: int) -> np.ndarray:
    """Whether fingerprints differ in at most ``distance`` bits."""
    return np.bitwise_count(one ^ other) <= distance


def emitted(fps: np.ndarray, cut: np.ndarray, distance: int) -> Iterator[pa.RecordBatch]:
    """Linking edges of the groups of ``fps`` that start at 0 and at each of ``cut``."""
    if not len(fps):
        return
    values = fps.view(np.uint64)
    starts = np.concatenate([[0], cut, [len(fps)]]).astype(np.int64)
    sizes = np.diff(starts)
    found: list[tuple[np.ndarray, np.ndarray]] = []
    short = 8
    group = np.repeat(np.arange(len(sizes)), sizes)
    few = np.repeat(sizes <= short, sizes)
    for step in range(1, short):  # short groups all at once, by the distance of their rows
        at = np.flatnonzero(few[step:] & (group[step:] == group[:-step])) if len(fps) > step else np.zeros(0, dtype=np.int64)
        at = at[near(values[at], values[at + step], distance)]
        found.append((fps[at], fps[at + step]))
    for g in np.flatnonzero(sizes > short):
        here = slice(starts[g], starts[g + 1])
        found.append(forest(fps[here], values[here], distance))
    a, b = (np.concatenate(x) for x in zip(*found))
    other = a != b
    yield pa.RecordBatch.from_arrays([longs(a[other]), longs(b[other])], ["a", "b"])


def forest(fps: np.ndarray, values: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges of a spanning forest of the links within one group, fewer than its rows."""
    rest = np.arange(len(fps))
    a, b, queue = [], [], []
    while len(rest):
        if not queue:
            queue, rest = [rest[0]], rest[1:]
        x = queue.pop()
        close = near(values[rest], values[x], distance)
        if close.any():
            got, rest = rest[close], rest[~close]
            a.append(np.full(len(got), fps[x]))
            b.append(fps[got])
            queue.extend(got.tolist())
    none = np.zeros(0, dtype=np.int64)
    return (np.concatenate(a), np.concatenate(b)) if a else (none, none)


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 3, distance: int = 3, blocks: int = 5
) -> DataFrame:
    """``uid, id, fp, root, component``: one row per row of ``docs``; ``component`` is the smallest id reachable.

    Documents link if their fingerprints differ in at most ``distance`` bits. An empty table gives
    an empty result. Null ids are kept; a component of null ids alone has a null component.
    """
    rows = materialise(fingerprints(docs, key, text, words))
    distinct = materialise(rows.groupBy("fp").agg(F.min("id").alias("least")))
    roots = components(links(distinct.select("fp"), distance, blocks))
    placed = distinct.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    least = placed.groupBy("root").agg(F.min("least").alias("component"))
    classes = materialise(join_measured(placed, least, ["root"], "inner").select("fp", "root", "component"))
    return rows.join(classes, "fp", "left").select("uid", "id", "fp", "root", "component")


def kept_documents(
    docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 3, distance: int = 3, blocks: int = 5
) -> DataFrame:
    """The rows of ``docs`` that represent their group (see ``near_duplicates``): one for each, that with the smallest id.

    Null ids come last; of repeated rows with that id, one stays. Texts without a word are copies
    of each other, so one of them stays.
    """
    found = near_duplicates(docs, key, text, words, distance, blocks)
    first = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "uid"))
    chosen = found.groupBy("root").agg(first.alias("f")).select("f.uid")
    rows = with_rows(docs, key, text).select("uid", "row")
    return rows.join(chosen, "uid").dropDuplicates(["uid"]).select("row.*")


def op4_simhash(spark, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    found = near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select(
        F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id")
    )

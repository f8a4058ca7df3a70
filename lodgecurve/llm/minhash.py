"""Near-duplicate groups by b-bit MinHash.

A document is the set of its distinct word shingles. ``HASHES`` hash functions each give the set's
smallest hash; two sets agree in one with a probability equal to their Jaccard similarity.

1. *Bands.* Every ``ROWS`` full minima make one 64-bit key, and sets that share a key meet. Pairs at
   the limit of 0.85 miss each other in all bands with probability (1 - 0.85^5)^25 = 4e-7, and sets
   that have little in common do not meet by chance, however many documents there are.
2. *b-bit signatures.* Of each minimum only ``BITS`` low bits travel, packed into one value of 64
   bytes. Equal lanes are counted with bit operations; as unequal minima agree in their low bits with
   probability 2^-b, the similarity estimate is (share - 2^-b) / (1 - 2^-b). A pair whose count of
   equal lanes a pair at the limit would reach but for one time in ten million is no candidate.
3. *Full sets.* What candidates connect is gathered, and links are confirmed on the whole sets.

Equal sets meet first and cost one row. No bucket or group is paired out: within a task a spanning
forest of links is searched outwards from one set at a time. A band key of over ``BUCKET`` sets is a
star around its smallest one, which connects at least what pairs would. A group over ``MEMBERS``
sets or ``SHINGLES`` shingles is dealt to several tasks and linked within each first, then by
one set of each class found; only what is then still in several classes meets part by part.

Empty tables give empty results. Null, empty and blank texts have the empty set, which links with
nothing. Repeated rows have equal sets and share a component. Extra columns of any name are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodgecurve.llm.common import column, longs, many, rows_of, signed, texts
from lodgecurve.llm.components import components
from lodgecurve.llm.windows import gram_hashes, mixed
from lodgecurve.operators.scale import join_measured, materialise

HASHES = 128
ROWS = 5
BITS = 4
MISS = 1e-7
BUCKET = 1024
MEMBERS = 512
SHINGLES = 1 << 20
REMEMBER = 150_000
SALT = mixed(np.arange(1, HASHES + 1, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407))
FACTOR = mixed(np.arange(1, HASHES + 1, dtype=np.uint64) * np.uint64(0x9FB21C651E98DF25)) | np.uint64(1)


class Shingles:
    """Hashes of the distinct ``words``-word shingles of a UTF-8 text, ascending; A-Z lower-cased.

    Words are runs of anything but ASCII white space. A shorter text is one shingle, none has none.
    """

    def __init__(self, words: int) -> None:
        self.words, self.known = words, {}

    def __call__(self, text: bytes) -> np.ndarray:
        tokens, known = text.lower().split(), self.known
        if not tokens:
            return np.zeros(0, dtype=np.uint64)
        if len(known) > REMEMBER:
            known.clear()
        for w in set(tokens).difference(known):
            known[w] = xxhash.xxh3_64_intdigest(w)
        hashes = np.fromiter(map(known.__getitem__, tokens), dtype=np.uint64, count=len(tokens))
        size = min(self.words, len(tokens))
        return np.unique(gram_hashes(hashes, size) ^ mixed(np.array([size], dtype=np.uint64))[0])


def minima(shingles: np.ndarray) -> np.ndarray:
    """The smallest value of each hash function over a set that is not empty."""
    out = np.full(HASHES, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(shingles), 512):  # bounded memory for long texts
        out = np.minimum(out, ((shingles[at : at + 512, None] ^ SALT) * FACTOR).min(axis=0))
    return out


def band_keys(least: np.ndarray) -> np.ndarray:
    """One key for every ``ROWS`` minima, different from band to band."""
    bands = HASHES // ROWS
    keys = np.arange(1, bands + 1, dtype=np.uint64)
    for row in least[: bands * ROWS].reshape(bands, ROWS).T:
        keys = mixed(keys * np.uint64(0x9E3779B97F4A7C15) + row)
    return keys


def packed_bits(least: np.ndarray) -> bytes:
    """The low ``BITS`` bits of each minimum, spread first since multiplying keeps the lowest bit as it was."""
    lanes = (mixed(least) & np.uint64((1 << BITS) - 1)).reshape(-1, 64 // BITS)
    shifts = np.arange(64 // BITS, dtype=np.uint64) * np.uint64(BITS)
    return np.bitwise_or.reduce(lanes << shifts, axis=1).tobytes()


def equal_lanes(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Equal lanes of packed signatures, as the last axis of 64-bit words."""
    x = one ^ other
    for step in range(BITS - 1):
        x = x | ((one ^ other) >> np.uint64(step + 1))
    lowest = np.uint64(sum(1 << k for k in range(0, 64, BITS)))
    return HASHES - np.bitwise_count(x & lowest).sum(axis=-1, dtype=np.int64)


def estimated(equal) -> np.ndarray:
    """Jaccard similarity estimated from equal lanes, corrected for lanes that agree by chance."""
    chance = 2.0**-BITS
    return np.maximum(0.0, (np.asarray(equal) / HASHES - chance) / (1 - chance))


def least_lanes(similarity: float, miss: float = MISS) -> int:
    """The most equal lanes that a pair of this similarity falls short of with probability ``miss`` at most."""
    p = similarity + (1 - similarity) * 2.0**-BITS
    short = 0.0
    for k in range(HASHES + 1):
        short += comb(HASHES, k) * p**k * (1 - p) ** (HASHES - k)
        if short > miss:
            return k
    return HASHES


def signatures(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 5) -> DataFrame:
    """``uid, id, n, fp, bits, bands`` of every row: set size, hash of the set, packed signature, band keys.

    The last three are null for empty sets.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingled = Shingles(words)
        for batch in batches:
            sizes, fps, bits, bands = [], [], [], []
            for (body,) in rows_of([batch], "body"):
                s = shingled(body)
                sizes.append(len(s))
                if not len(s):
                    fps.append(None), bits.append(None), bands.append(None)
                    continue
                least = minima(s)
                fps.append(int(signed(np.array([xxhash.xxh3_64_intdigest(s.tobytes())], dtype=np.uint64))[0]))
                bits.append(packed_bits(least))
                bands.append(signed(band_keys(least)))
            made = [pa.array(fps, pa.int64()), pa.array(bits, pa.binary()), pa.array(bands, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([column(batch, "uid"), column(batch, "id"), longs(sizes), *made], ["uid", "id", "n", "fp", "bits", "bands"])

    bodies = texts(docs, key, text).select("uid", "id", F.col("body").cast("binary").alias("body"))
    return bodies.mapInArrow(work, "uid long, id long, n long, fp long, bits binary, bands array<long>")


def forest(n: int, close) -> np.ndarray:
    """Which tree of a spanning forest of links each of ``n`` things is in: ``close(x, rest)`` tells which of ``rest`` link with ``x``."""
    rest, tree, queue, trees = np.arange(n), np.zeros(n, dtype=np.int64), [], -1
    while len(rest):
        if not queue:
            trees += 1
            queue, rest = [rest[0]], rest[1:]
            tree[queue[0]] = trees
        hit = close(queue.pop(), rest)
        if hit.any():
            got, rest = rest[hit], rest[~hit]
            tree[got] = trees
            queue.extend(got.tolist())
    return tree


def stars(names: np.ndarray, tree: np.ndarray) -> pa.RecordBatch:
    """``a, b``: the smallest name of its tree for every name."""
    least = np.full(tree.max(initial=-1) + 1, np.iinfo(np.int64).max)
    np.minimum.at(least, tree, names)
    return pa.RecordBatch.from_arrays([longs(least[tree]), longs(names)], ["a", "b"])


def candidates(distinct: DataFrame, similarity: float, bucket: int = BUCKET) -> DataFrame:
    """Edges ``a, b`` over ``fp`` that connect all pairs which share a band key and whose signatures are near enough."""
    keyed = materialise(distinct.select("fp", F.posexplode("bands").alias("band", "part")))
    shared = keyed.groupBy("band", "part").agg(F.count(F.lit(1)).alias("n"), F.min("fp").alias("first")).where(F.col("n") > 1)
    shared = materialise(shared)  # its own table, so that the join's hot partitions can be split
    met = join_measured(keyed, shared, ["band", "part"], "inner", stored=True)
    hubs = met.where((F.col("n") > bucket) & (F.col("fp") != F.col("first"))).select(F.col("first").alias("a"), F.col("fp").alias("b"))
    small = materialise(met.where(F.col("n") <= bucket).select("band", "part", "fp"))
    group = ["band", "part"]
    rows = small.join(distinct.select("fp", "bits"), "fp").select(*group, "fp", "bits")
    least = least_lanes(similarity)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, fps, bits = None, [], []

        def linked() -> pa.RecordBatch:
            lanes = np.frombuffer(b"".join(bits), dtype=np.uint64).reshape(len(fps), -1)
            return stars(np.array(fps, dtype=np.int64), forest(len(fps), lambda x, rest: equal_lanes(lanes[rest], lanes[x]) >= least))

        for band, part, fp, lane in rows_of(batches, *group, "fp", "bits"):
            if (band, part) != at:
                if len(fps) > 1:
                    yield linked()
                at, fps, bits = (band, part), [], []
            fps.append(fp)
            bits.append(lane)
        if len(fps) > 1:
            yield linked()

    dealt = rows.repartition(many(distinct), *group).sortWithinPartitions(*group, "fp")
    return dealt.mapInArrow(work, "a long, b long").unionByName(hubs)


def confirmed(sets: DataFrame, percent: int, members: int = MEMBERS, most: int = SHINGLES) -> DataFrame:
    """``node, root`` of what links among the sets (``fp, root, size, bits, shingles``) of each ``root`` connect.

    A link is 100 * intersection >= ``percent`` * union, over whole sets. What stands alone may be a root of its own.
    """
    totals = sets.groupBy("root").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("size")).where(F.col("n") > 1)
    parts = F.greatest(F.ceil(F.col("n") / F.lit(members)), F.ceil(F.col("size") / F.lit(most)), F.lit(1))
    totals = materialise(totals.select("root", F.least(parts, F.col("n")).cast("int").alias("parts")))
    own = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
    rows = join_measured(sets, totals, ["root"], "inner", stored=True).withColumn("own", own)
    placed = set_links(rows.withColumn("i", F.col("own")).withColumn("j", F.col("own")), percent)  # whole groups but for wide ones
    placed = materialise(placed.withColumnsRenamed({"a": "class", "b": "fp"}))
    classes, found = placed, placed
    wide = totals.where(F.col("parts") > 1)
    if wide.isEmpty():
        return classes.select(F.col("fp").alias("node"), F.col("class").alias("root"))
    held = materialise(rows.join(wide.select("root"), "root", "left_semi"))
    for whole in (False, True):  # by one set of each class, then all sets of what is still in several
        named = held.join(classes.withColumnRenamed("fp", "node"), F.col("fp") == F.col("node"), "left").withColumn("class", F.coalesce("class", "fp"))
        split = named.groupBy("root").agg(F.min("class").alias("lo"), F.max("class").alias("hi")).where(F.col("lo") < F.col("hi")).select("root")
        split = materialise(split)
        if split.isEmpty():
            break
        left = join_measured(named if whole else named.where(F.col("class") == F.col("fp")), split, ["root"], "inner", stored=True)
        pairs = F.transform(
            F.sequence(F.lit(0), F.col("parts") - 1), lambda j: F.struct(F.least(j, F.col("own")).alias("i"), F.greatest(j, F.col("own")).alias("j"))
        )
        met = left.withColumn("p", F.explode(pairs)).withColumn("i", F.col("p.i")).withColumn("j", F.col("p.j"))
        found = found.unionByName(set_links(met, percent).withColumnsRenamed({"a": "class", "b": "fp"}))
        classes = materialise(components(found.select(F.col("class").alias("a"), F.col("fp").alias("b"))))
        classes = classes.select(F.col("node").alias("fp"), F.col("root").alias("class"))
    return classes.select(F.col("fp").alias("node"), F.col("class").alias("root"))


def set_links(rows: DataFrame, percent: int) -> DataFrame:
    """``a, b``: the smallest set that links connect a set ``b`` to, for every set of each group ``root, i, j``."""
    group = ["root", "i", "j"]
    least = least_lanes(percent / 100)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, fps, bits, held = None, [], [], []

        def linked() -> pa.RecordBatch:
            tree = similar(held, np.frombuffer(b"".join(bits), dtype=np.uint64).reshape(len(fps), -1), percent, least)
            return stars(np.array(fps, dtype=np.int64), tree)

        for root, i, j, fp, lane, shingles in rows_of(batches, *group, "fp", "bits", "shingles"):
            if (root, i, j) != at:
                if fps:
                    yield linked()
                at, fps, bits, held = (root, i, j), [], [], []
            fps.append(fp)
            bits.append(lane)
            held.append(np.frombuffer(shingles, dtype=np.uint64))
        if fps:
            yield linked()

    dealt = rows.select(*group, "fp", "bits", "shingles").repartition(many(rows), *group).sortWithinPartitions(*group, "fp")
    return dealt.mapInArrow(work, "a long, b long")


def similar(sets: list[np.ndarray], lanes: np.ndarray, percent: int, least: int) -> np.ndarray:
    """The tree that each set is in of a spanning forest of links, compared in full where size and signature allow a link."""
    sizes = np.array([len(x) for x in sets], dtype=np.int64)
    names, flat = np.unique(np.concatenate(sets), return_inverse=True)
    numbers = np.split(flat, np.cumsum(sizes)[:-1])
    marked = np.zeros(len(names), dtype=bool)

    def close(x: int, rest: np.ndarray) -> np.ndarray:
        able = 100 * np.minimum(sizes[rest], sizes[x]) >= percent * np.maximum(sizes[rest], sizes[x])
        able &= equal_lanes(lanes[rest], lanes[x]) >= least
        marked[numbers[x]] = True
        common = np.array([np.count_nonzero(marked[numbers[y]]) for y in rest[able]], dtype=np.int64)
        marked[numbers[x]] = False
        able[able] = 100 * common >= percent * (sizes[x] + sizes[rest[able]] - common)
        return able

    return forest(len(sets), close)


def minhash_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 5, percent: int = 85) -> DataFrame:
    """``uid, id, n, fp, root, component`` of every row of ``docs``.

    Rows link if 100 * intersection >= ``percent`` * union of their shingle sets, ``n`` is the set's
    size, ``component`` the smallest id reachable. An empty set's ``root`` is null and its component
    its own id, as is the component of rows whose group has null ids only.
    """
    rows = materialise(signatures(docs, key, text, words))
    distinct = rows.where(F.col("fp").isNotNull()).groupBy("fp")
    distinct = materialise(distinct.agg(F.first("bits").alias("bits"), F.first("bands").alias("bands"), F.min("uid").alias("uid")))
    loose = components(candidates(distinct, percent / 100))
    asked = materialise(distinct.select("fp", "uid", "bits").join(loose, F.col("fp") == F.col("node")).select("fp", "uid", "bits", "root"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingled = Shingles(words)
        for batch in batches:
            sets = [shingled(t) for (t,) in rows_of([batch], "body")]
            made = [column(batch, c) for c in ("fp", "root", "bits")]
            yield pa.RecordBatch.from_arrays(
                [*made, longs([len(x) for x in sets]), pa.array([x.tobytes() for x in sets], pa.binary())], ["fp", "root", "bits", "size", "shingles"]
            )

    found = texts(docs, key, text).join(asked, "uid").select("fp", "root", "bits", F.col("body").cast("binary").alias("body"))
    sets = materialise(found.mapInArrow(cut, "fp long, root long, bits binary, size long, shingles binary").dropDuplicates(["fp"]))
    return components_by(rows, confirmed(sets, percent))


def components_by(rows: DataFrame, roots: DataFrame) -> DataFrame:
    """``rows`` with their ``root`` and its smallest id; what is in no link is a root of its own."""
    least = rows.where(F.col("fp").isNotNull()).groupBy("fp").agg(F.min("id").alias("least"))
    placed = materialise(least.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("root", "fp").alias("root")))
    lowest = placed.groupBy("root").agg(F.min("least").alias("lowest"))
    classes = materialise(join_measured(placed, lowest, ["root"], "inner").select("fp", "root", "lowest"))
    component = F.when(F.col("fp").isNull(), F.col("id")).otherwise(F.col("lowest")).alias("component")
    return rows.select("uid", "id", "n", "fp").join(classes, "fp", "left").select("uid", "id", "n", "fp", "root", component)


def op11_minhash(spark, sf_dir: str) -> DataFrame:
    """Set size and near-duplicate component of every document."""
    found = minhash_groups(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"),
        F.col("id").eqNullSafe(F.col("component")).alias("kept"),
    )

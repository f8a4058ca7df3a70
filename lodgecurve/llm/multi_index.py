"""Nearest neighbours by inner product with an inverted multi-index.

Vectors are cut in two halves and each half is quantised by a codebook of its own, so ``k``
centroids a half make ``k * k`` cells for the price of two small codebooks. A query ranks the
centroids of each half by its inner product with them (the negative is the distance) and walks the
pairs in the order of their summed distance with a heap until the cells walked hold enough
vectors. Those are compared exactly.

How many are enough is measured: for queries from the fitting sample, how far along the walk their
true neighbours in the sample lie. The walk goes as far as ``recall`` of them. Clustered vectors
need a small share of the table; vectors without structure, which no coarse codes can order well,
need a large one.

What the driver holds: codebooks fitted on a sample of about ``SAMPLE`` vectors (all, of a smaller
table), and the number of vectors in each cell, ``k * k`` at most with ``k`` up to ``MOST_CENTROIDS``.
Every vector is indexed. Equal vectors are indexed once with their smallest ids, as many as can
ever be asked for, and equal queries are answered once. Cells that share their first centroid lie
together in a block, so a query meets few groups of rows; a block is dealt to tasks in parts of
about ``PART`` vectors and the queries that visit it in parts of about ``QUERIES``, so no task
holds a whole hot cell.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodgecurve.llm.common import column, quoted
from lodgecurve.operators.scale import materialise

K = 20
SAMPLE = 20_000
MOST_CENTROIDS = 1024
ROUNDS = 12
PART = 4096
QUERIES = 2048
RECALL = 0.95
LEAST = 1000
PROBES = 200
SALTS = 32


def valid(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """``id, v``: vectors of doubles, all finite, not all zero, none null, and of the most common length."""
    v = F.col(quoted(vector)).cast("array<double>")
    fine = ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists("v", lambda x: x != 0)
    found = rows.select(F.col(quoted(key)).cast("long").alias("id"), v.alias("v")).where(F.col("id").isNotNull() & F.col("v").isNotNull() & fine)
    sizes = found.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    most = sizes.agg(F.max(F.struct("n", -F.col("d"))).alias("m")).first()["m"]
    return found.where(F.size("v") == (-most[1] if most is not None else 0))


def smallest_ids(rows: DataFrame, n: int) -> DataFrame:
    """``v, ids``: each distinct vector with its ``n`` smallest ids, sorted. Copies are thinned in salted groups first."""
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)))
    order = lambda *by: F.row_number().over(Window.partitionBy(*by).orderBy("id"))
    thin = salted.withColumn("h", F.xxhash64("v")).withColumn("r", order("h", "v", "salt")).where(F.col("r") <= n)
    thin = thin.withColumn("r", order("h", "v")).where(F.col("r") <= n)
    return thin.groupBy("h", "v").agg(F.sort_array(F.collect_list("id")).alias("ids")).select("v", "ids")


def codebook(points: np.ndarray, k: int) -> np.ndarray:
    """``k`` centroids of the points by Lloyd's rounds, begun from points far from those chosen so far."""
    random = np.random.default_rng(5)
    chosen = [int(random.integers(len(points)))]
    gap = ((points - points[chosen[0]]) ** 2).sum(axis=1)
    for _ in range(1, min(k, len(points))):
        total = gap.sum()
        chosen.append(int(random.choice(len(points), p=gap / total)) if total > 0 else int(random.integers(len(points))))
        gap = np.minimum(gap, ((points - points[chosen[-1]]) ** 2).sum(axis=1))
    centroids = points[chosen].copy()
    for _ in range(ROUNDS):
        at = nearest(points, centroids)
        count = np.bincount(at, minlength=len(centroids))
        sums = np.zeros_like(centroids)
        np.add.at(sums, at, points)
        full = count > 0
        centroids[full] = sums[full] / count[full, None]
    return centroids


def nearest(points: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    out = np.empty(len(points), dtype=np.int64)
    for at in range(0, len(points), 4096):
        part = points[at : at + 4096]
        out[at : at + 4096] = ((centroids**2).sum(axis=1) - 2 * part @ centroids.T).argmin(axis=1)
    return out


def walk(first: np.ndarray, second: np.ndarray, counts: np.ndarray, wanted: int) -> list[int]:
    """Cells in the order of summed distance until they hold ``wanted`` vectors; empty cells are passed over.

    ``first`` and ``second`` are the distances to each half's centroids. A pair enters the heap once
    both pairs just before it have been taken, so the heap stays as short as the frontier.
    """
    a, b = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    x, y, k = first[a], second[b], len(second)
    heap, taken, cells, held = [(x[0] + y[0], 0, 0)], np.full(len(first), -1), [], 0
    while heap and held < wanted:
        _, i, j = heapq.heappop(heap)
        taken[i] = j
        cell = int(a[i]) * k + int(b[j])
        if counts[cell]:
            cells.append(cell)
            held += int(counts[cell])
        if i + 1 < len(x) and (j == 0 or taken[i + 1] == j - 1):
            heapq.heappush(heap, (x[i + 1] + y[j], i + 1, j))
        if j + 1 < len(y) and (i == 0 or taken[i - 1] >= j + 1):
            heapq.heappush(heap, (x[i] + y[j + 1], i, j + 1))
    return cells


def walked_share(sample: np.ndarray, books: list[np.ndarray], half: int, k: int, recall: float) -> float:
    """Share of the vectors that a walk must pass to meet ``recall`` of the true neighbours, by the sample."""
    if len(sample) < 2:
        return 1.0
    at = nearest(sample[:, :half], books[0]), nearest(sample[:, half:], books[1])
    passed = []
    for i in range(0, len(sample), max(1, len(sample) // PROBES)):
        guess = (books[0] @ sample[i, :half])[at[0]] + (books[1] @ sample[i, half:])[at[1]]
        true = sample @ sample[i]
        true[i] = -np.inf
        best = np.argsort(-true, kind="stable")[: min(k, len(sample) - 1)]
        order = np.sort(-guess)
        passed.append(np.searchsorted(order, -guess[best], side="right") / len(sample))
    return float(np.quantile(np.concatenate(passed), recall))


def matrix(values: pa.Array, width: int) -> np.ndarray:
    """A list column as a matrix."""
    flat = values.flatten() if isinstance(values, (pa.ListArray, pa.LargeListArray)) else values
    return flat.to_numpy(zero_copy_only=False).reshape(-1, width) if width else np.zeros((len(values), 0))


def best_of(queries: np.ndarray, seconds: list[np.ndarray], rows: np.ndarray, second: np.ndarray, least: np.ndarray, k: int) -> list[tuple]:
    """For each query the ``k`` best of the rows whose second centroid it visits: (rows, scores).

    A few more than ``k`` are picked by matrix products and then measured again, each product
    summed in one order wherever it is computed, so that equal vectors tie exactly.
    """
    out, spare = [], k + 8
    names = int(second.max()) + 1
    for at in range(0, len(queries), 256):
        rough = queries[at : at + 256] @ rows.T
        for i, row in enumerate(rough):
            open_ = np.zeros(max(names, int(seconds[at + i].max()) + 1), dtype=bool)
            open_[seconds[at + i]] = True
            may = np.flatnonzero(open_[second])
            if len(may) > spare:
                may = may[np.argpartition(-row[may], spare)[:spare]]
            exact = np.einsum("rd,d->r", rows[may], queries[at + i])
            order = np.lexsort((least[may], -exact))[:k]
            out.append((may[order], exact[order]))
    return out


def neighbours(
    rows: DataFrame,
    queries: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    k: int = K,
    recall: float = RECALL,
    centroids: int | None = None,
) -> DataFrame:
    """The ``k`` nearest rows of each query: ``query_id, rank, vec_id, score``, ties to the smaller id.

    Both tables have columns ``key`` and ``vector``. The score is the inner product of the original
    vectors. A row is never its own neighbour: rows with the query's id are left out. Vectors that
    are null, zero, of an uncommon length or hold null or non-finite components take no part, as
    query or candidate. Repeated rows (same id, same vector) are one row. Walks pass at least
    ``LEAST`` distinct vectors, or all there are, so a query has fewer than ``k`` neighbours only
    if the table has. ``centroids`` a half follow the square root of the number of vectors unless
    given.
    """
    base = valid(rows, key, vector).dropDuplicates(["id", "v"])
    index = materialise(smallest_ids(base, k + 1))
    facts = index.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("d")).first()
    n, width = int(facts["n"]), int(facts["d"] or 0)
    spark = rows.sparkSession
    if n == 0:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    size = centroids or 1 << max(3, min(int(math.log2(MOST_CENTROIDS)), round(math.log2(max(1.0, math.sqrt(n / 16))))))
    slot = F.pmod(F.xxhash64("v", F.lit(3)), F.lit(1 << 30))
    sample = np.array([r["v"] for r in index.where(slot < min(1 << 30, int((SAMPLE << 30) / n))).select("v").collect()], dtype=np.float64)
    if not len(sample):
        sample = np.array([r["v"] for r in index.select("v").limit(size).collect()], dtype=np.float64)
    half = (width + 1) // 2
    books = [codebook(sample[:, :half], size), codebook(sample[:, half:], size) if width > 1 else np.zeros((1, 0))]
    wanted = max(LEAST, k + 1, math.ceil(n * walked_share(sample, books, half, k, recall)))
    shared = spark.sparkContext.broadcast((books, half))
    pairs = len(books[0]) * len(books[1])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (one, two), cut = shared.value
        for batch in batches:
            v = matrix(column(batch, "v"), width)
            cell = nearest(v[:, :cut], one) * len(two) + nearest(v[:, cut:], two)
            yield pa.RecordBatch.from_arrays([pa.array(cell, pa.int64()), column(batch, "v"), column(batch, "ids")], ["cell", "v", "ids"])

    placed = materialise(index.mapInArrow(place, "cell long, v array<double>, ids array<long>"))
    counts = np.zeros(pairs, dtype=np.int64)
    for r in placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).toLocalIterator():
        counts[r["cell"]] = r["n"]
    sizes = spark.sparkContext.broadcast(counts)

    asked = valid(queries, key, vector)
    if width:
        asked = asked.where(F.size("v") == width)
    asked = materialise(asked.dropDuplicates(["id", "v"]).withColumn("q", F.xxhash64("v")))
    distinct = asked.select("q", "v").dropDuplicates(["q"])

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (one, two), cut = shared.value
        held = sizes.value
        parts = -(-held.reshape(len(one), len(two)).sum(axis=1) // PART)
        for batch in batches:
            v, q = matrix(column(batch, "v"), width), column(batch, "q").to_numpy(zero_copy_only=False)
            far = (-(v[:, :cut] @ one.T), -(v[:, cut:] @ two.T))
            for i in range(len(q)):
                cells = np.sort(np.array(walk(far[0][i], far[1][i], held, wanted), dtype=np.int64))
                block, first = np.unique(cells // len(two), return_index=True)
                seconds = np.split(cells % len(two), first[1:])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(block), q[i])), pa.array(block), pa.array(seconds, pa.list_(pa.int64())), pa.array(parts[block])],
                    ["q", "block", "seconds", "parts"],
                )

    visits = materialise(distinct.mapInArrow(visit, "q long, block long, seconds array<long>, parts long"))
    seconds_each = len(books[1])
    block = placed.select(F.expr(f"cell div {seconds_each}").alias("block"), (F.col("cell") % seconds_each).alias("second"), "v", "ids")
    visited = visits.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / QUERIES).alias("chunks"), F.max("parts").alias("parts"))  # a row for each centroid at most
    part = F.pmod(F.xxhash64("v"), F.col("parts"))
    each = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    left = block.join(F.broadcast(visited), "block").select("block", part.alias("part"), each("chunks").alias("chunk"), "second", "v", "ids")
    right = visits.drop("parts").join(F.broadcast(visited), "block")
    right = right.select("block", each("parts").alias("part"), F.pmod(F.xxhash64("q", F.lit(11)), F.col("chunks")).alias("chunk"), "q", "seconds")
    right = right.join(distinct.withColumnRenamed("v", "qv"), "q")
    groups = ["block", "part", "chunk"]

    def rerank(index_part: pd.DataFrame, query_part: pd.DataFrame) -> pd.DataFrame:
        if not len(index_part) or not len(query_part):
            return pd.DataFrame({"q": pd.Series(dtype="int64"), "v_score": pd.Series(dtype="float64"), "ids": pd.Series(dtype="object")})
        ids = index_part["ids"].to_numpy()
        best = best_of(
            np.stack(query_part["qv"].to_numpy()), query_part["seconds"].tolist(), np.stack(index_part["v"].to_numpy()),
            index_part["second"].to_numpy(), np.array([i[0] for i in ids]), k + 1,
        )
        lengths = [len(at) for at, _ in best]
        return pd.DataFrame({
            "q": np.repeat(query_part["q"].to_numpy(), lengths), "v_score": np.concatenate([s for _, s in best]), "ids": ids[np.concatenate([at for at, _ in best])]
        })

    found = left.groupBy(*groups).cogroup(right.groupBy(*groups)).applyInPandas(rerank, "q long, v_score double, ids array<long>")
    # of k + 1 distinct vectors each, k are left once the query's own row is out
    best = found.withColumn("r", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("v_score"), F.col("ids")[0]))).where(F.col("r") <= k + 1)
    answers = asked.select(F.col("id").alias("query_id"), "q").join(best.select("q", "v_score", "ids"), "q")
    pairs_of = answers.select("query_id", F.explode("ids").alias("vec_id"), F.col("v_score").alias("score")).where(F.col("vec_id") != F.col("query_id"))
    pairs_of = pairs_of.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))  # a row with two vectors counts by its better one
    ranked = pairs_of.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")))
    return ranked.where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int"), "vec_id", "score")


def op1_multi_index(spark, sf_dir: str) -> DataFrame:
    """The 20 nearest of every twentieth embedding."""
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return neighbours(rows, rows.where(F.col("vec_id") % 20 == 0))

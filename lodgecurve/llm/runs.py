"""Periodic runs of words within a text, by seeds that are extended along diagonals.

A run is a longest stretch of words with smallest period q (words q apart are equal) that has at
least ``least`` words and ``repeats`` periods. On the diagonal of lag q, the pairs (i, i + q) of
equal words, such a run covers max(least - q, (repeats - 1) * q) neighbouring places or more. The
smallest of these bounds over all q is the length k of the indexed grams, so every run holds a pair
of equal k-grams q apart.

*Seeds.* k-grams are indexed by sorting (hash, place). Of a diagonal that must hold many seeds one is
enough: for lags from D up to 2D only every t-th place is looked up, t being what a run of such a lag
is sure to hold, and its occurrences within that range of lags are read from the index. That makes
some n places a doubling of the lag, whatever the text.

*Extension.* Seeds go by rising lag and place and are extended both ways on the words themselves. A
table of the stretches covered for each lag suppresses seeds within them; a run found also covers
its stretch for the multiples of its period, whose extensions would be the same run.

Texts are whole and judged one by one, so rows are independent: no shuffle, and a task holds
one text at a time.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodgecurve.llm.common import column, longs, quoted, rows_of, texts, with_rows
from lodgecurve.llm.windows import gram_hashes, mixed, union_spans

LEAST = 24
REPEATS = 3


@dataclass(frozen=True)
class Runs:
    """What counts as a run: ``least`` words and ``repeats`` periods at least."""

    least: int = LEAST
    repeats: int = REPEATS

    def __post_init__(self) -> None:
        if self.repeats < 2 or self.least < 2:
            raise ValueError("a run has two words and two periods at least")

    def overlap(self, lag: int) -> int:
        """Places that a run of this period covers on its diagonal, at least."""
        return max(self.least - lag, (self.repeats - 1) * lag)

    @property
    def gram(self) -> int:
        return min(self.overlap(q) for q in range(1, self.least + 1))

    def find(self, words: list[bytes]) -> list[tuple[int, int, int]]:
        """``start, length, period`` of every run, by start and period."""
        n = len(words)
        if n < self.least:
            return []
        number: dict[bytes, int] = {}
        ids = np.array([number.setdefault(w, len(number)) for w in words], dtype=np.int64)
        if len(number) == n:
            return []
        lags, places = self.seeds(ids)
        out: list[tuple[int, int, int]] = []
        covered: dict[int, list[tuple[int, int]]] = {}  # by lag: stretches of the diagonal that extensions have covered
        firsts = np.flatnonzero(np.diff(lags, prepend=-1)) if len(lags) else []
        for first, end in zip(firsts, [*firsts[1:], len(lags)]):
            lag = int(lags[first])
            known, mine = union_spans(covered.pop(lag, [])), places[first:end]
            at, furthest = 0, 0
            while at < len(mine):
                i = int(mine[at])
                within = bisect_right(known, (i, n)) - 1
                if within >= 0 and i < known[within][1]:
                    furthest = known[within][1]
                else:
                    a, b = extended(ids, i, lag)
                    furthest = max(b, i + 1)
                    if b > a and b - a + lag >= max(self.least, self.repeats * lag):
                        out.append((a, b - a + lag, lag))
                        for more in range(2 * lag, (b - a + lag) // self.repeats + 1, lag):
                            covered.setdefault(more, []).append((a, b + lag - more))
                at = int(np.searchsorted(mine, furthest))
        return sorted((s, m, q) for s, m, q in out)

    def seeds(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lags and places of pairs of equal k-grams, by lag and place: one at least of every run's."""
        k, n = self.gram, len(ids)
        grams = gram_hashes(mixed(ids.astype(np.uint64) + np.uint64(1)), k)
        _, rank = np.unique(grams, return_inverse=True)
        keyed = np.sort(rank.astype(np.int64) * (2 * n) + np.arange(len(grams)))  # the index: (gram, place)
        found: list[tuple[np.ndarray, np.ndarray]] = []
        low, most = 1, n // self.repeats
        while low <= most:
            high = min(2 * low, most + 1)
            step = max(1, min(self.overlap(q) - k + 1 for q in range(low, min(high, max(low + 1, self.least + 1)))))
            place = np.arange(0, len(grams), step)
            base = rank[place].astype(np.int64) * (2 * n) + place
            a, b = np.searchsorted(keyed, base + low), np.searchsorted(keyed, base + high)
            # a lookup past the gram's last place ends in the next gram's range, which starts 2n on
            count = b - a
            held = np.flatnonzero(count)
            if len(held):
                sizes = count[held]
                offset = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                other = keyed[np.repeat(a[held], sizes) + offset] % (2 * n)
                one = np.repeat(place[held], sizes)
                found.append((other - one, one))
            low = high
        none = np.zeros(0, dtype=np.int64)
        lags, places = (np.concatenate(x) for x in zip(*found)) if found else (none, none)
        order = np.lexsort((places, lags))
        return lags[order], places[order]


def extended(ids: np.ndarray, i: int, lag: int) -> tuple[int, int]:
    """The longest stretch [a, b) of places around ``i`` whose words equal those ``lag`` on; empty if those at ``i`` differ."""
    n = len(ids) - lag
    b, step = i, 64
    while b < n:
        end = min(n, b + step)
        differ = np.flatnonzero(ids[b:end] != ids[b + lag : end + lag])
        if len(differ):
            b += int(differ[0])
            break
        b, step = end, 2 * step
    if b == i:
        return i, i
    a, step = i, 64
    while a > 0:
        start = max(0, a - step)
        differ = np.flatnonzero(ids[start:a] != ids[start + lag : a + lag])
        if len(differ):
            a = start + int(differ[-1]) + 1
            break
        a, step = start, 2 * step
    return a, b


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run of the most periods, exactly; ties go to the smallest start, then period."""
    return min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else None


def once(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words without what repeats: a word goes if any run holds it after that run's first period."""
    at, kept = 0, []
    for a, b in union_spans([(s + q, s + m) for s, m, q in runs]):
        kept += words[at:a]
        at = b
    return kept + words[at:]


def periodic_runs(
    docs: DataFrame, key: str = "doc_id", text: str = "text", rules: Runs = Runs(), rewrite: Callable[[int | None, list[bytes]], list[bytes]] | None = None
) -> DataFrame:
    """``id, n_words, runs, best, kept`` of every row of ``docs``.

    ``runs`` is an array of ``start, length, period`` in words, ``best`` the run of the most periods,
    null if there is none, ``kept`` the words left by ``once``, joined by one space. Words are runs of
    anything but ASCII white space, taken as they are. Null, empty and short texts have no run; null
    ids and repeated rows are judged like others; other columns are ignored. ``rewrite`` may
    change the words of a row first, given its id.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
        named = lambda r: None if r is None else {"start": r[0], "length": r[1], "period": r[2]}
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                sizes, runs, best, kept = [], [], [], []
                for id_, body in rows_of([batch], "id", "body"):
                    words = body.split()
                    words = words if rewrite is None else rewrite(id_, words)
                    found = rules.find(words)
                    sizes.append(len(words))
                    runs.append([named(r) for r in found])
                    best.append(named(strongest(found)))
                    kept.append(b" ".join(once(words, found)).decode())
                out = [column(batch, "id"), longs(sizes), pa.array(runs, pa.list_(kind)), pa.array(best, kind), pa.array(kept, pa.string())]
                yield pa.RecordBatch.from_arrays(out, ["id", "n_words", "runs", "best", "kept"])

    one = "struct<start: long, length: long, period: long>"
    bodies = texts(docs, key, text).select("id", F.col("body").cast("binary").alias("body"))
    return bodies.mapInArrow(work, f"id long, n_words long, runs array<{one}>, best {one}, kept string")


def without_runs(docs: DataFrame, key: str = "doc_id", text: str = "text", rules: Runs = Runs()) -> DataFrame:
    """``docs`` with every run cut down to its first period; texts without a run stay as they are, null ones null."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for (body,) in rows_of([batch], "body"):
                words = body.split()
                found = rules.find(words)
                kept.append((b" ".join(once(words, found)) if found else body).decode())
            yield pa.RecordBatch.from_arrays([column(batch, "row"), pa.array(kept, pa.string())], ["row", "kept"])

    rows = with_rows(docs, key, text).select("row", F.col("body").cast("binary").alias("body"))
    cut = rows.mapInArrow(work, rows.select("row").schema.add("kept", "string"))
    was = lambda c: F.col(f"row.{quoted(c)}")
    return cut.select(*[F.when(was(c).isNotNull(), F.col("kept")).alias(c) if c == text else was(c).alias(c) for c in docs.columns])


def planted(id_: int | None, words: list[bytes]) -> list[bytes]:
    """The words with a periodic end in one of ten documents, chosen and shaped by a checksum of the id."""
    checksum = zlib.crc32(b"" if id_ is None else str(id_).encode())
    n, g = len(words), checksum // 10
    if id_ is None or checksum % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


def op13_runs(spark, sf_dir: str) -> DataFrame:
    """Periodic runs of every document, some of which are given a periodic end first."""
    found = periodic_runs(spark.read.parquet(f"{sf_dir}/documents.parquet"), rewrite=planted)
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select(
        F.col("id").alias("doc_id"), F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(line, "").cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("kept").cast("binary"), 256).alias("collapsed_sha256"),
    )

"""Toxicity by compression distance: which of two zstandard dictionaries makes a window shorter.

One dictionary is trained on ordinary text, one on what toxic text has more of. Every window of a
document (``window`` words between spaces, lower-cased, letters only) is compressed with each; the
*margin* is how many bytes the toxic dictionary saves. Windows are counted by margin thresholds,
and a logistic model on these counts, calibrated on training documents, turns them into a score.

Dictionaries hold raw content, so a window's length depends on matches alone and not on how
common its letters are. As zstandard stores inputs of a few bytes as they are and starts no
match in the last bytes, every window ends with the same frame of digits, and so do both
dictionaries. To train the toxic dictionary on what sets toxic text apart, its samples
are the words of toxic documents that have a prefix which far more toxic than ordinary documents have,
``least_documents`` toxic ones at least, whatever their number.

Training uses at most about ``toxic_documents`` and ``ordinary_documents`` labelled documents of up
to ``training_chars`` characters, chosen by a hash of the id: all of a small table, a sample of
bounded size of a large one, and the same code for both. Everything else covers all rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodgecurve.llm.common import column, quoted, rows_of, short_batches, texts, with_rows

TOXIC_DOCUMENTS = 3000
ORDINARY_DOCUMENTS = 6000
TRAINING_CHARS = 20_000
LEAST_DOCUMENTS = 6  # with fewer, words that toxic documents hold by chance pass
ORDINARY_GROUPS = 60_000
TOXIC_BYTES = 16 << 10
ORDINARY_BYTES = 64 << 10
LEVEL = 9
THRESHOLDS = (1, 3, 4, 5, 6)
PREFIX = 4
FRAME = b"0123456789876543210"
REMEMBERED = 150_000
SPACES = re.compile(rb"[^a-z\x80-\xff]+")


def words_of(text: str) -> list[bytes]:
    """Lower-cased words of letters; every byte beyond ASCII counts as a letter."""
    return SPACES.sub(b" ", text.lower().encode()).split()


def windows_of(words: list[bytes], size: int) -> list[bytes]:
    return words if size == 1 else [b" ".join(words[i : i + size]) for i in range(0, len(words), size)]


@dataclass
class Model:
    """Two dictionaries and the calibrated weights. Without both labels to learn from, a constant."""

    toxic: bytes
    ordinary: bytes
    weights: np.ndarray
    window: int


class Margins:
    """Bytes that the toxic dictionary saves on a window, remembered for windows seen lately."""

    def __init__(self, model: Model) -> None:
        self.pair = [self.compressor(model.ordinary), self.compressor(model.toxic)]
        self.known: dict[bytes, int] = {}

    @staticmethod
    def compressor(content: bytes) -> zstandard.ZstdCompressor:
        known = zstandard.ZstdCompressionDict(content + FRAME, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        known.precompute_compress(level=LEVEL)
        return zstandard.ZstdCompressor(dict_data=known, level=LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False)

    def __call__(self, windows: list[bytes]) -> np.ndarray:
        known = self.known
        if len(known) > REMEMBERED:
            known.clear()
        ordinary, toxic = (c.compress for c in self.pair)
        for w in set(windows).difference(known):
            text = b" " + w + b" " + FRAME
            known[w] = len(ordinary(text)) - len(toxic(text))
        return np.fromiter(map(known.__getitem__, windows), dtype=np.int64, count=len(windows))


def features(margins: np.ndarray) -> np.ndarray:
    """Counts of windows by threshold, absolute and for the length of the text."""
    counts = np.array([(margins >= t).sum() for t in THRESHOLDS], dtype=np.float64)
    n = len(margins)
    return np.concatenate([[1.0, math.log1p(n) / 5], np.log1p(counts), np.sqrt(counts / (n + 20)) * 5])


def logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fitted(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Weights of a ridge logistic regression, by Newton steps; the first column is the constant."""
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[0] = 1e-6
    for _ in range(30):
        p = logistic(x @ w)
        slope = x.T @ (p - y) + penalty * w
        curve = (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(curve, slope)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def prefixes(word: bytes) -> list[bytes]:
    return [word[:k] for k in range(PREFIX, len(word) + 1)] + [b"=" + word]


def telling(samples: list[tuple[list[bytes], int]], least_documents: int = LEAST_DOCUMENTS) -> set[bytes]:
    """Prefixes (and whole words) of ``least_documents`` toxic documents that these have far more often than ordinary ones."""
    toxic = Counter()
    for words, label in samples:
        if label:
            toxic.update({p for w in set(words) for p in prefixes(w)})
    n = sum(label for _, label in samples)
    toxic = {p: k for p, k in toxic.items() if k >= least_documents}
    ordinary = Counter()  # only of prefixes that may tell, which are few
    for words, label in samples:
        if not label:
            ordinary.update({p for w in set(words) for p in prefixes(w) if p in toxic})
    share = lambda k, of: math.log((k + 0.5) / (of + 1))
    return {p for p, k in toxic.items() if share(k, n) - share(ordinary[p], len(samples) - n) > 2.5}


def dictionary(samples: list[bytes], size: int) -> bytes:
    """Content of a zstandard dictionary trained on the samples; the samples themselves if they are few."""
    plain = b"".join(samples)
    if len(samples) < 20 or len(plain) < 4 * size:
        samples = samples * (1 + 4 * size // max(1, len(plain)))
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return plain[:size]


def train(
    samples: list[tuple[str, int]], window: int = 1, least_documents: int = LEAST_DOCUMENTS, ordinary_groups: int = ORDINARY_GROUPS
) -> Model:
    """A model from labelled texts (1 toxic, 0 ordinary); the ordinary dictionary is trained on some ``ordinary_groups`` groups of four words."""
    seen: dict[bytes, bytes] = {}
    cut = [([seen.setdefault(w, w) for w in words_of(t)], label) for t, label in samples]
    toxic = sum(label for _, label in cut)
    base = math.log((toxic + 0.5) / (len(cut) - toxic + 0.5))
    constant = Model(b" ", b" ", np.concatenate([[base], np.zeros(1 + 2 * len(THRESHOLDS))]), window)
    marks = telling(cut, least_documents) if 0 < toxic < len(cut) else set()
    lines = [b" " + w + b" " for words, label in cut if label for w in words if any(p in marks for p in prefixes(w))]
    if not lines:
        return constant
    groups = [b"".join(lines[i : i + 4]) for i in range(0, len(lines), 4)]
    groups *= max(1, 20_000 // len(groups))
    places = ((words, i) for words, label in cut if not label for i in range(0, len(words), 4))
    step = max(1, sum(-(-len(words) // 4) for words, label in cut if not label) // ordinary_groups)
    plain = [b" " + b" ".join(words[i : i + 4]) + b" " for at, (words, i) in enumerate(places) if at % step == 0]
    model = Model(dictionary(groups, TOXIC_BYTES), dictionary(plain, ORDINARY_BYTES), constant.weights, window)
    margins = Margins(model)
    x = np.stack([features(margins(windows_of(words, window))) for words, _ in cut])
    model.weights = fitted(x, np.array([label for _, label in cut], dtype=np.float64))
    return model


def held_out(key) -> F.Column:
    """Rows that no label may be learnt from."""
    return F.pmod(F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), F.lit(5)) == 0


def training_rows(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, sizes: tuple[int, int], chars: int = TRAINING_CHARS) -> list[tuple[str, int]]:
    """A bounded sample of labelled texts of up to ``chars`` characters. Of several labels of a document the largest counts."""
    known = labels.select(F.col(quoted(key)).cast("long").alias("id"), F.col(quoted(label)).cast("int").alias("label"))
    known = known.where(F.col("id").isNotNull() & F.col("label").isin(0, 1)).groupBy("id").agg(F.max("label").alias("label"))
    known = known.where(~held_out(F.col("id")))
    counts = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    slot = F.pmod(F.xxhash64(F.lit(7), "id"), F.lit(1 << 20))
    share = [min(1 << 20, (size << 20) // max(1, counts.get(i, 0))) for i, size in enumerate(sizes)]
    chosen = known.where(slot < F.when(F.col("label") == 1, F.lit(share[1])).otherwise(F.lit(share[0])))
    body = texts(docs, key, text).where(F.length("body") <= chars).select("id", "uid", "body")
    rows = body.join(F.broadcast(chosen), "id").dropDuplicates(["uid"]).orderBy("id", "uid")
    return [(r["body"], r["label"]) for r in rows.select("body", "label").collect()]


def toxicity_model(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    window: int = 1,
    toxic_documents: int = TOXIC_DOCUMENTS,
    ordinary_documents: int = ORDINARY_DOCUMENTS,
    training_chars: int = TRAINING_CHARS,
    least_documents: int = LEAST_DOCUMENTS,
    ordinary_groups: int = ORDINARY_GROUPS,
) -> Model:
    """Train on a bounded sample of the labelled rows that are not held out."""
    samples = training_rows(docs, labels, key, text, label, (ordinary_documents, toxic_documents), training_chars)
    return train(samples, window, least_documents, ordinary_groups)


def scored(rows: DataFrame, model: Model, keep: str) -> DataFrame:
    """``keep`` (a column of ``rows``) and ``score`` of every row."""
    short_batches(rows.sparkSession)
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = shared.value
        margins = Margins(now)
        for batch in batches:
            x = [features(margins(windows_of(words_of(t), now.window))) for (t,) in rows_of([batch], "body")]
            scores = logistic(np.stack(x) @ now.weights) if x else np.zeros(0)
            yield pa.RecordBatch.from_arrays([column(batch, keep), pa.array(scores, pa.float64())], [keep, "score"])

    return rows.select(keep, "body").mapInArrow(work, rows.select(keep).schema.add("score", "double"))


def toxicity_scores(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", **limits) -> DataFrame:
    """``id, score`` for every row: the higher, the likelier toxic; from 0 to 1.

    Only the text enters the score. Null and empty texts get the score of a text without windows.
    """
    return scored(texts(docs, key, text), toxicity_model(docs, labels, key, text, label, **limits), "id")


def without_toxic(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", threshold: float = 0.5, **limits
) -> DataFrame:
    """The rows of ``docs`` whose score is below ``threshold``, all columns as they were."""
    model = toxicity_model(docs, labels, key, text, label, **limits)
    return scored(with_rows(docs, key, text), model, "row").where(F.col("score") < threshold).select("row.*")


def op5_toxicity(spark, sf_dir: str) -> DataFrame:
    """Toxicity of every document."""
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    found = toxicity_scores(docs, labels)
    return found.select(
        F.col("id").alias("doc_id"), held_out(F.col("id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )

"""Mixing to target weights where a document belongs to every domain a little.

A softmax classifier learnt from a labelled table gives each document a posterior over domains.
Each document then gets a nonnegative rate (how often it is to be seen), chosen so that the
expected tokens of every domain, sum over documents of rate * tokens * posterior, come as close to
the targets as they can in the least squares sense. The rates are found by projected gradient
steps with momentum from the rates of one: in each, Spark sums the expected tokens, the driver
forms one number per domain from them, and every document moves by the product of these numbers
with its posterior, down to ``least`` at most.

A document's rate depends on its posterior and the numbers of the steps so far alone, so a step is
one pass that recomputes rates from a few hundred numbers; no rates are stored or collected.

The classifier sees about ``per_domain`` labelled documents of up to ``TRAINING_CHARS`` characters
of every domain, chosen by a hash of the id; domain sizes of the whole labelled table set its
priors. Everything else covers all rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodgecurve.llm.common import column, quoted, rows_of, short_batches, texts, with_rows
from lodgecurve.operators.scale import materialise

PER_DOMAIN = 1500
TRAINING_CHARS = 20_000
HASHED = 512
STEPS = 60
TOLERANCE = 1e-3
REMEMBERED = 150_000
PART = 1024
SHARES = {"high": 0.80, "low": 0.12, "toxic": 0.08}
DOMAIN = "CASE WHEN toxic = 1 THEN 'toxic' WHEN quality = 1 THEN 'high' WHEN quality = 0 THEN 'low' END"


class Features:
    """Shares of byte values and of hashed words in a text, on a log scale; and its number of words."""

    def __init__(self) -> None:
        self.known: dict[bytes, int] = {}

    def __call__(self, body: bytes) -> tuple[np.ndarray, int]:
        words, known = body.split(), self.known
        if len(known) > REMEMBERED:
            known.clear()
        for w in set(words).difference(known):
            known[w] = xxhash.xxh3_64_intdigest(w) % HASHED
        slots = np.bincount(np.fromiter(map(known.__getitem__, words), dtype=np.int64, count=len(words)), minlength=HASHED)
        values = np.bincount(np.frombuffer(body, dtype=np.uint8), minlength=256)
        share = np.concatenate([values / (len(body) + 100) * 1000, slots / (len(words) + 20) * 100])
        return np.append(np.log1p(share), 1.0), len(words)


@dataclass
class Classifier:
    """Softmax weights, one column per domain."""

    domains: list[str]
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    def posteriors(self, x: np.ndarray) -> np.ndarray:
        z = ((x - self.mean) / self.scale) @ self.weights
        z -= z.max(axis=1, keepdims=True)
        e = np.exp(z)
        return e / e.sum(axis=1, keepdims=True)


def fitted(x: np.ndarray, y: np.ndarray, domains: list[str], priors: np.ndarray, ridge: float = 1e-3) -> Classifier:
    """Ridge softmax regression by accelerated gradient steps; ``priors`` are the domains' true sizes."""
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-3
    mean[-1], scale[-1] = 0.0, 1.0
    made = Classifier(domains, mean, scale, np.zeros((x.shape[1], len(domains))))
    z = (x - mean) / scale
    seen = np.bincount(y, minlength=len(domains))
    share = np.where(seen > 0, 1 / np.maximum(seen, 1), 0) / max(1, (seen > 0).sum())  # domains count alike
    hot = np.eye(len(domains))[y]
    step = 1 / (0.5 * float(((z * z).sum(axis=1) * share[y]).sum()) + ridge)
    ahead = made.weights.copy()
    for i in range(400):
        made.weights, last = ahead, made.weights
        p = made.posteriors(x)
        slope = z.T @ ((p - hot) * share[y][:, None]) + ridge * ahead
        made.weights = ahead - step * slope
        ahead = made.weights + i / (i + 3) * (made.weights - last)
    made.weights[-1] += np.log(np.maximum(priors, 1e-6) * (seen > 0).sum()) * (seen > 0) - 30.0 * (seen == 0)
    return made


def classifier(
    docs: DataFrame, labels: DataFrame, domains: list[str], key: str = "doc_id", text: str = "text", domain: str = DOMAIN, per_domain: int = PER_DOMAIN
) -> Classifier:
    """Learn the domains from ``labels``; ``domain`` is a SQL expression over its columns.

    Rows of no or another domain teach nothing; of several labels of a document the smallest name
    counts. Domains without a labelled document get no posterior; without any, all are equally likely.
    """
    known = labels.select(F.col(quoted(key)).cast("long").alias("id"), F.expr(domain).cast("string").alias("domain"))
    known = known.where(F.col("id").isNotNull() & F.col("domain").isin(domains)).groupBy("id").agg(F.min("domain").alias("domain"))
    sizes = {r["domain"]: r["n"] for r in known.groupBy("domain").agg(F.count(F.lit(1)).alias("n")).collect()}
    flat = Classifier(domains, np.zeros(257 + HASHED), np.ones(257 + HASHED), np.zeros((257 + HASHED, len(domains))))
    if not sizes:
        return flat
    slot = F.pmod(F.xxhash64(F.lit(2), "id"), F.lit(1 << 20))
    chosen = known.where(slot < F.coalesce(*[F.when(F.col("domain") == d, F.lit(min(1 << 20, (per_domain << 20) // n))) for d, n in sizes.items()]))
    body = texts(docs, key, text).where(F.length("body") <= TRAINING_CHARS)
    rows = body.join(F.broadcast(chosen), "id").dropDuplicates(["uid"]).orderBy("id", "uid").select("body", "domain").collect()
    if not rows:
        return flat
    measure = Features()
    x = np.stack([measure(r["body"].encode())[0] for r in rows])
    total = sum(sizes.values())
    return fitted(x, np.array([domains.index(r["domain"]) for r in rows]), domains, np.array([sizes.get(d, 0) / total for d in domains]))


def measured(batches: Iterator[pa.RecordBatch], model: Classifier) -> Iterator[pa.RecordBatch]:
    """``uid, id, tokens, p`` of each row (``uid, id, body``), with the features of ``PART`` rows in memory at once."""
    measure = Features()
    for batch in batches:
        for part in (batch.slice(at, PART) for at in range(0, batch.num_rows, PART)):
            made = [measure(b) for (b,) in rows_of([part], "body")]
            p = model.posteriors(np.stack([m[0] for m in made]))
            lists = pa.array(p.tolist(), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([column(part, "uid"), column(part, "id"), pa.array([m[1] for m in made], pa.int64()), lists], ["uid", "id", "tokens", "p"])


def memberships(docs: DataFrame, model: Classifier) -> DataFrame:
    """``uid, id, tokens, p``: words and domain posteriors of each row (``uid, id, body``)."""
    short_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = "uid long, id long, tokens long, p array<double>"
    return docs.select("uid", "id", F.col("body").cast("binary").alias("body")).mapInArrow(lambda batches: measured(batches, shared.value), schema)


def rates(p: np.ndarray, moves: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Rates after the given steps, and the point that the next step starts from."""
    now = ahead = np.ones(len(p))
    for i, move in enumerate(moves):
        last, now = now, np.maximum(least, ahead - p @ move)
        ahead = now + i / (i + 3) * (now - last)
    return now, ahead


def matrix(values: pa.Array) -> np.ndarray:
    n = len(values)
    return values.flatten().to_numpy(zero_copy_only=False).reshape(n, -1) if n else np.zeros((0, 1))


def sums(members: DataFrame, moves: np.ndarray, least: float, domains: int) -> tuple[np.ndarray, np.ndarray]:
    """Expected tokens by domain at the current rates and at the next step's start."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, domains))
        for batch in batches:
            if batch.num_rows:
                p, t = matrix(column(batch, "p")), column(batch, "tokens").to_numpy(zero_copy_only=False)
                total += np.stack([(r * t) @ p for r in rates(p, moves, least)])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(2 * domains)), pa.array(total.ravel())], ["at", "tokens"])

    out = np.zeros(2 * domains)
    for row in members.select("tokens", "p").mapInArrow(work, "at long, tokens double").groupBy("at").agg(F.sum("tokens").alias("tokens")).collect():
        out[row["at"]] = float(f"{row['tokens']:.12g}")  # so that the order of the sum does not matter
    return out[:domains], out[domains:]


def spread(members: DataFrame, domains: int) -> np.ndarray:
    """Sum over documents of tokens * p p', a matrix over domains."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((domains, domains))
        for batch in batches:
            if batch.num_rows:
                p = matrix(column(batch, "p"))
                total += (p * column(batch, "tokens").to_numpy(zero_copy_only=False)[:, None]).T @ p
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(domains**2)), pa.array(total.ravel())], ["at", "tokens"])

    out = np.zeros(domains**2)
    for row in members.select("tokens", "p").mapInArrow(work, "at long, tokens double").groupBy("at").agg(F.sum("tokens").alias("tokens")).collect():
        out[row["at"]] = float(f"{row['tokens']:.12g}")
    return out.reshape(domains, domains)


def fitted_moves(members: DataFrame, targets: np.ndarray, least: float = 0.0, steps: int = STEPS, tolerance: float = TOLERANCE) -> np.ndarray:
    """The numbers of the steps (steps x domains) that bring expected tokens to ``targets``.

    Minimises the sum of squared gaps, each over its target. Stops once no gap is over
    ``tolerance`` of its target or a step changes nothing any more.
    """
    domains, weight = len(targets), 1 / np.maximum(targets, 1e-3 * max(targets.sum(), 1.0))
    root = np.sqrt(weight)
    steepest = float(np.linalg.eigvalsh(spread(members, domains) * root[:, None] * root[None, :]).max())
    moves = np.zeros((0, domains))
    best = np.inf
    while steepest > 0 and len(moves) < steps:
        now, ahead = sums(members, moves, least, domains)
        gap = np.abs(now - targets) * weight
        if gap.max() <= tolerance:
            break
        if len(moves) % 10 == 9:
            if gap.max() > 0.999 * best:
                break
            best = gap.max()
        moves = np.vstack([moves, (ahead - targets) * weight / steepest])
    return moves


def mixing_rates(
    docs: DataFrame,
    labels: DataFrame,
    shares: dict[str, float],
    budget: float = 1.0,
    least: float = 0.0,
    key: str = "doc_id",
    text: str = "text",
    domain: str = DOMAIN,
    **limits,
) -> DataFrame:
    """``uid, id, tokens, p`` (a posterior per domain, in the order of ``shares``), ``rate, copies`` per row.

    Targets are ``shares`` (which add up to one) of ``budget`` times the words of all documents;
    ``least`` bounds the rates below (zero allows a document to be left out). ``copies`` is the
    rate rounded up or down at random, by a hash of the document, so that it is right on average.
    Null and empty texts have no tokens; they get the rate of their posterior like any other.
    """
    domains = list(shares)
    if not domains or abs(sum(shares.values()) - 1) > 1e-6 or min(shares.values()) < 0:
        raise ValueError("shares must be nonnegative and add up to one")
    rows = texts(docs, key, text)
    members = materialise(memberships(rows, classifier(docs, labels, domains, key, text, domain, **limits)))
    total = float(members.agg(F.sum("tokens").alias("n")).first()["n"] or 0)
    moves = fitted_moves(members, budget * total * np.array([shares[d] for d in domains]), least)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made, _ = rates(matrix(column(batch, "p")), moves, least)
            yield pa.RecordBatch.from_arrays([*(column(batch, c) for c in ("uid", "id", "tokens", "p")), pa.array(made, pa.float64())], ["uid", "id", "tokens", "p", "rate"])

    found = members.mapInArrow(work, "uid long, id long, tokens long, p array<double>, rate double")
    chance = F.pmod(F.xxhash64(F.lit(4), "uid"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return found.withColumn("copies", (F.floor("rate") + (chance < F.col("rate") - F.floor("rate")).cast("int")).cast("int"))


def mixed(docs: DataFrame, labels: DataFrame, shares: dict[str, float], key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs``, each as often as its ``copies`` say."""
    found = mixing_rates(docs, labels, shares, key=key, text=text, **options)
    copies = found.groupBy("uid").agg(F.first("copies").alias("copies"))  # equal for repeated rows
    rows = with_rows(docs, key, text).select("uid", "row").join(copies, "uid")
    return rows.where(F.col("copies") > 0).select(F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"), "row").select("row.*")


def op2_mixing(spark, sf_dir: str) -> DataFrame:
    """Domain posteriors, rate and copies of every document for the target shares."""
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    found = mixing_rates(docs, labels, SHARES)
    return found.select(
        F.col("id").alias("doc_id"), "tokens", *[F.col("p")[i].alias(f"p_{d}") for i, d in enumerate(SHARES)], "rate", "copies"
    )

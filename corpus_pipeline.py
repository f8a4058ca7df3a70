"""From raw documents to packed training sequences, in five stages of the corpus operators.

Every stage takes all that the one before kept, as a Parquet table, and its decisions take effect:

1. toxicity       documents whose compression-distance score reads toxic go
2. near_dedup     one document of each SimHash group (3-word shingles, 3 bits) stays
3. repeat_dedup   passages of 50 words that occur anywhere else are cut from the texts
4. mixing         documents are repeated so that expected words by quality near the target shares
5. packing        the rest becomes pieces of sequences of 4096 tokens, neighbours side by side

No stage but the first two drops a document: mixing only repeats (rates are at least one), and a
document whose whole text is repeated elsewhere stays as an empty one.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from lodgecurve.llm import mixing, packing, simhash, suffix_dedup, toxicity
from lodgecurve.operators.scale import scratch, shared_folder

QUALITY = "CASE quality WHEN 1 THEN 'high' WHEN 0 THEN 'low' END"
SHARES = {"high": 0.80, "low": 0.20}  # of the labelled words 0.87 and 0.13, so low ones come about twice
BUDGET = 1.25


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.kept_documents(docs)


def repeat_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return suffix_dedup.without_repeats(docs, length=50, chars="n_chars", unit="words")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return mixing.mixed(docs, labels, SHARES, budget=BUDGET, least=1.0, domain=QUALITY)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    packed = packing.pack(docs, packing.public_tokenizer())
    return packed.drop("ids")


STAGES = [("toxicity", not_toxic), ("near_dedup", near_dedup), ("repeat_dedup", repeat_dedup), ("mixing", mix), ("packing", pack)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table, a Parquet table after each but the last; a stage's own tables go with it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
        with scratch(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)

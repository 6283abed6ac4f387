"""A corpus pipeline over ``documents``: five stages, each written and read back.

toxicity: documents that the model rejects go. near_dedup: of each group of near
copies (five-word shingles, similarity 0.8 or more) one stays. decontamination:
documents in which a benchmark item occurs go. pii: personal data is replaced by
its kind, and ``n_chars`` follows the text. packing: the pieces of the remaining
documents in windows of 2048 tokens.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chunkwise.config import work_dir
from chunkwise.llm import decontamination, near_dedup, packing, pii, toxicity
from chunkwise.llm.common import short_batches, table
from chunkwise.llm.queries import tokenizer_file

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    short_batches(spark)
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), learn=F.lit(True), rows_per_class=4000)
    return docs.where(toxicity.toxic_score(docs["text"], model) < 0.5)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    short_batches(spark)
    return near_dedup.one_of_each(docs, shingle=5, threshold=80)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    short_batches(spark)
    return decontamination.without_leaks(docs, table(spark, sf_dir, "benchmark"), error_share=0.1)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    short_batches(spark)
    masked = pii.redact(docs)
    return masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    short_batches(spark)
    return packing.pack(docs, tokenizer_file("word_bpe_49k.json"), capacity=2048, end_id=1, keep_ids=True, cache_words=60_000)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_benchmark_leaks),
    ("pii", mask_personal_data),
    ("packing", pack_windows),
]

ORACLE_SQL = None  # models, signatures and tokens: tested against a brute-force version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages in order; each result is a written table that the next one reads."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = work_dir(spark, "pipeline", name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs

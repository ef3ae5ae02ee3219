"""From raw documents to token ids: five stages, each written as Parquet and read again by the next one."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spotframe.functions.storage import shared_dir
from spotframe.llm import bpe, decontamination, line_dedup, minhash, toxicity
from spotframe.llm.queries import table, token_digests, tokenizer_path


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a model of the labelled ones among them scores below 0.3."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def line_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the later occurrences of three-line windows; ``n_chars`` follows the text."""
    found = line_dedup.without_repeated_lines(docs)
    return found.withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


def near_duplicate_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, similarity 0.8)."""
    return minhash.without_near_duplicates(docs)


def benchmark_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no ten consecutive words of a benchmark item."""
    return decontamination.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids per document, with digests of the ids and of the text that they decode to."""
    return token_digests(bpe.encode_decode(docs, tokenizer_path()), "ids")


STAGES = [
    ("toxicity", toxicity_filter),
    ("line_dedup", line_filter),
    ("minhash", near_duplicate_filter),
    ("decontamination", benchmark_filter),
    ("bpe", tokens),
]

# The first stage trains a model, which SQL can't express; tests compare the run with a plain version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    folder = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs

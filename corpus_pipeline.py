"""A corpus pipeline over ``documents``: each stage rereads what the one before wrote."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from recurra.llm import byte_bpe, decontaminate, neardup, personal_data, quality
from recurra.llm.common import read
from recurra.llm.queries import RANKS
from recurra.session import shared_dir


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: documents that the classifier rejects go."""
    model = quality.fit_rules(docs, read(spark, sf_dir, "labels"))
    return quality.keep_good(docs, model)


def keep_one_copy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: of each class of near duplicates the document with the smallest id stays."""
    return neardup.keep_one(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: documents that hold a benchmark item go."""
    return decontaminate.drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: spans of personal data become their kind; n_chars follows the text."""
    masked = personal_data.redact(docs)
    return masked.withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: ids of each text, with digests of the ids and of the decoded bytes."""
    return byte_bpe.encode_digests(
        docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN
    )


STAGES = [
    ("quality", keep_quality),
    ("near_duplicates", keep_one_copy),
    ("decontamination", drop_benchmark),
    ("personal_data", mask_personal_data),
    ("byte_bpe", encode),
]

#: A fitted classifier and byte-level BPE cannot be said in SQL; the tests hold the stages against
#: brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    root = f"{shared_dir(spark)}/recurra-pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        path = f"{root}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)

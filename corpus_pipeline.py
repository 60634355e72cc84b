"""A corpus pipeline of five operators: from raw documents to token ids.

Each stage takes what the one before kept, as a stored table, and returns a DataFrame.
All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from genenet_spark.llm import bpe, decontaminate, jaccard, language, lines
from genenet_spark.llm.common import discard, freeze, table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: learns from the labelled rows; rows of no telling language go."""
    return language.keep_identified(docs, language.train(docs))


def drop_boilerplate_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: lines that are frequent on their site are cut; every row stays. ``n_chars`` follows the text."""
    cut = lines.drop_boilerplate(docs.withColumnRenamed("n_chars", "__n_chars"))
    chars = F.when(F.col("lines_cut") > 0, F.length("text").cast("long")).otherwise(F.col("__n_chars"))
    return cut.withColumn("n_chars", chars).select(docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6 on five-word shingles at a similarity of 0.8: one document of each group stays."""
    return jaccard.keep_one(docs, n=5, percent=80)


def decontaminate_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: documents that hold a benchmark item go."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: token ids of every document that is left, checked by decoding them."""
    return bpe.encode_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("language ID", identify_language),
    ("line dedup", drop_boilerplate_lines),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("benchmark decontamination", decontaminate_benchmark),
    ("BPE encoding and decoding", encode),
]

#: SQL can't express the classifier, the components or the encoder; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage but the last is stored, read again and deleted after the next one."""
    docs, stored = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES[:-1]:
        docs = freeze(stage(spark, docs, sf_dir), name.replace(" ", "-").lower())
        discard(*stored)
        stored = [docs]
    return STAGES[-1][1](spark, docs, sf_dir)

"""The corpus pipeline: quality rules, near duplicates, decontamination, personal data, tokens.

Each stage reads what the stage before kept and returns the columns of ``documents``; the last returns token ids.
``run`` writes each stage's rows as Parquet to the shared folder and reads them again.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.llm import bpe, decontaminate, ngram_join, pii, rules
from wardflow.llm.common import column, written
from wardflow.llm.queries import VOCABULARY


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects; null and empty texts have too few words and go, repeated rows stay each for itself."""
    return rules.filter_by_rules(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (five words, similarity 0.8) the document with the smallest id.

    Rows without id and without words are in no group and stay; of rows that repeat the kept id one stays.
    """
    return ngram_join.keep_one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark; those with fewer marked words stay as they are.

    Null and empty texts have no words and stay, repeated rows have one verdict, an empty benchmark marks nothing.
    """
    marked = decontaminate.mark_hits(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), out_col="__hits")
    return marked.where("not __hits.contaminated").drop("__hits")


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data masked; ``n_chars`` follows the new text (null texts stay null, empty ones empty)."""
    return pii.mask_personal_data(docs).withColumn("n_chars", F.length("text").cast("bigint"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids`` of every row, repeated ones included; null and empty texts have no ids."""
    ranks = bpe.load_ranks(public_tokenizers.path(VOCABULARY))
    ids = bpe.encode(docs, ranks, public_tokenizers.PATTERN, block_chars=2_500_000)
    return ids.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), "ids")


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("tokens", tokens),
]

# SQL cannot express the near-duplicate groups at this size, nor the token ids: the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

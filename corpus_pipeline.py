"""A corpus pipeline from the operators of `cohortlens.llm`.

`STAGES` lists the stages; each takes (session, documents, data folder) and
returns the documents it leaves, the last one the encoded documents. `run`
writes every stage's result as Parquet in the shared folder and rereads it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cohortlens.llm import bpe, mixing, neardup, pii, toxicity
from cohortlens.llm.queries import WORD_BPE
from cohortlens.llm.texts import documents
from cohortlens.scale import shared_folder


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go."""
    return toxicity.clean(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, the one with the smallest id."""
    return neardup.deduplicated(docs)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind in brackets."""
    return pii.masked(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated or left out so that sources meet their target weights."""
    return mixing.mix(docs)


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the encoded and decoded documents."""
    return bpe.encode_digests(docs, WORD_BPE)


STAGES = [
    ("toxicity", toxicity_stage),
    ("near_dedup", near_dedup_stage),
    ("pii", pii_stage),
    ("mixing", mixing_stage),
    ("bpe", bpe_stage),
]

# A learnt classifier and a tokenizer are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    folder = shared_folder(spark)
    for name, stage in STAGES:
        path = f"{folder}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs

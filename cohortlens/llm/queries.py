"""Registered queries of the operators: name -> function of (session, data folder), and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import (
    blocks, bpe, fingerprints, infill, language, licenses, mixing, neardup, pii, sharding, toxicity, variants, vectors,
)
from .texts import documents

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")

Query = Callable[[SparkSession, str], DataFrame]


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def op1_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(documents(spark, sf_dir))


def op2_contexts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(documents(spark, sf_dir))


def op3_lstm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blocks.extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_digests(documents(spark, sf_dir), WORD_BPE)


def op5_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(documents(spark, sf_dir))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(documents(spark, sf_dir))


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_summary(documents(spark, sf_dir))


def op8_gru(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.scores(documents(spark, sf_dir))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scored(documents(spark, sf_dir), _labels(spark, sf_dir))


def op10_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return vectors.nearest(rows, rows.where("vec_id % 20 = 0").select("vec_id"))


def op11_piece_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return infill.digests(documents(spark, sf_dir))


def op12_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.spelling_variants(documents(spark, sf_dir))


def op13_scheduling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shards(documents(spark, sf_dir))


QUERIES: dict[str, Query] = {
    "op1_syncmers": op1_syncmers,
    "op2_contexts": op2_contexts,
    "op3_lstm": op3_lstm,
    "op4_bpe": op4_bpe,
    "op5_minhash": op5_minhash,
    "op6_mixing": op6_mixing,
    "op7_licenses": op7_licenses,
    "op8_gru": op8_gru,
    "op9_toxicity": op9_toxicity,
    "op10_partitions": op10_partitions,
    "op11_piece_table": op11_piece_table,
    "op12_chunks": op12_chunks,
    "op13_scheduling": op13_scheduling,
}

ORACLES: dict[str, str] = {
    "op6_mixing": mixing.ORACLE,
    "op11_piece_table": infill.ORACLE,
    "op12_chunks": variants.ORACLE,
    "op13_scheduling": sharding.ORACLE,
}

"""The registered queries of the training-data operators, over whole tables with production parameters."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidegrid.llm import op1_line_frequency as op1
from tidegrid.llm import op2_byte_cnn as op2
from tidegrid.llm import op3_training_order as op3
from tidegrid.llm import op4_importance as op4
from tidegrid.llm import op5_hyperminhash as op5
from tidegrid.llm import op6_bpe as op6
from tidegrid.llm import op7_mixing as op7
from tidegrid.llm import op8_suffix_dedup as op8
from tidegrid.llm import op9_media as op9
from tidegrid.llm import op10_rendezvous as op10
from tidegrid.llm.runtime import documents, scratch

RANKS = "byte_bpe_50k.tiktoken"


def op1_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op1.line_quality(documents(spark, sf_dir))


def op2_byte_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op2.language_query(documents(spark, sf_dir))


def op3_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op3.training_order(documents(spark, sf_dir), f"{scratch(spark)}/op3-{uuid.uuid4().hex}", public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


def op4_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op4.importance_scores(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op5_hyperminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op5.near_duplicates(documents(spark, sf_dir)).drop("row")


def op6_chunked_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op6.encode_digest(documents(spark, sf_dir), public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


def op7_pareto_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op7.mix(documents(spark, sf_dir)).drop("copies")


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op8.removal_digest(documents(spark, sf_dir))


def op9_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op9.text_media(documents(spark, sf_dir))


def op10_rendezvous_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op10.shard_rows(documents(spark, sf_dir))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (
        op1_line_frequency, op2_byte_cnn, op3_training_order, op4_importance_resampling, op5_hyperminhash, op6_chunked_bpe,
        op7_pareto_mixing, op8_suffix_dedup, op9_media_columns, op10_rendezvous_shards,
    )
    return {f.__name__: f for f in own}

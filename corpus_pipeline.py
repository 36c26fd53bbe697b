"""A corpus pipeline of five stages over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and reread as the next stage's ``docs``.  All but the last
return the columns of ``documents``.

Defined results: columns other than doc_id, text and source travel along
whatever their names and values, nulls included.  Rows with a null or empty
text go at the first stage, which finds no evidence in them; in a later stage
such a row has no near duplicate, loses nothing, is of size 0 and has no ids.
Ties at the first stage's least kept score all stay; of repeated rows one
stays from the second stage on, until the mix repeats it.  A very long text is
one document like any other in every stage.  An empty table gives an empty
table of ids.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidegrid.llm import op4_importance, op5_hyperminhash, op6_bpe, op7_mixing, op8_suffix_dedup
from tidegrid.llm.runtime import documents, shared_dir, staged

RANKS = "byte_bpe_50k.tiktoken"
#: The near-dedup stage's least similarity of shingles of five words.
NEAR_PERCENT = 80


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Importance resampling towards documents labelled good; the rejected ones go."""
    return op4_importance.importance_select(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near-duplicates stays."""
    return op5_hyperminhash.without_near_duplicates(docs, percent=NEAR_PERCENT)


def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes of strings of 200 bytes that occur again are cut out of the texts; n_chars follows."""
    return op8_suffix_dedup.without_repeats(docs, counted="n_chars")


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are sampled to their target weights; a document may come twice."""
    return op7_mixing.mixed_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, ids) of every text; each text's ids are decoded and compared with it."""
    return op6_bpe.token_ids(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


STAGES = [
    ("quality classifier", quality),
    ("MinHash near-dedup", near_duplicates),
    ("suffix-array dedup", repeated_strings),
    ("mixing", mixing),
    ("BPE encoding", tokens),
]

#: A trained sampler, component search and a tokenizer: SQL cannot express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and reread."""
    shared_dir(spark)
    docs = documents(spark, sf_dir)
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = staged(docs, f"pipeline-{k}")
    return docs

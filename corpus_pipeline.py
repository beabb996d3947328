"""The corpus pipeline: documents become packed sequences in five stages.

Each stage works on all that its predecessor kept; what it decides takes effect on its output.
All stages but the last return the columns of documents. `run` writes each result as Parquet and
reads it back for the next stage. The defined results for nulls, empty texts, repeated rows and
empty tables are those of the operators.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from strataloom.llm.lines import drop_repeated_lines
from strataloom.llm.minhash import keep_one_of_each
from strataloom.llm.mixing import mix
from strataloom.llm.packing import pack
from strataloom.llm.quality import keep_good
from strataloom.session import materialize

#: Documents are near copies from this share of common five-word shingles on.
SIMILARITY = (80, 100)
TOKENIZER = "word_bpe_49k.json"


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the rule ensemble, fitted on the labels that are not held out, does not reject."""
    return keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without lines that nearly repeat an earlier one; those with nothing left go."""
    return drop_repeated_lines(docs)


def minhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return keep_one_of_each(docs, SIMILARITY)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words that the mix takes, a row per document and pass over its source."""
    return mix(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All pieces with their token ids and their places in sequences of 4096 tokens."""
    return pack(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_dedup),
    ("minhash_dedup", minhash_dedup),
    ("mixing", mixing),
    ("packing", packing),
]

#: The fitted rules, the draws and the tokenizer have no counterpart in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)

"""From raw documents to packed sequences: quality, near duplicates, repeated passages, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the
columns of ``docs``.  Rows with null texts or ids, repeated rows and further columns pass as
the operators' docstrings say.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tableloom.llm import packing, partenum, quality, suffixes
from tableloom.plans.scratch import discard, materialize


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labels of ``sf_dir``, does not reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    stats = materialize(quality.statistics_table(docs))
    model = quality.fit(stats, labels)
    discard(stats)
    return quality.accepted(docs, model)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each component; documents without words all stay."""
    return partenum.one_of_each(docs)


def suffix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the byte strings that occur again; ``n_chars`` is counted anew."""
    return suffixes.without_repeats(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("repeated_passages", suffix_stage),
    ("packing", packing_stage),
]

# tokenisation, the fitted model and byte-wise removal are beyond SQL; tests/llm/plain.py holds a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``, each on the stored result of the one before."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)

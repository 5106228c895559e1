"""Corpus pipeline: quality classifier, line de-duplication, near-duplicate removal, source mixing, packing.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is written and read again before the next. All
but the last return the columns of ``documents``. Nulls, empty texts, repeated rows and empty tables are handled as the
operators' docstrings say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fleetgauge.llm import line_dedup, minhash, mixing, packing, quality_qda
from fleetgauge.llm.common import materialize, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject; it learns from the labelled ones among them."""
    return quality_qda.keep_good(docs, table(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that match an earlier line; ``n_chars`` follows. Documents left without a line go.

    Lines of less than five distinct words stay, repeats included: in clean documents they repeat by chance.
    """
    return line_dedup.drop_later_matches(docs, length_col="n_chars", least=line_dedup.MIN_WORDS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of every group of near duplicates."""
    return minhash.drop_near_duplicates(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the budgets of their domain, language and source take."""
    return mixing.keep_mixed(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bucket, batch and slot of every document."""
    return packing.pack(docs)


STAGES = [
    ("quality classifier", quality),
    ("line dedup", lines),
    ("near-duplicate removal", near_duplicates),
    ("source mixing", mix),
    ("packing", pack),
]

#: SQL can express neither the classifier's Cholesky factors nor the hash minima; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs

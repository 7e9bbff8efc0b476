"""The corpus pipeline: from documents to packed training sequences.

Every stage works on all rows that its predecessor kept and returns the columns of `documents` with what it
decided applied: rejected documents are gone, removed lines and byte strings are cut out of `text`, and `n_chars`
follows the text. The last stage returns the packed pieces. Extra columns of a table pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wearline.llm import line_dedup, packing, quality_mil, simhash, suffix_dedup
from wearline.llm.common import table
from wearline.session import stored


def _counted(docs: DataFrame, columns: list[str]) -> DataFrame:
    """`columns` of `docs`, with n_chars counted anew where there is such a column."""
    return docs.select(*[F.length("text").cast("long").alias(c) if c == "n_chars" else c for c in columns])


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return quality_mil.accepted(docs, table(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of equal or similar lines one occurrence stays."""
    return _counted(line_dedup.deduplicated(docs), docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays."""
    return simhash.one_of_each(docs)


def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte strings that also start earlier go."""
    return _counted(suffix_dedup.shortened(docs), docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, placed in sequences."""
    return packing.pack(docs)


STAGES = [
    ("quality classifier", quality),
    ("line dedup", lines),
    ("simhash near-dedup", near_duplicates),
    ("suffix-array dedup", repeated_strings),
    ("best-fit packing", pack),
]

#: The classifier, the fingerprints and the linear program cannot be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; each result but the last is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)

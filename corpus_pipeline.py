"""Cleaning and mixing of the documents table, stage by stage.

Each stage takes what the one before it kept. Its result is written to the shared folder as Parquet and read again, so
a lost executor costs the running stage only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tideline.llm.decontamination import without_contaminated
from tideline.llm.exact import without_copies
from tideline.llm.jaccard import one_of_each_group
from tideline.llm.language import in_known_language
from tideline.llm.mixing import mixed_documents
from tideline.session import stored
from tideline.sources.tables import table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language; the source plays the part of the host. Rows without text go; other nulls stay.

    Here and in the stages after it, ids may be null or repeated, columns may have any names, and no rows give none.
    """
    return in_known_language(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of each group of texts that agree but for white space: the longest, then the one with the smallest id."""
    return without_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of each group of near copies: texts whose runs of five words agree to four fifths, and what these link."""
    return one_of_each_group(docs, size=5, percent=80)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that do not contain benchmark passages to a twentieth or more; texts without words stay."""
    return without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix by source weights: a row for each copy of a document it takes. A null source is one like any other."""
    return mixed_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language ID", language),
    ("exact dedup", exact),
    ("n-gram Jaccard join", near),
    ("benchmark decontamination", decontaminated),
    ("mixing sources to target weights", mixed),
]

#: The language model of the first stage is trained; SQL cannot state it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs

"""The corpus pipeline: documents to packed training sequences, in five stages.

Each stage is ``function(spark, docs, sf_dir)``; what it returns is written as Parquet and
read again as the next one's documents. All but the last return the columns of documents. Tables
that a stage writes on its way are deleted when the next stage begins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import stored, table, tables_of_stage
from tidemark.llm.decontamination import without_leaks
from tidemark.llm.jaccard_join import one_of_each
from tidemark.llm.line_dedup import drop_repeated_lines
from tidemark.llm.packing import packed_documents
from tidemark.llm.quality import keep_good

#: Tables of the stage that ran last.
_left: list[str] = []


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of low quality and toxic ones go."""
    with tables_of_stage(docs, _left):
        return keep_good(docs, table(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that an earlier document holds go; documents stay, with their new length.

    A document left without any text stays as an empty one.
    """
    with tables_of_stage(docs, _left):
        found = drop_repeated_lines(docs)
    new = {"text": F.col("text"), "n_chars": F.length("text").cast("long")}
    return found.select(*[
        new.get(c, F.col("row")[c] if c != "text" else None).alias(c) for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of linked documents the one with the smallest id stays.

    Linked are those whose sets of five-word shingles have a similarity of 0.8 or more.
    """
    with tables_of_stage(docs, _left):
        return one_of_each(docs, width=5, percent=80)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a test item go."""
    with tables_of_stage(docs, _left):
        return without_leaks(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their place in a sequence."""
    with tables_of_stage(docs, _left):
        return packed_documents(docs)


STAGES = [
    ("quality classifier", quality),
    ("line dedup", lines),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", benchmark),
    ("best-fit packing", packing),
]

#: Classifier, alignment and tokens are not for SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)

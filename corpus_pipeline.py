"""Corpus pipeline: documents to clean, distinct, tokenised documents.

Each stage works on all that the one before kept. A stage may be written as Parquet and read again before the next.

Defined cases: null, empty and wordless texts are too short and go in the first stage; rows equal in id and text go through the first two stages alike
and are one document from the third on; rows that share an id alone are documents of their own; a null id counts as later than all others and stays null;
of equal or nearly equal documents the one of least id stays, its ties broken by a hash of the text; texts are never cut by length; an empty table gives an empty
table; columns other than those of documents are dropped by the first stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from brickfolio.llm import decontaminate, lattice, line_dedup, quality_rules, simhash
from brickfolio.llm.tables import read


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality_rules.keep_good(docs, read(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines go, and documents that had no others."""
    return line_dedup.keep_first_lines(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near-duplicates the document that leads it stays."""
    return simhash.keep_one(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with benchmark passages go."""
    return decontaminate.drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source of each document with its piece ids, their number, and whether they decode to the text."""
    return lattice.tokenised(docs)


STAGES = [
    ("quality rules", quality), ("line dedup", lines), ("simhash near-dedup", near_duplicates),
    ("benchmark decontamination", decontaminated), ("sentencepiece", tokens)]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
    return docs

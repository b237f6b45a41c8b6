"""Training data from raw documents, stage by stage.

Each stage calls one operator of ``viewtide.llm`` on all rows its predecessor kept. Results are
written as Parquet below the shared folder and read again, so a stage starts from a table.

All stages but the last return the columns they are given, whatever their names; repeated rows are rows of their own, and an empty
table stays empty. Nulls in columns that a stage does not name are left as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from viewtide.llm import language, mixing, privacy, simhash, windows
from viewtide.llm.base import prepared, table
from viewtide.llm.queries import TOKENIZER
from viewtide.session import delete_folder, scratch_path, scratch_scope


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in none of the languages that the labelled ones are in go, as do null texts and those without a letter; without labels, all."""
    prepared(spark)
    return language.accepted(docs, language.learned(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, the one with the smallest id. Repeated rows are near-duplicates, texts
    without words, null ones too, are one group."""
    prepared(spark)
    return simhash.first_of_each(docs, shingle=3, bits=3)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data, and terms that give it away, are replaced. Null and empty texts stay."""
    prepared(spark)
    return privacy.masked(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are left out or repeated, so that sources, null being one, come near their targets. Null texts have no words."""
    prepared(spark)
    return mixing.mixed(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their places in sequences, and their ids. A null or empty text is the end token alone."""
    prepared(spark)
    return windows.pieces(docs, TOKENIZER, end=2, length=4096)


STAGES = [
    ("language", languages),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("mixing", mix),
    ("packing", packing),
]

#: The stages hash, fit and tokenise in ways that SQL has no functions for.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn, from ``documents`` to packed sequences.

    What a stage settled on the way is deleted when its rows are stored, and its input after that.
    """
    rows, path = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        before, path = path, scratch_path(spark, name)
        with scratch_scope(spark):
            stage(spark, rows, sf_dir).write.parquet(path)
        if before:
            delete_folder(spark, before)
        rows = spark.read.parquet(path)
    return rows

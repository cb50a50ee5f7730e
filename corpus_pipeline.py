"""A corpus pipeline of five stages over the driver's documents.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is
written as Parquet and read again as the next one's ``docs``.  All but the last
return the columns of documents.

Defined results: documents with null, empty or very short texts go in the first
stage, for want of words; rows without a doc_id pass the stages that decide by
doc_id and keep their place; equal rows are near copies of each other, of which
rows that share a doc_id stay or go together; ties go to the smaller doc_id; an
empty table gives an empty result; columns beyond those of documents are kept
as they are up to the last stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from vellum.llm import bpe, decontaminate, line_dedup, near_dedup, quality_rules
from vellum.llm.shared import Scratch, bounded, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the adaptive quality rules reject go."""
    bounded(spark)
    return quality_rules.keep(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that nearly repeat an earlier one go, and documents of nothing else."""
    bounded(spark)
    return line_dedup.keep(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies stays, unless it lies in a much larger document."""
    bounded(spark)
    return near_dedup.keep(docs, contained=True)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark questions, re-parameterised ones included, go."""
    bounded(spark)
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every text encoded; digests of its ids and of what they decode to."""
    bounded(spark)
    return bpe.digest(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("near dedup", near_duplicates),
    ("decontamination", decontamination),
    ("byte-level BPE", tokens),
]

#: SQL can't express BPE; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; a stage's input is removed once its output is written, the last stage reads the only table that stays."""
    docs, scratch = table(spark, sf_dir, "documents"), Scratch(spark)
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = scratch.table(docs, f"stage-{name.replace(' ', '-')}")
            scratch.drop(keep=1)
    return docs

"""The corpus pipeline: language ID, exact dedup, near-dedup, decontamination, packing.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor
kept, and returns a DataFrame that is written as Parquet and read again as the
next one's docs. All but the last return the columns of ``docs``. A stage's
scratch tables are deleted when the next stage begins, so its result must be
written by then; tables that the next one's docs still read stay.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from facturo.llm import decontaminate, exact_dedup, langid, near_dedup, packing
from facturo.llm.common import ScratchScope, collected_scratch, discard, materialize, prepare, read_table
from facturo.llm.tokens import default_tokenizer

#: The language models, the sketches and the packing are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


_scratch: list[ScratchScope] = []


def _stage(work: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    @functools.wraps(work)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        prepare(spark)
        own = ScratchScope(spark)
        for earlier in _scratch:
            earlier.spark = spark
            earlier.clear(unless_read_by=docs)
            own.paths += earlier.paths
        _scratch[:] = [own]
        with collected_scratch(own):
            return work(spark, docs, sf_dir)

    return run_stage


@_stage
def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in no known language (no letters, or likelier by chance) go."""
    return langid.drop_unidentified(docs, langid.fit(langid.labelled_documents(docs)))


@_stage
def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents equal but for blanks, the one with the smallest doc_id stays."""
    return exact_dedup.drop_copies(docs)


@_stage
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near copies, the document with the smallest doc_id stays."""
    return near_dedup.drop_near_copies(docs)


@_stage
def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold half of a benchmark item, in whatever order, go."""
    return decontaminate.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


@_stage
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents that stay, placed in sequences of at most 4096 tokens."""
    return packing.pack(docs, default_tokenizer(), capacity=4096, end_id=1)


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``; each result is written to the shared folder and read again."""
    docs = read_table(prepare(spark), sf_dir, "documents")
    for name, stage in STAGES:
        before, docs = docs, materialize(stage(spark, docs, sf_dir), spark, f"pipeline-{name}")
        discard(before)
    return docs

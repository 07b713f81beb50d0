"""Corpus pipeline: quality rules, language, near-duplicates, decontamination, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet in the shared folder and read again as the next one's docs.
All but the last return the columns of ``docs`` unchanged.

Defined results of the stages: a null or empty text fails the quality rules (too
few words); rows without an id are judged by their text in the first two
stages and never dropped as near duplicates; rows that share an id are
documents of their own, rows that share id and text are one; an empty table
stays empty; other columns, whatever their names, pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import decontaminate, language, near_dups, packing, repetition
from millrace.llm.queries import table
from millrace.llm.scratch import Workspace


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the repetition rules (operator 10)."""
    return repetition.keep_good(docs)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified (operator 4), by a model of the rows at hand."""
    return language.keep_identified(docs, language.fit(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group (operator 3)."""
    return near_dups.keep_one(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages (operator 5)."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 1024 tokens (operator 6)."""
    return packing.pack(docs, config=packing.Config(memo_bytes=MEMO_BYTES, text_bytes=TEXT_BYTES))


STAGES = [
    ("quality_rules", quality_rules),
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("pack_sequences", pack_sequences),
]

#: Models and sketches aren't SQL; tests hold the stages against brute force.
ORACLE_SQL = None


#: What a worker remembers of tokenized units: executors hold the other stages'
#: memory, too.  Results don't depend on it.
MEMO_BYTES = 16 << 20

#: Text that a worker of the last stage codes at once; a byte takes some 30
#: bytes of memory meanwhile.  Results don't depend on it.
TEXT_BYTES = 1 << 19

#: Rows of an Arrow batch while the stages run.  Workers and executors hold
#: several batches at once and keep that memory over stages; results don't
#: depend on it.
BATCH_ROWS = ("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``; every stage's result is written and
    read again.  Nothing is left to compute in what is returned."""
    ws = Workspace(spark, "pipeline")
    docs, before = table(spark, sf_dir, "documents"), []
    key, rows = BATCH_ROWS
    usual = spark.conf.get(key)
    spark.conf.set(key, rows)
    try:
        for name, stage in STAGES:
            docs = ws.put(name, stage(spark, docs, sf_dir))
            ws.drop(*before)
            before = [name]
    finally:
        spark.conf.set(key, usual)
    return docs

"""Documents to packed training sequences: reject, remove near-duplicates, decontaminate, pack.

In every stage a null text counts as an empty one, texts of any length are read whole, an empty table gives an empty
result, and columns other than doc_id and text are carried along as they are, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from chainloom.llm import lsh_forest, ordinal, packing, scratch, spaced_seeds


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the ordinal model of the rated ones accepts.

    Repeated rows are kept or go together; rows with a null doc_id are judged too. Without labels everything stays."""
    return ordinal.reject(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest id.

    Documents without words stay. Of equal rows one stays; a row with a null doc_id gives way to any that has one."""
    return lsh_forest.one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents in which no benchmark item is found.

    Items without an id count too, those without words do not. Repeated rows stay or go together."""
    return spaced_seeds.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 2048 tokens; of the documents' columns only doc_id is returned.

    Every row is packed, repeated ones and those with a null doc_id or text too, the latter as its end token alone."""
    return packing.pack(docs, with_ids=False)


STAGES = [("quality", quality), ("near_dedup", near_dedup), ("decontaminate", decontaminate), ("pack", pack)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``; each reads what the one before it has written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = scratch.keep(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

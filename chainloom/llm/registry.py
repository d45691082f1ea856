"""Queries of the training-data operators over their whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from chainloom.llm import sql


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_warc_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chainloom.llm.warc import round_trip

    return round_trip(table(spark, sf_dir, "pages"))


def op2_minimax_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chainloom.llm.sharding import assign_shards

    return assign_shards(table(spark, sf_dir, "documents"))


def op3_ngram_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chainloom.llm.ngram_trie import score_documents

    return score_documents(table(spark, sf_dir, "documents"))


def op4_lsh_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chainloom.llm.lsh_forest import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"))


def op5_ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chainloom.llm.ordinal import classify

    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_spaced_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chainloom.llm.spaced_seeds import find_overlaps

    return find_overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_page_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chainloom.llm.page_diff import extract

    return extract(table(spark, sf_dir, "pages"))


def op8_edit_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chainloom.llm.edit_counts import count_edited, with_mask_edits

    return count_edited(with_mask_edits(table(spark, sf_dir, "documents")))


def op9_block_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stated query set: every document whose id is divisible by 100, against all documents."""
    from chainloom.llm.block_max import search

    docs = table(spark, sf_dir, "documents")
    return search(docs, docs.where("doc_id % 100 = 0").selectExpr("doc_id as query_id", "text"))


def op10_concat_and_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chainloom.llm.packing import pack

    return pack(table(spark, sf_dir, "documents"), with_ids=False)


def op11_cross_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chainloom.llm.cross_parse import classify

    return classify(table(spark, sf_dir, "documents"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chainloom.llm.collocations import collocations

    return collocations(table(spark, sf_dir, "documents"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chainloom.llm.filter_audit import audit

    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_warc_members, op2_minimax_shards, op3_ngram_trie, op4_lsh_forest, op5_ordinal_quality, op6_spaced_seeds, op7_page_diff, op8_edit_counts, op9_block_max, op10_concat_and_cut, op11_cross_parse, op12_collocations, op13_filter_audit)}
ORACLES: dict[str, str] = {"op1_warc_members": sql.WARC_RECORDS, "op4_lsh_forest": sql.NEAR_DUPLICATES, "op9_block_max": sql.TOP_BY_BM25, "op12_collocations": sql.COLLOCATIONS, "op13_filter_audit": sql.FILTER_AUDIT}

"""The operators as queries over the given tables, and check SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from martloom.llm import (
    boosted_quality,
    channel_toxicity,
    fm_decontaminate,
    gated_lm,
    html_labeller,
    linear_packing,
    permuterm_spelling,
    prefix_bpe,
    rtree_negatives,
    secret_cnn,
    simhash_blocks,
    slot_shards,
    warc_members,
)
from martloom.llm.common import table

BPE_RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
BPE_PATTERN = public_tokenizers.PATTERN
# The same vocabulary as byte_bpe_50k.json, as ranks.
PACKING_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def op1_gated_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gated_lm.score_documents(table(spark, sf_dir, "documents"))


def op2_simhash_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_blocks.near_duplicates(table(spark, sf_dir, "documents"))


def op3_fm_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fm_decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_html_labeller(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_labeller.extract(table(spark, sf_dir, "pages"))


def op5_boosted_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return boosted_quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_secret_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_cnn.scan(table(spark, sf_dir, "documents"))


def op7_prefix_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_bpe.encode_documents(table(spark, sf_dir, "documents"), BPE_RANKS, BPE_PATTERN)


def op8_channel_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return channel_toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_warc_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_members.round_trip(table(spark, sf_dir, "pages"))


def op10_slot_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return slot_shards.place(table(spark, sf_dir, "documents"))


def op11_rtree_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rtree_negatives.hard_negatives(table(spark, sf_dir, "embeddings"))


def op12_permuterm_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return permuterm_spelling.spelling_variants(table(spark, sf_dir, "documents"))


def op13_linear_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linear_packing.pack(table(spark, sf_dir, "documents"), PACKING_RANKS, BPE_PATTERN)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_gated_lm": op1_gated_lm,
    "op2_simhash_blocks": op2_simhash_blocks,
    "op3_fm_decontaminate": op3_fm_decontaminate,
    "op4_html_labeller": op4_html_labeller,
    "op5_boosted_quality": op5_boosted_quality,
    "op6_secret_cnn": op6_secret_cnn,
    "op7_prefix_bpe": op7_prefix_bpe,
    "op8_channel_toxicity": op8_channel_toxicity,
    "op9_warc_members": op9_warc_members,
    "op10_slot_shards": op10_slot_shards,
    "op11_rtree_negatives": op11_rtree_negatives,
    "op12_permuterm_spelling": op12_permuterm_spelling,
    "op13_linear_packing": op13_linear_packing,
}

ORACLE_SQL: dict[str, str] = {
    "op3_fm_decontaminate": fm_decontaminate.SQL,
    "op9_warc_members": warc_members.SQL,
    "op11_rtree_negatives": rtree_negatives.SQL,
}

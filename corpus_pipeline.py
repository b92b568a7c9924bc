"""The corpus pipeline: documents in, token ids out, each stage written and read again."""

from __future__ import annotations

import os
import sys
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from martloom.llm import channel_toxicity, fm_decontaminate, prefix_bpe, secret_cnn, simhash_blocks  # noqa: E402
from martloom.llm.common import table  # noqa: E402
from martloom.llm.queries import BPE_PATTERN, BPE_RANKS  # noqa: E402
from martloom.session import write_once  # noqa: E402


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents not predicted toxic. Each row is judged by its own text, a null one as an empty one; an empty table gives none."""
    return channel_toxicity.accepted(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component; rows without an id all stay, empty texts are copies of each other."""
    return simhash_blocks.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated; texts without words stay, and all rows if the benchmark is empty."""
    return fm_decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each finding replaced; null texts stay null and no row is dropped."""
    return secret_cnn.redact(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row, repeats included; a null or empty text has none."""
    return prefix_bpe.encode_documents(docs, BPE_RANKS, BPE_PATTERN, ("doc_id", "lang", "source", "n_chars"), with_ids=True)


# What an executor hands a Python worker at once. Without this, two tasks hold up to 64 MB of text each, several times over
# (Arrow, strings, words, findings), in workers that stay from stage to stage.
BATCH_BYTES = "4m"


def bounded(stage):
    """The stage with batches of at most ``BATCH_BYTES`` (a longer text is a batch of its own); its rows are the same."""
    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
        return stage(spark, docs, sf_dir)

    return run_stage


STAGES = [(name, bounded(stage)) for name, stage in (
    ("toxicity", drop_toxic), ("near_dedup", drop_near_copies), ("decontamination", drop_contaminated),
    ("secrets", mask_secrets), ("encoding", encode))]

ORACLE_SQL = None  # classifiers and token ids are beyond SQL; tests compare each stage with a plain version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    for name, stage in STAGES[:-1]:
        docs = write_once(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

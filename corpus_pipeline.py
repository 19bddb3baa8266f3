"""Documents to a deduplicated, mixed and tokenised corpus, stage by stage."""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from strandloom.llm import byte_bpe, line_dedup, minhash_dedup, mixing, quality_rules  # noqa: E402
from strandloom.llm.common import table, written  # noqa: E402
from strandloom.session import ship  # noqa: E402


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base check and the weakly supervised verdict keep."""
    return quality_rules.good_documents(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The same documents without lines that are boilerplate of their source."""
    return line_dedup.drop_boilerplate(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest doc_id, of each group linked at a similarity of 0.8 or more."""
    return minhash_dedup.deduplicated(docs, 80)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Copies of documents that bring the sources' shares of bytes to their target weights, in a global shuffle."""
    return mixing.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every copy."""
    return byte_bpe.encode_decode(docs)


STAGES = [("quality rules", quality), ("line dedup", lines), ("near duplicates", near_duplicates), ("mixing", mix), ("byte-level BPE", encode)]

#: Groups of near duplicates and byte-level BPE go beyond SQL; tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each but the last is written as Parquet in the shared folder and read again."""
    docs = table(ship(spark), sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = written(docs)
    return docs

"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns the documents that the next one works
on; the last returns the sequences.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from fleetpulse.llm import line_dedup, minhash_dedup, mixing, packing, quality_rules
from fleetpulse.llm.queries import table, vocabulary
from fleetpulse.session import settle

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality_rules.keep_good(docs, table(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that ten documents share go."""
    return line_dedup.without_shared_lines(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, alike by four fifths of their shingles, stays."""
    return minhash_dedup.keep_one(docs, percent=80)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents come as often as their source's target asks for."""
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents become sequences of power-of-two lengths."""
    return packing.packed_digests(docs, vocabulary())


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality),
    ("line_dedup", lines),
    ("minhash_dedup", near_copies),
    ("mixing", mix),
    ("packing", pack),
]

#: SQL has neither the learned rules nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; each result is stored before the next stage reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

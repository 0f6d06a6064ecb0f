"""From raw documents to mixed, sharded training rows.

``STAGES`` run in order; each gets what its predecessor kept, written as
Parquet and read back.  All but the last return the columns of ``documents``;
the last adds ``shard`` and ``slot``.  The stages learn or hash, which SQL
can't express, so there is no ``ORACLE_SQL``; tests hold them against
brute-force versions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from attrlake.llm import decontam, mixing, quality, sharding, simhash
from attrlake.llm.common import stored, table


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return simhash.deduplicate(docs, shingle=4, max_bits=4)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark passages go."""
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are replicated to temperature-smoothed target weights."""
    return mixing.mix(docs)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows with their shard and slot."""
    return sharding.interleave(docs)


STAGES = [
    ("quality classifier", good_quality),
    ("SimHash near-dedup", near_dedup),
    ("benchmark decontamination", decontaminated),
    ("mixing sources to target weights", mixed),
    ("sharding", sharded),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)

"""The corpus pipeline: toxicity, near duplicates, benchmark decontamination, mixing, sharding.

Each stage takes (spark, docs, sf_dir) and returns what it keeps; ``run`` writes
each result to the shared folder and reads it for the next stage, so a lost
executor repeats one stage at most.

What the operators say of nulls, empty and very long texts, ties and repeated rows
holds for the stages. Columns of any other name pass through; the last stage's
``shard`` and ``slot`` replace such columns. Empty tables give an empty result,
and without usable labels nothing is rejected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pulsefeed.llm import decontaminate, mixing, sharding, simhash, toxicity
from pulsefeed.llm.common import keep, table


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labelled documents, does not reject."""
    model = toxicity.fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return toxicity.reject_toxic(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of SimHash links."""
    return simhash.keep_one(docs)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages, and without those that consist of them."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of the sources takes them."""
    return mixing.mix(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with shard and slot."""
    return sharding.shard(docs)


STAGES = [
    ("toxicity", reject_toxic),
    ("simhash", drop_near_duplicates),
    ("decontamination", remove_benchmark),
    ("mixing", mix_sources),
    ("sharding", shard),
]

# Scores of a fitted classifier and XXH64 majorities are not SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

"""From raw documents to mixed, sharded training text: each stage is one operator of tallyloom.llm."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyloom.llm import decontaminate, mixing, ngram_join, shards, toxicity
from tallyloom.llm.common import read, staged

SHARDS = 24


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learned from the labels not held out, does not reject."""
    model = toxicity.fit(docs, toxicity.teachable(read(spark, sf_dir, "labels")))
    return toxicity.with_scores(docs, model).where("score < 0.5").drop("score")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one of smallest id, of each group of near duplicates."""
    return ngram_join.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.clean(docs, read(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources to their target weights; a document stands once for each copy the mix takes."""
    return mixing.repeated(mixing.mix(docs))


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shards of nearly equal bytes, with a number for each row inside its shard."""
    return shards.with_slots(shards.with_shards(docs, SHARDS))


STAGES = [("toxicity", drop_toxic), ("ngram_join", drop_near_duplicates), ("decontamination", drop_contaminated),
          ("mixing", mix_sources), ("sharding", shard)]

# Toxicity is learned, which SQL cannot express; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs

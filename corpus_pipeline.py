"""The corpus pipeline: documents in, shards out, each stage one operator of shelfseek.llm.

Every stage works on all rows the one before it kept; all but the last return the columns of documents, and the mix also
each row's ``position``, by which the slots of every shard are numbered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfseek.llm import decontaminate, pfair, sharding, tensor_minhash, toxicity
from shelfseek.scratch import stored


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the lexicon, learned from the labels of documents still here, does not call toxic."""
    labels = toxicity.training_labels(spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.clean_texts(docs, toxicity.learn(docs, labels))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return tensor_minhash.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their positions in the order in which the sources' weights interleave them."""
    return pfair.mix(docs, position="position")


def cut_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every document; a shard is read in the order of the mix."""
    return sharding.shard(docs, order="position")


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("decontaminate", drop_contaminated),
    ("mix", mix_sources),
    ("shard", cut_shards),
]

#: Learned lexicons and shingle similarity have no SQL form; tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

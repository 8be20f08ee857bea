"""The corpus pipeline: documents through toxicity, near-dedup, decontamination, mixing and sharding.

Each stage reads what the one before wrote. All but the last return the columns of documents; mixing takes effect as the
order of the rows in the files, and sharding cuts that order, so each shard holds the target mix.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandloom.llm import toxicity
from strandloom.llm.common import materialise, table
from strandloom.llm.decontamination import drop_leaked, leaks
from strandloom.llm.minhash import drop_duplicates, near_duplicates
from strandloom.llm.mixing import mix_sources
from strandloom.llm.sharding import shard_documents

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold; the model learns from the labelled documents outside the held-out quarter."""
    return toxicity.drop_toxic(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of near copies: shingles of five words, similarity 0.8."""
    return drop_duplicates(docs, near_duplicates(docs, width=5, percent=80))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, verbatim or re-parameterised."""
    return drop_leaked(docs, leaks(docs, table(spark, sf_dir, "benchmark")))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in the order of the mixed stream; files and rows within them follow it."""
    mixed = mix_sources(docs)
    return mixed.repartitionByRange("mix_slot", "mix_row").sortWithinPartitions("mix_slot", "mix_row").select(*docs.columns)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with shard and slot: 16 runs of near equal bytes in the order that mixing left."""
    place = F.coalesce(F.regexp_extract("_metadata.file_name", r"part-(\d+)", 1).try_cast("bigint"), F.lit(0)) * (1 << 40) + F.col("_metadata.row_index")
    return shard_documents(docs.withColumn("__place", place), 16, key="__place").drop("__place")


STAGES: list[tuple[str, Stage]] = [("toxicity", reject_toxic), ("near_dedup", near_dedup), ("decontamination", decontaminate), ("mixing", mix), ("sharding", shard)]
#: A trained model takes the first decision, which SQL cannot express.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents table through all stages, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if stage not in (reject_toxic, shard):  # the first is a table already
            docs = materialise(docs, name)
    return docs

"""The corpus pipeline: documents through five stages, each written and read again.

Every stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quipu.llm import decontamination, mixing, sharding, simhash, toxicity
from quipu.storage import fresh_path, stored_tables


def _not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.5 or more go; the model is fitted on the labelled rows of ``docs``."""
    model = toxicity.trained(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return docs.filter(toxicity.toxicity(F.col("text"), model) < 0.5)


def _near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by fingerprints of at most three differing bits, the one with the smallest id stays."""
    return simhash.one_of_each(docs)


def _decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold any benchmark window go."""
    return decontamination.without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def _mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often, or as far, as the mix takes them."""
    return mixing.mixed(docs)


def _sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, with their shard and bytes."""
    return sharding.sharded(docs)


Stage = tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]

STAGES: list[Stage] = [
    ("toxicity", _not_toxic),
    ("near_duplicates", _near_duplicates),
    ("decontamination", _decontaminated),
    ("mixing", _mixed),
    ("sharding", _sharded),
]

#: Scores of the classifier and XXH64 with a seed cannot be said in SQL; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; each result is a Parquet table in the shared folder.

    A stage's own working tables go once its result is written; those of the last one stay, as its result is read by the caller.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        path = fresh_path(spark, name)
        with stored_tables(spark):
            function(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)

"""The corpus pipeline: five stages from ``documents`` to shards.

Each stage takes (spark, docs, sf_dir), works on all rows of ``docs`` and returns a DataFrame, which is written as
Parquet and read again as the next stage's ``docs``. All but the last return the columns of ``docs``. An empty table
passes every stage; rows with null or empty texts are clean and unlike any other; extra columns pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from statewise.llm.common import stored, table
from statewise.llm.decontaminate import drop_leaking
from statewise.llm.mixing import mixed_rows
from statewise.llm.near_dedup import keep_one_of_each
from statewise.llm.sharding import shard_by_bytes
from statewise.llm.toxicity import drop_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the toxicity model does not reject."""
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by a similarity of 0.8 of five-word shingles."""
    return keep_one_of_each(docs, width=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that hold no benchmark item."""
    return drop_leaking(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: each document as many times as its source's target takes it."""
    return mixed_rows(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row of the mix with its shard and slot."""
    return shard_by_bytes(docs)


STAGES = [
    ("toxicity", toxicity),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("sharding", sharding),
]

#: SQL can't express the learned toxicity stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each keeps is a table in the cluster's shared checkpoint folder."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)

"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The six ASCII characters that separate words: blank, tab, line feed, vertical tab, form feed, carriage return.
BLANKS = " \t\n\x0b\x0c\r"
BLANK_RUN = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The Parquet table ``name`` under ``sf_dir``, whatever file system that path is on."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _checkpoint_folder(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder, ``spark.checkpoint.dir``.

    Only a local master, as in tests, may do without that setting; then a temporary folder of this machine serves.
    """
    sc = spark.sparkContext
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not sc.master.startswith("local[") and sc.master != "local":
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="statewise-checkpoint-")
        sc.setCheckpointDir(folder)
    return sc._jsc.sc().getCheckpointDir().get()


def durable(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared checkpoint folder."""
    _checkpoint_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """``df`` written once as a Parquet table in the shared checkpoint folder and read from there; for wide rows."""
    spark = df.sparkSession
    path = f"{_checkpoint_folder(spark)}/{uuid.uuid4()}"
    df.write.parquet(path)
    return spark.read.parquet(path)


#: Ids up to this number are broadcast (8 MB); above it the join shuffles.
BROADCAST_IDS = 1_000_000


def without_ids(docs: DataFrame, ids: DataFrame, id_col: str) -> DataFrame:
    """The rows of ``docs`` whose id is not among ``ids`` (one column), with their columns."""
    ids = durable(ids.toDF("__id").filter("__id IS NOT NULL").distinct())
    ids = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
    return docs.join(ids, F.col(id_col) == F.col("__id"), "left_anti")


def words(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text as an array; empty for a null text or one without words."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, BLANK_RUN))


def utf8_bytes(text: Column) -> Column:
    """Length of ``text`` in UTF-8 bytes; 0 for null."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def hash_words(words: Sequence[bytes]) -> np.ndarray:
    """64-bit hashes of words."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))

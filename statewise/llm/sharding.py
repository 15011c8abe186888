"""Contiguous shards of near-equal bytes, from global prefix sums built out of per-partition totals."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import durable, utf8_bytes

#: A hot group of equal texts is dealt over so many parts.
HOT_PARTS = 256
#: Bits of the text's hash that name a part; parts are ranges of the hash.
PART_BITS = 12


def shard_by_bytes(
    docs: DataFrame, shards: int = 24, overhead: int = 8, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Every row of ``docs`` with its shard 0..shards-1 under the law ``bytes``.

    Documents stand in one global order, that of their text's hash and then their id, so equal texts are neighbours.
    Totals of each part of that order give its global offset; a running sum inside the part gives each document's
    position in bytes; equal targets cut the positions into contiguous shards. A group of equal texts goes to a shard
    as a whole (by its middle) as long as it is no larger than the largest document or a hundredth of a shard's target;
    larger groups are cut between their documents.

    Only ids, sizes and hashes are shuffled, never texts. A part is a range of hashes; each group above the limit has
    parts of its own, so no text, however frequent, fills one task. At most 100 * shards groups can be above it.

    Defined results: a null text has the bytes of an empty one and belongs to its group; a null id sorts first;
    repeated rows each get a slot; an empty table gives no rows; other columns are ignored; with fewer documents than
    shards some shards stay empty.

    Returns doc_id, size, text_crc32, law, shard, slot (gapless from 0 within the shard), grown_shard (null).
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = durable(
        docs.select(
            F.col(id_col).alias("doc_id"),
            (utf8_bytes(text) + overhead).alias("size"),
            F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
            F.xxhash64(text).alias("h"),
        )
    )
    total, largest = base.agg(F.sum("size"), F.max("size")).first()
    total, largest = total or 1, largest or 1
    keep = max(largest, total // (100 * shards))
    # Each such group holds more than total / (100 * shards) bytes: at most 100 * shards rows.
    hot = base.groupBy("h").agg(F.sum("size").alias("group")).filter(F.col("group") > keep).select("h", F.lit(1).alias("hot"))
    key = ["part", "hot", "hot_h", "sub"]
    dealt = (
        base.join(F.broadcast(hot), "h", "left")
        .withColumn("hot", F.coalesce("hot", F.lit(0)))
        .withColumn("part", F.shiftright("h", 64 - PART_BITS))
        .withColumn("hot_h", F.when(F.col("hot") == 1, F.col("h")).otherwise(F.lit(0)))
        .withColumn("sub", F.when(F.col("hot") == 1, F.pmod(F.xxhash64("doc_id"), F.lit(HOT_PARTS))).otherwise(F.lit(0)))
    )
    before = Window.orderBy(*key).rowsBetween(Window.unboundedPreceding, -1)
    # At most 2 ** PART_BITS + 100 * shards * HOT_PARTS rows, whatever the size of the table.
    offsets = (
        dealt.groupBy(*key)
        .agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
        .withColumn("byte_offset", F.coalesce(F.sum("bytes").over(before), F.lit(0)))
        .withColumn("row_offset", F.coalesce(F.sum("rows").over(before), F.lit(0)))
        .drop("bytes", "rows")
    )
    inside = Window.partitionBy(*key).orderBy("h", "doc_id", "text_crc32", "size").rowsBetween(Window.unboundedPreceding, 0)
    group = Window.partitionBy(*key, "h")
    placed = (
        dealt.join(offsets, key)
        .withColumn("start", F.col("byte_offset") + F.sum("size").over(inside) - F.col("size"))
        .withColumn("rank", F.col("row_offset") + F.count(F.lit(1)).over(inside) - 1)
        .withColumn("group_start", F.min("start").over(group))
        .withColumn("group_size", F.sum("size").over(group))
        .withColumn(
            "middle",  # twice the position, to stay with whole numbers
            F.when(F.col("hot") == 1, 2 * F.col("start") + F.col("size")).otherwise(2 * F.col("group_start") + F.col("group_size")),
        )
        .withColumn("shard", F.least(F.lit(shards - 1), F.expr(f"cast(middle * {shards}L div {2 * total}L as int)")))
        .select("doc_id", "size", "text_crc32", "shard", "rank")
    )
    first = placed.groupBy("shard").agg(F.min("rank").alias("first_rank"))  # one row for each shard
    return placed.join(F.broadcast(first), "shard").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("rank") - F.col("first_rank")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )

"""Mixing of sources to target weights by capped water-filling, with seeded whole and fractional repetitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import durable, words

#: Sources up to this number are broadcast; above it the join shuffles.
BROADCAST_SOURCES = 100_000


def draw_key(id_col: Column, seed: str) -> Column:
    """The seeded random key of a document: hex digits that order the documents of a source."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit(""))))


def source_plan(slim: DataFrame, max_epochs: int, weights: int) -> DataFrame:
    """One row for each source: source_size, target, whole (repetitions of all its documents) and last_key.

    ``slim`` has source, key and size. Sources by code point, null last, weigh 1..weights, repeating. The capped
    water-filling has one level L with target = min(weight * L, max_epochs * size) and targets adding up to all sizes;
    clamping and resharing until nothing is above its cap ends at that level. It is found at once: by rising
    cap / weight, the first source that need not be clamped when all before it are.

    The fraction of a source beyond its whole repetitions is drawn along its keys: documents up to last_key, until
    the words drawn are nearest the rest. Sums of 256 key ranges find the range that the cut falls in, and only that
    range of each source is put in order.
    """
    by_weight = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    upto = by_weight.rowsBetween(Window.unboundedPreceding, -1)
    rest = by_weight.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    ranges = durable(
        slim.groupBy("source", F.substring("key", 1, 2).alias("range")).agg(F.sum("size").alias("range_size"))
    )
    targets = (
        ranges.groupBy("source")
        .agg(F.sum("range_size").alias("source_size"))
        .withColumn("weight", (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % weights + 1)
        .withColumn("cap", F.col("source_size") * max_epochs)
        .withColumn("ratio", F.col("cap") / F.col("weight"))
        .withColumn("open", F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(upto), F.lit(0)))
        .withColumn("level", F.col("open") / F.sum("weight").over(rest))
        .withColumn("level", F.max(F.when(F.col("level") <= F.col("ratio"), F.col("level"))).over(everything))
        .withColumn("target", F.coalesce(F.least(F.col("level") * F.col("weight"), F.col("cap").cast("double")), F.lit(0.0)))
        .withColumn(
            "whole",
            F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("int"),
        )
        .withColumn("part", F.col("target") - F.col("whole") * F.col("source_size"))
        .select("source", "source_size", "target", "whole", "part")
    )
    along = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, 0)
    cut = (
        ranges.withColumn("end", F.sum("range_size").over(along))
        .join(targets.select(F.col("source").alias("s"), "part"), F.col("source").eqNullSafe(F.col("s")))
        .filter((F.col("end") > F.col("part")) & (F.col("part") > 0))
        .groupBy("source", "part")
        .agg(F.min(F.struct("range", (F.col("end") - F.col("range_size")).alias("start"))).alias("c"))
        .select(F.col("source").alias("s"), "part", F.col("c.range").alias("range"), F.col("c.start").alias("start"))
    )
    cut = durable(cut)
    ordered = Window.partitionBy("source").orderBy("key")
    edge = (
        slim.join(small(cut), F.col("source").eqNullSafe(F.col("s")) & (F.substring("key", 1, 2) == F.col("range")))
        .withColumn("end", F.col("start") + F.sum("size").over(ordered))
        .filter(F.col("end") - F.col("size") / 2 <= F.col("part"))
        .groupBy("source")
        .agg(F.max("key").alias("edge_key"))
    )
    cut = cut.select("s", "range").join(edge, F.col("s").eqNullSafe(F.col("source")), "left").select(
        F.col("s"), F.coalesce("edge_key", "range").alias("last_key")
    )
    return durable(
        targets.join(cut, F.col("source").eqNullSafe(F.col("s")), "left").select(
            "source", "source_size", "target", "whole", F.coalesce("last_key", F.lit("")).alias("last_key")
        )
    )


def small(plan: DataFrame) -> DataFrame:
    """``plan``, one row for each source, broadcast if there are few enough sources."""
    return F.broadcast(plan) if plan.count() <= BROADCAST_SOURCES else plan


def mix_sources(
    docs: DataFrame,
    max_epochs: int = 3,
    weights: int = 3,
    seed: str = "mix",
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
) -> DataFrame:
    """Every row of ``docs`` with the number of times that the mix takes it.

    Defined results: a null text or one without words has size 0 and takes 0 words; null is a source of its own, after
    all others; a null id draws as an empty id; repeated rows have one key and so are drawn together; an empty table
    gives no rows; other columns are ignored. If all texts are without words, every target is 0.

    Returns doc_id, size, source_size, target, taken, epochs.
    """
    slim = durable(
        docs.select(
            F.col(id_col).alias("doc_id"),
            F.col(source_col).alias("source"),
            F.size(words(F.col(text_col))).cast("long").alias("size"),
            draw_key(F.col(id_col), seed).alias("key"),
        )
    )
    plan = small(source_plan(slim, max_epochs, weights)).withColumnRenamed("source", "s")
    return (
        slim.join(plan, F.col("source").eqNullSafe(F.col("s")))
        .withColumn("epochs", F.col("whole") + (F.col("key") <= F.col("last_key")).cast("int"))
        .select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("epochs")).alias("taken"), "epochs")
    )


def mixed_rows(
    docs: DataFrame,
    max_epochs: int = 3,
    weights: int = 3,
    seed: str = "mix",
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
) -> DataFrame:
    """The mix itself: rows of ``docs`` with their columns, each as often as ``mix_sources`` takes it.

    Texts are not shuffled: the plan of each source is joined to the rows where they are.
    """
    slim = durable(
        docs.select(
            F.col(source_col).alias("source"),
            F.size(words(F.col(text_col))).cast("long").alias("size"),
            draw_key(F.col(id_col), seed).alias("key"),
        )
    )
    plan = small(source_plan(slim, max_epochs, weights)).select(
        F.col("source").alias("__mix_source"), F.col("whole").alias("__mix_whole"), F.col("last_key").alias("__mix_last")
    )
    epochs = F.col("__mix_whole") + (draw_key(F.col(id_col), seed) <= F.col("__mix_last")).cast("int")
    return (
        docs.join(plan, F.col(source_col).eqNullSafe(F.col("__mix_source")))
        .withColumn("__mix_copy", F.explode(F.sequence(F.lit(0), epochs)))
        .filter(F.col("__mix_copy") > 0)
        .select(*docs.columns)
    )

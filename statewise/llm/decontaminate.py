"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming blocks, exact weighted similarity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import without_ids

#: Words of a shingle, and the least similarity in percent.
WIDTH, PERCENT = 5, 80
#: A fingerprint has BLOCKS parts of eight bits. Two that differ in at most RADIUS bits differ in at most NEAR bits in
#: one part, as RADIUS < BLOCKS * (NEAR + 1). Windows of similarity 0.8 differ in 10 of 64 bits on average, with a
#: standard deviation of 3, so RADIUS leaves out 2 in a million.
BLOCKS, NEAR, RADIUS = 8, 2, 23
#: Rows of anchors or block keys up to this number are broadcast (some 30 bytes each), and items' shingles up to this
#: number (8 bytes each); above, the join shuffles.
BROADCAST_ROWS, BROADCAST_SHINGLES = 1_000_000, 4_000_000


def spoken(text: Column) -> Column:
    """Words of a text for comparing: runs of letters and digits in lower case."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def shingles(words: Column) -> Column:
    """Hashes of the runs of WIDTH words, by position; empty for fewer words. ``words`` is a column, not an expression.

    The words after each are taken one by one, as a slice would copy the whole array for every position.
    """
    runs = F.transform(words, lambda w, i: F.xxhash64(w, *(F.get(words, i + k) for k in range(1, WIDTH))))
    return F.when(F.size(words) >= WIDTH, F.slice(runs, F.lit(1), F.size(words) - (WIDTH - 1))).otherwise(
        F.array().cast("array<bigint>")
    )


def simhash(hashes: Column) -> Column:
    """64 bits, each the majority of that bit in the hashes; a repeated shingle counts as often as it stands there."""

    def bit(b: Column) -> Column:
        ones = F.aggregate(hashes, F.lit(0), lambda s, x: s + F.getbit(x, b).cast("int"))
        return F.when(ones * 2 > F.size(hashes), F.call_function("shiftleft", F.lit(1).cast("long"), b)).otherwise(F.lit(0).cast("long"))

    return F.aggregate(F.sequence(F.lit(0), F.lit(63)), F.lit(0).cast("long"), lambda acc, b: acc.bitwiseOR(bit(b)))


def block_of(fingerprint: Column, b: Column) -> Column:
    return F.call_function("shiftright", fingerprint, b * 8).bitwiseAND(F.lit(255)).cast("int")


def common_weight(a: Column, b: Column) -> Column:
    """Sum over shingles of the lesser of both multiplicities."""

    def times(x: Column, within: Column) -> Column:
        return F.size(F.filter(within, lambda y: y == x))

    return F.aggregate(
        F.array_intersect(a, b), F.lit(0), lambda s, x: s + F.least(times(x, a), times(x, b))
    )


def _sized(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _met(read: DataFrame, anchors: DataFrame) -> DataFrame:
    """``read`` (row, doc_id, sh) for each place p of an anchor, with the item that it is of.

    Few anchors are broadcast. Many meet the shingles alone, and what met fetches the document's array once.
    """
    small = _sized(anchors)
    if small is not anchors:
        # Outer explodes: for an inner one Spark infers a filter on the size of the array and computes it once more there.
        return read.select("row", "doc_id", "sh", F.posexplode_outer("sh").alias("p", "h")).join(small, "h").drop("h")
    hits = read.select("row", F.posexplode_outer("sh").alias("p", "h")).join(anchors, "h").select("row", "p", "item", "n_words").distinct()
    return hits.join(read.dropDuplicates(["row"]), "row")


def leaks(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """Pairs of a document and a benchmark item that it leaks.

    An item of L words leaks if some run of L words of the document (the whole document, if it is shorter) has at least
    PERCENT / 100 of weighted resemblance to it: common shingles over all shingles, each with its multiplicity.

    A window that reaches this shares one of the item's anchors, the least shingles by hash that outweigh what may
    differ; so fingerprints are only taken of the windows that hold an anchor, and each is held against that item's
    through blocks of eight bits, then exactly. A window meets an item only if both have an anchor in common, however
    many items have one length. From each anchor met, only the shingles around it go on; the items' shingles join
    what is left after the fingerprints.

    Defined results: texts of fewer than five words, empty and null ones have no shingles and match nothing, as
    documents and as items; a null id is kept as a null id; repeated documents or items give a row for each different
    pair of ids; if a document leaks an item more than once, the most similar and then the first place is told; empty
    tables give no rows; other columns are ignored.

    Returns doc_id, item_id, similarity, start (word, from 0), n_words (of the item), hamming.
    """
    known = (
        items.select(F.col(item_col).alias("item_id"), spoken(F.col(item_text_col)).alias("w"))
        .select("item_id", F.size("w").alias("n_words"), shingles(F.col("w")).alias("item_sh"))
        .filter(F.col("n_words") >= WIDTH)
        .withColumn("item", F.xxhash64("n_words", "item_sh"))
    )
    texts = known.select("item", "n_words", "item_sh").distinct()
    weight = F.size("item_sh")
    upto = Window.partitionBy("item", "n_words", "item_sh").orderBy("h").rowsBetween(Window.unboundedPreceding, -1)
    differ = weight - F.ceil(weight * PERCENT / 100) + 1  # the anchors' least weight
    anchors = (
        texts.select("item", "n_words", "item_sh", F.explode_outer("item_sh").alias("h"))
        .groupBy("item", "n_words", "item_sh", "h")
        .count()
        .withColumn("before", F.coalesce(F.sum("count").over(upto), F.lit(0)))
        .filter(F.col("before") < differ)
        .select("h", "item", "n_words")
        .distinct()
    )
    read = (
        docs.select(F.col(id_col).alias("doc_id"), spoken(F.col(text_col)).alias("w"))
        .select("doc_id", shingles(F.col("w")).alias("sh"))
        .select(F.xxhash64("doc_id", "sh").alias("row"), "doc_id", "sh")
    )
    # A window holds n_words - 4 shingles; those around an anchor at p stand within that distance of it.
    reach = F.col("n_words") - WIDTH
    met = _met(read, anchors).select(
        "doc_id",
        "item",
        "n_words",
        "p",
        "row",
        F.greatest(F.lit(0), F.size("sh") - (F.col("n_words") - WIDTH + 1)).alias("last"),
        F.greatest(F.lit(0), F.col("p") - reach).alias("from"),
        F.slice("sh", F.greatest(F.lit(0), F.col("p") - reach) + 1, 2 * reach + 1).alias("around"),
    )
    along = Window.partitionBy("row", "item").orderBy("p")
    windows = (
        met.withColumn("prev", F.lag("p").over(along))  # windows that hold the anchor before are its
        .withColumn("lo", F.greatest("from", F.coalesce(F.col("prev") + 1, F.lit(0))))
        .withColumn("hi", F.least("p", "last"))
        .filter("lo <= hi")
        .select("doc_id", "item", "n_words", "from", "around", F.explode(F.sequence("lo", "hi")).alias("start"))
        .select(
            "doc_id",
            "item",
            "n_words",
            "start",
            F.slice("around", F.col("start") - F.col("from") + 1, F.col("n_words") - WIDTH + 1).alias("window_sh"),
        )
        .withColumn("window_print", simhash(F.col("window_sh")))
    )
    every_block = F.sequence(F.lit(0), F.lit(BLOCKS - 1))
    item_keys = (
        texts.select("item", simhash(F.col("item_sh")).alias("item_print"))
        .withColumn("block", F.explode(every_block))
        .withColumn("own", block_of(F.col("item_print"), F.col("block")))
        .withColumn("value", F.explode_outer(F.filter(F.sequence(F.lit(0), F.lit(255)), lambda v: F.bit_count(v.bitwiseXOR(F.col("own"))) <= NEAR)))
        .drop("own")
    )
    hamming = F.bit_count(F.col("window_print").bitwiseXOR(F.col("item_print")))
    common = common_weight(F.col("window_sh"), F.col("item_sh"))
    # A pair is told by the first of its blocks that are near, so it is compared once.
    first_near = F.array_position(
        F.transform(
            every_block,
            lambda b: F.bit_count(block_of(F.col("window_print"), b).bitwiseXOR(block_of(F.col("item_print"), b))) <= NEAR,
        ),
        True,
    )
    # One expression, so that the second step is only taken for what passed the first.
    near = F.when(hamming <= RADIUS, first_near == F.col("block") + 1)
    weights = F.size("window_sh") + F.size("item_sh")
    size = known.agg(F.sum(F.size("item_sh"))).first()[0] or 0
    wanted = known.select("item", "item_id", "item_sh")
    return (
        windows.withColumn("block", F.explode(every_block))
        # Never null, or Spark would infer a filter and take the fingerprint once more for it.
        .withColumn("value", F.coalesce(block_of(F.col("window_print"), F.col("block")), F.lit(-1)))
        .join(_sized(item_keys), ["item", "block", "value"])
        .filter(near)
        .withColumn("hamming", hamming)
        .join(F.broadcast(wanted) if size <= BROADCAST_SHINGLES else wanted, "item")
        .filter((100 + PERCENT) * common >= PERCENT * weights)  # 100 * common >= PERCENT * (weights - common)
        .withColumn("common", common)
        .withColumn("union", weights - F.col("common"))
        .withColumn("similarity", F.col("common") / F.col("union"))
        .groupBy("doc_id", "item_id", "n_words")
        .agg(F.min(F.struct((-F.col("similarity")).alias("s"), "start", "hamming")).alias("best"))
        .groupBy("doc_id", "item_id")
        .agg(F.min(F.struct("best.s", "best.start", "n_words", "best.hamming")).alias("best"))
        .select(
            "doc_id",
            "item_id",
            (-F.col("best.s")).alias("similarity"),
            F.col("best.start").alias("start"),
            F.col("best.n_words").alias("n_words"),
            F.col("best.hamming").cast("int").alias("hamming"),
        )
    )


def drop_leaking(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that leak no item, with their columns. Rows that share an id go together; null ids stay."""
    return without_ids(docs, leaks(docs, items, id_col, text_col).select("doc_id"), id_col)

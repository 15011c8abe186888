"""MinHash near-dedup by an LSH forest: sorted signature orders, prefix neighbours, depth by region, exact links."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_IDS, durable, hash_words, without_ids
from .components import components
from .fingerprints import mix64

#: The forest: so many orders, each over so many signature values of its own, and the shortest prefix that makes
#: candidates. A pair of similarity 0.8 shares three values in at least one of 20 orders but for 6 pairs in 10 million.
TREES, DEPTH, LEAST = 20, 6, 3
SIZE = TREES * DEPTH
#: A region up to this size is compared as a whole; in a larger one each document meets as many neighbours in order,
#: and the HUBS most like the region's first block, in the first CHAINS trees; what is left open is met in blocks.
REGION, HUBS, CHAINS = 64, 4, 8
#: Rows of a block of a large group that are held against each other at once.
BLOCK = 256
#: A region beyond this size is dealt to several tasks.
PART = 1_000
#: Estimates below this can't come from a pair of similarity 0.8 (five standard deviations).
LEAST_ESTIMATE = 0.62
#: The least similarity that the forest is made for.
LEAST_PERCENT = 80

_random = np.random.default_rng(20)
MULTIPLY = (_random.integers(0, 2**31, SIZE, dtype=np.uint32) * np.uint32(2) + np.uint32(1))[:, None]
FLIP = _random.integers(0, 2**32, SIZE, dtype=np.uint32)[:, None]
ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles; a text of fewer words is one shingle; without words, none."""
    # Words ``[^\x20\x09-\x0D]+`` with A-Z in lower case.
    h = hash_words((text or "").encode("utf-8", "surrogatepass").lower().split())
    if len(h) < width:
        return np.array([xxhash.xxh3_64_intdigest(h.tobytes(), seed=len(h))], np.uint64) if len(h) else h
    n = len(h) - width + 1
    s = h[:n] * ODD[0]
    for i in range(1, width):
        s = mix64(s) + h[i : i + n] * ODD[i % 5]
    return np.unique(mix64(s))


def signature(shingles: np.ndarray) -> np.ndarray:
    """SIZE minima of 32-bit permutations of the shingles."""
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(SIZE, 2**32 - 1, np.uint32)
    for i in range(0, len(x), 1024):
        least = np.minimum(least, ((x[i : i + 1024] ^ FLIP) * MULTIPLY).min(axis=1))
    return least


def prefix_keys(least: np.ndarray) -> np.ndarray:
    """A 64-bit key of the first LEAST values in each tree."""
    v = least.reshape(TREES, DEPTH).astype(np.uint64)
    key = np.arange(1, TREES + 1, dtype=np.uint64) * ODD[0]
    for i in range(LEAST):
        key = mix64(key + v[:, i] * ODD[1])
    return key


def signatures(docs: DataFrame, width: int) -> DataFrame:
    """id, n (shingles), set_key (digest of the whole set), keys (of regions), sig (a byte of each signature value)."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, digests, keys, sigs = [], [], [], []
            for text in batch.column(1):
                s = shingle_set(text.as_py(), width)
                n.append(len(s))
                digests.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                least = signature(s) if len(s) else None
                keys.append(prefix_keys(least).view(np.int64) if len(s) else None)
                sigs.append(least.astype(np.uint8).tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(n, pa.int64()),
                    pa.array(digests, pa.binary()),
                    pa.array(keys, pa.list_(pa.int64())),
                    pa.array(sigs, pa.binary()),
                ],
                ["id", "n", "set_key", "keys", "sig"],
            )

    return docs.mapInArrow(sign, "id long, n long, set_key binary, keys array<long>, sig binary")


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal signature bytes for each pair of rows of a and b."""
    return (a[:, None, :] == b[None, :, :]).mean(axis=2)


def _forest(sim: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Which of the pairs (i, j) make a spanning forest of greatest likeness."""
    up = list(range(len(sim)))

    def root(x: int) -> int:
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    taken = np.zeros(len(i), bool)
    for e in np.argsort(-sim[i, j], kind="stable"):
        x, y = root(int(i[e])), root(int(j[e]))
        if x != y:
            up[x] = y
            taken[e] = True
    return taken


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Candidates within regions; rows come in order of region, part and the forest's order of signatures.

    Of a small region all pairs are put out, those of a spanning forest with first = 1. In a large region each document
    meets the REGION before it in order and the hubs, and the most alike is put out, in the first CHAINS trees.
    """
    carry = None

    def block(ids, n, sig, new, whole):
        """Pairs among the rows, of which those from ``new`` on are compared with all before them."""
        sim = np.triu(likeness(sig, sig), 1)
        size = n.astype(float)
        close = np.minimum.outer(size, size) >= 0.8 * np.maximum.outer(size, size) - 1e-9
        good = (sim >= LEAST_ESTIMATE) & close & (ids[:, None] != ids[None, :])
        good[:, :new] = False
        i, j = np.nonzero(good)
        if whole:
            first = _forest(sim, i, j)
        else:
            keep = np.zeros(len(i), bool)
            for to in np.unique(j):
                e = np.flatnonzero(j == to)
                keep[e[np.argmax(sim[i[e], to])]] = True
            i, j, first = i[keep], j[keep], np.ones(int(keep.sum()), bool)
        return np.minimum(ids[i], ids[j]), np.maximum(ids[i], ids[j]), first

    def rows(group):
        ids, n, sig = group
        return ids, n, np.frombuffer(b"".join(sig), np.uint8).reshape(-1, SIZE)

    def region(tree, ids, n, sig, before, last):
        """Blocks of one region; returns the pairs and what later blocks of it must still meet."""
        out, at = [], 0
        if before is None and last and len(ids) <= REGION:
            return [block(ids, n, sig, 0, True)], None
        if tree >= CHAINS:
            return [], (ids[-1:], n[-1:], sig[-1:])
        while at < len(ids):
            one = slice(at, at + REGION)
            mine = (ids[one], n[one], sig[one])
            if before is None:
                out.append(block(*mine, 0, False))
                hubs = np.argsort(-likeness(mine[2], mine[2]).sum(axis=1), kind="stable")[:HUBS]
                before = tuple(np.concatenate([x[hubs], x]) for x in mine)
            else:
                both = tuple(np.concatenate(x) for x in zip(before, mine, strict=True))
                out.append(block(*both, len(before[0]), False))
                before = tuple(np.concatenate([x[:HUBS], y]) for x, y in zip(before, mine, strict=True))
            at += REGION
        return out, before

    def emit(found):
        a, b, first = (np.concatenate(x) for x in zip(*found, strict=True)) if found else ([], [], [])
        return pa.RecordBatch.from_arrays(
            [pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(np.asarray(first, np.int32), pa.int32())], ["a", "b", "first"]
        )

    held, before = None, None  # rows of a region whose end hasn't come; the block before them
    for batch in batches:
        key = np.stack([batch.column(0).to_numpy(), batch.column(1).to_numpy().astype(np.int64)])
        trees = batch.column(2).to_numpy()
        group = (batch.column(3).to_numpy(), batch.column(4).to_numpy(), batch.column(5).to_pylist())
        cuts = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1
        found = []
        for lo, hi in zip([0, *cuts], [*cuts, len(key[0])], strict=True):
            if lo == hi:
                continue
            now = rows(tuple(x[lo:hi] for x in group))
            name = (*key[:, lo], int(trees[lo]))
            if carry is not None and name != carry:
                found += region(carry[-1], *held, before, True)[0]
                held = before = None
            held = now if held is None else tuple(np.concatenate(x) for x in zip(held, now, strict=True))
            carry = name
            whole = len(held[0]) // REGION * REGION - REGION
            if whole > 0:  # a large region: what is surely not its end goes through
                pairs, before = region(carry[-1], *(x[:whole] for x in held), before, False)
                found += pairs
                held = tuple(x[whole:] for x in held)
        yield emit(found)
    if held is not None:
        yield emit(region(carry[-1], *held, before, True)[0])


def common_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all sets of left with all of right, by products of incidence matrices."""
    both = np.intersect1d(np.concatenate(left), np.concatenate(right))
    out = np.zeros((len(left), len(right)), np.float32)
    for lo in range(0, len(both), 8192):
        columns = both[lo : lo + 8192]
        sides = []
        for sets in (left, right):
            side = np.zeros((len(sets), len(columns)), np.float32)
            for i, s in enumerate(sets):
                side[i, np.searchsorted(columns, s[np.isin(s, columns, assume_unique=True)])] = 1
            sides.append(side)
        out += sides[0] @ sides[1].T
    return out.astype(np.int64)


def _blocks(percent: int):
    def blocks(key, pdf):
        """Of one block of a large group and one chunk of its strays: a link of each stray to each other component."""
        stray, rest = pdf[pdf.stray == 1], pdf[pdf.stray == 0]
        found = []
        if len(stray) and len(rest):
            left, right = ([np.frombuffer(x, np.uint64) for x in side.shingles] for side in (stray, rest))
            n, m = stray.n.to_numpy(), rest.n.to_numpy()
            both = common_counts(left, right)
            linked = 100 * both >= percent * (n[:, None] + m[None, :] - both)
            linked &= stray.label.to_numpy()[:, None] != rest.label.to_numpy()[None, :]
            i, j = np.nonzero(linked)
            found = pd.DataFrame({"a": stray.node.to_numpy()[i], "b": rest.node.to_numpy()[j], "l": rest.label.to_numpy()[j]})
            found = found.drop_duplicates(["a", "l"])[["a", "b"]].to_numpy().tolist()
        return pd.DataFrame([(min(x), max(x)) for x in found], columns=["a", "b"], dtype="int64")

    return blocks


def _confirm(percent: int):
    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return confirm


def near_groups(
    docs: DataFrame, width: int = 4, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> tuple[DataFrame, DataFrame]:
    """Groups of near-duplicates, and the confirmed links that make them.

    A document's set has its distinct shingles of ``width`` words. Documents of equal sets are one node, the smallest
    id. Nodes stand in TREES sorted orders of their signatures; those that share at least LEAST leading values form a
    region. In a region up to REGION nodes all pairs are candidates; in a larger one the order goes deeper by itself:
    each node meets those before it with the longest common prefixes. Candidates of a spanning forest are confirmed on
    full sets first; what is left is only confirmed between different components. In large regions every node outside
    the largest component is then held against all nodes of the region on full sets, in blocks, so nothing is lost to
    the region's size. The links returned connect what is alike; not every pair within a component is among them.

    Defined results: null or empty texts and texts without words have an empty set and link with nothing; a null id is
    treated as any other node of its own, never linked; rows with one id share its component; repeated rows are all
    kept; an empty table gives no rows; other columns are ignored. The forest and the least estimate are made for
    pairs of similarity 0.8 or more: a lower ``percent`` is refused, as links would be lost.

    Returns (doc_id, n_shingles, component_id, kept) and (a, b), links between nodes.
    """
    if not LEAST_PERCENT <= percent <= 100:
        raise ValueError(f"percent is {LEAST_PERCENT} to 100, not {percent}")
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    signed = durable(signatures(texts, width))
    full = signed.filter("n > 0 AND id IS NOT NULL")
    rep = full.groupBy("set_key").agg(F.min("id").alias("node"), F.max("n").alias("n"))
    # The second key changes no match, but the join deals both sides anew, and a hot set can be split.
    members = full.select("id", "n", "set_key").join(rep, ["set_key", "n"])
    nodes = durable(
        full.join(rep.withColumnRenamed("node", "id"), ["set_key", "id", "n"])
        .select(F.col("id").alias("node"), "n", "keys", "sig")
    )
    slim = nodes.select("node", F.posexplode("keys").alias("tree", "key"))
    regions = durable(
        slim.groupBy("key").agg(F.count("*").alias("many"), F.min("node").alias("pivot")).filter("many > 1")
    )
    parts = F.ceil(F.col("many") / PART).cast("int")
    own_part = F.array(F.pmod(F.xxhash64("node"), parts).cast("int"))
    # The first node of a region that is dealt to several tasks is in each of them.
    in_parts = F.when(F.col("node") == F.col("pivot"), F.sequence(F.lit(0), parts - 1)).otherwise(own_part)
    inside = (
        slim.join(regions, "key")
        .withColumn("part", F.explode(in_parts))
        .join(nodes.select("node", "n", "sig"), "node")
    )
    order = F.expr(f"concat(substring(sig, tree * {DEPTH} + 1, {DEPTH}), sig)")
    candidates = (
        inside.select("key", "part", "tree", "node", "n", "sig", order.alias("order"))
        .repartition("key", "part")
        .sortWithinPartitions("key", "part", "order", "node")
        .select("key", "part", "tree", "node", "n", "sig")
        .mapInArrow(_neighbours, "a long, b long, first int")
    )
    candidates = durable(candidates.groupBy("a", "b").agg(F.max("first").alias("first")))

    ends = candidates.select(F.explode(F.array("a", "b")).alias("id"))
    large = durable(inside.filter(F.col("many") > REGION).select("key", "node").distinct())
    ids = durable(ends.union(large.select("node")).distinct())
    few = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
    sets = durable(texts.join(few, "id", "left_semi").mapInArrow(_sets(width), "id long, shingles binary"))

    def confirmed(pairs: DataFrame) -> DataFrame:
        x = sets.select(F.col("id").alias("a"), F.col("shingles").alias("x"))
        y = sets.select(F.col("id").alias("b"), F.col("shingles").alias("y"))
        both = pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y")
        return both.mapInArrow(_confirm(percent), "a long, b long").distinct()

    links = durable(confirmed(candidates.filter("first = 1").select("a", "b")))
    labels = components(links)

    def between(pairs: DataFrame) -> DataFrame:
        """The pairs whose ends are not yet in one component, with the labels of both."""
        la = labels.select(F.col("node").alias("a"), F.col("label").alias("la"))
        lb = labels.select(F.col("node").alias("b"), F.col("label").alias("lb"))
        ends = pairs.join(la, "a", "left").join(lb, "b", "left")
        return ends.select("a", "b", F.coalesce("la", "a").alias("la"), F.coalesce("lb", "b").alias("lb")).filter("la <> lb")

    # Large regions with the same largest component are one group, in which each node stands once.
    own_label = F.coalesce("label", "node")
    labelled = durable(large.join(labels, "node", "left").select("key", "node", own_label.alias("label")))
    main = (
        labelled.groupBy("key", "label").agg(F.count("*").alias("size"))
        .groupBy("key").agg(F.max_by("label", F.struct("size", "label")).alias("main"))
    )
    group = durable(labelled.join(main, "key").select("main", "node", "label").distinct())
    sizes = (
        group.groupBy("main")
        .agg(F.count("*").alias("many"), F.sum((F.col("label") != F.col("main")).cast("int")).alias("strays"))
        .filter("strays > 0")
    )
    chunks, blocks = (F.ceil(F.col(c) / BLOCK).cast("int") for c in ("strays", "many"))
    whole = sets.select(F.col("id").alias("node"), (F.length("shingles") / 8).cast("long").alias("n"), "shingles")
    open_rows = durable(group.join(sizes, "main").join(whole, "node"))
    columns = ("node", "n", "shingles", "label")

    def dealt(count):
        """One of ``count`` parts, by the node's hash."""
        return F.pmod(F.xxhash64("node"), count).cast("int")

    def every(count):
        return F.explode(F.sequence(F.lit(0), count - 1))

    strays = open_rows.filter("label <> main").select(
        "main", dealt(chunks).alias("chunk"), every(blocks).alias("block"), F.lit(1).alias("stray"), *columns
    )
    others = open_rows.select(
        "main", every(chunks).alias("chunk"), dealt(blocks).alias("block"), F.lit(0).alias("stray"), *columns
    )
    in_blocks = strays.unionByName(others).groupBy("main", "chunk", "block")
    met = in_blocks.applyInPandas(_blocks(percent), "a long, b long")
    more = durable(confirmed(between(candidates.filter("first = 0").select("a", "b")).select("a", "b")).union(met))
    links = links.union(more)
    named = (F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"))
    grouped = members.join(labels, "node", "left").select(*named, own_label.alias("component_id"))
    if more.limit(1).count():  # they join whole components, so only labels are compared from here on
        joined = components(between(more).select(F.col("la").alias("a"), F.col("lb").alias("b")))
        grouped = grouped.join(joined, F.col("component_id") == F.col("node"), "left").select(
            "doc_id", "n_shingles", F.coalesce("label", "component_id").alias("component_id")
        )
    alone = signed.filter("n = 0 OR id IS NULL").select(*named, F.col("id").alias("component_id"))
    result = grouped.union(alone).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    return result, links


def _sets(width: int):
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shingles = [shingle_set(text.as_py(), width).tobytes() for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(shingles, pa.binary())], ["id", "shingles"])

    return sets


def keep_one_of_each(
    docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows of ``docs`` with the smallest id of their group, with their columns. Rows that share an id stay together."""
    groups, _ = near_groups(docs, width, percent, id_col, text_col)
    return without_ids(docs, groups.filter("NOT kept").select("doc_id"), id_col)

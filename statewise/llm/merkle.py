"""Merkle manifest of a dataset: hash trees in van Emde Boas layout, stored as blocks of aligned subtrees."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

#: Children of a node are 2 ** FAN_BITS; a block is a subtree of BLOCK_HEIGHT steps, 512 leaves.
FAN_BITS = 3
BLOCK_HEIGHT = 3
#: Bytes of a digest.
DIGEST = 32
#: Offsets up to so many rows are broadcast (some 4 MB); above it the join shuffles.
BROADCAST_OFFSETS = 100_000


def sha256(data: bytes) -> bytes:
    return hashlib.sha256(data).digest()


def tree_size(levels: int) -> int:
    """Nodes of a full tree of so many levels."""
    return ((1 << FAN_BITS * levels) - 1) // ((1 << FAN_BITS) - 1)


@lru_cache(maxsize=64)
def addresses(levels: int) -> tuple[np.ndarray, ...]:
    """For each level from the root down, the place of each of its nodes in van Emde Boas order.

    The upper half of the levels stands first, then each subtree of the lower half from left to right, all laid out
    by the same rule, so a path from leaf to root crosses few stretches of memory whatever the size of a cache line.
    """
    if levels == 1:
        return (np.zeros(1, np.int64),)
    upper = levels // 2
    top, bottom = addresses(upper), addresses(levels - upper)
    starts = tree_size(upper) + tree_size(levels - upper) * np.arange(1 << FAN_BITS * upper, dtype=np.int64)
    return (*top, *((starts[:, None] + at[None, :]).ravel() for at in bottom))


def height_of(leaves: int) -> int:
    """Steps from a leaf to the root of a tree with so many leaves."""
    height = 0
    while 1 << FAN_BITS * height < leaves:
        height += 1
    return height


def build_block(leaves: list[bytes], height: int) -> bytes:
    """The nodes over ``leaves``, whose root is ``height`` steps up, in van Emde Boas order; places without a node are
    zero. A node is the hash of its children's digests as hex text."""
    at = addresses(height + 1)
    out = np.zeros((tree_size(height + 1), DIGEST), np.uint8)
    level = leaves
    for depth in range(height, -1, -1):
        out[at[depth][: len(level)]] = np.frombuffer(b"".join(level), np.uint8).reshape(-1, DIGEST)
        step = 1 << FAN_BITS
        level = [sha256(b"".join(level[i : i + step]).hex().encode()) for i in range(0, len(level), step)]
    return out.tobytes()


def counts_of(leaves: int, height: int) -> list[int]:
    """Number of nodes of each level from the root down."""
    out = [leaves]
    for _ in range(height):
        out.append(-(-out[-1] >> FAN_BITS))
    return out[::-1]


def sibling_runs(nodes: bytes, leaves: int, height: int) -> list[list[str]]:
    """For each level below the block's root, from the leaves up, each node's run (its parent's children) as hex."""
    at, counts = addresses(height + 1), counts_of(leaves, height)
    cells = np.frombuffer(nodes, np.uint8).reshape(-1, DIGEST)
    out = []
    for depth in range(height, 0, -1):
        text = cells[at[depth][: counts[depth]]].tobytes().hex()
        step = (2 * DIGEST) << FAN_BITS
        out.append([text[i : i + step] for i in range(0, len(text), step)])
    return out


def fold(digest: str, above: list[tuple[int, str]]) -> str:
    """The root that a node's hex digest leads to: at each step it replaces its place in the run above it."""
    width = 2 * DIGEST
    for place, run in above:
        digest = hashlib.sha256(f"{run[: place * width]}{digest}{run[(place + 1) * width :]}".encode()).hexdigest()
    return digest


def proof_text(above: list[tuple[int, str]]) -> str:
    """The siblings of a path, level by level from the leaf up, left to right."""
    width = 2 * DIGEST
    return "".join(run[: place * width] + run[(place + 1) * width :] for place, run in above)


def field(value: Column) -> Column:
    """A value as its length in UTF-8 bytes, a colon and itself; "-" for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*values: Column) -> Column:
    return F.unhex(F.sha2(F.concat(*map(field, values)), 256))


def _positions(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``rows`` stored in the order of ``group`` and ``order``, with index (0.. in the group) and n (rows of the group).

    Rows are dealt by ranges and sorted within them; each range's count per group gives the offset of the next. No
    task holds more than a range, and equal rows are told apart by a serial number, so no group is too hot to split.
    """
    spread = rows.withColumn("__serial", F.monotonically_increasing_id())
    keys = [group, *order, "__serial"]
    ranged = spread.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("__serial")
    placed = stored(ranged.withColumn("__at", F.monotonically_increasing_id())).withColumn("__part", F.shiftright("__at", 33))
    parts = placed.groupBy(group, "__part").agg(F.count("*").alias("__rows"), F.min("__at").alias("__first"))
    # One row for each group of each range: as many as ranges and groups together.
    before = Window.partitionBy(group).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select(
        group,
        "__part",
        (F.coalesce(F.sum("__rows").over(before), F.lit(0)) - F.col("__first")).alias("__shift"),
        F.sum("__rows").over(Window.partitionBy(group)).alias("n"),
    )
    offsets = stored(offsets)
    offsets = F.broadcast(offsets) if offsets.count() <= BROADCAST_OFFSETS else offsets
    return placed.join(offsets, [group, "__part"]).withColumn("index", F.col("__at") + F.col("__shift")).drop("__at", "__part", "__shift")


BLOCKS = (
    "group string, tier int, block long, n long, leaves int, height int, nodes binary, root binary, "
    "ids binary, without_id binary, tampered binary, changed binary"
)


def _tier_blocks(tier: int):
    """One row for each aligned subtree of a tier. Ids and tampered digests of documents ride along in leaf order."""

    def build(rows: pa.Table) -> pa.Table:
        order = np.argsort(rows.column("index").to_numpy(), kind="stable")
        rows = rows.take(pa.array(order))
        n, number = rows.column("n")[0].as_py(), rows.column("block")[0].as_py()
        leaves = rows.column("digest").to_pylist()
        height = min(BLOCK_HEIGHT, height_of(n))
        nodes = build_block(leaves, height)
        ids = [None] * 4
        if tier == 0 and "doc_id" in rows.column_names:
            doc_id, other = rows.column("doc_id"), rows.column("tampered").to_pylist()
            ids = [
                doc_id.fill_null(0).to_numpy().astype("<i8").tobytes(),
                np.packbits(doc_id.is_null().to_numpy()).tobytes(),
                b"".join(x or b"" for x in other),
                np.packbits(np.array([x is not None for x in other])).tobytes(),
            ]
        values = [rows.column("group")[0].as_py(), tier, number, n, len(leaves), height, nodes, nodes[:DIGEST], *ids]
        types = [pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), *[pa.binary()] * 6]
        names = [c.split()[0] for c in BLOCKS.split(", ")]
        return pa.table([pa.array([v], t) for v, t in zip(values, types, strict=True)], names=names)

    return build


def _forest(leaves: DataFrame) -> list[DataFrame]:
    """Blocks of the trees over ``leaves`` (group, index, n, digest), one table for each tier: the block roots of a
    tier are the leaves of the next, until one block is left of every group."""
    bits = FAN_BITS * BLOCK_HEIGHT
    tiers: list[DataFrame] = []
    most = leaves.agg(F.max("n")).first()[0] or 0
    while True:
        rows = leaves.withColumn("block", F.shiftright("index", bits))
        tiers.append(stored(rows.groupBy("group", "block").applyInArrow(_tier_blocks(len(tiers)), BLOCKS)))
        if most <= 1 << bits:
            return tiers
        most = -(-most >> bits)
        leaves = (
            tiers[-1]
            .filter(F.col("n") > 1 << bits)
            .select("group", F.col("block").alias("index"), F.expr(f"shiftright(n + {(1 << bits) - 1}, {bits})").alias("n"), F.col("root").alias("digest"))
        )


def _roots(tiers: list[DataFrame]) -> DataFrame:
    """group and the root of its tree: that of its only block of the last tier that it reaches."""
    out = None
    for tier in tiers:
        top = tier.filter(F.col("n") <= 1 << FAN_BITS * BLOCK_HEIGHT).select("group", "root")
        out = top if out is None else out.unionByName(top)
    return out


#: Steps from a block's root to the dataset's root: its place in each run, and the run.
ABOVE = "array<struct<place: int, run: string>>"


def _above_children(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each leaf of each block the steps above it: those within the block, then those above the block."""
    type_ = pa.list_(pa.struct([("place", pa.int32()), ("run", pa.string())]))
    for batch in batches:
        groups, numbers, paths, roots = [], [], [], []
        for group, block, leaves, height, nodes, above, subroot in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            runs = sibling_runs(nodes, leaves, height)
            over = [(s["place"], s["run"]) for s in above]
            for i in range(leaves):
                groups.append(group)
                numbers.append((block << FAN_BITS * BLOCK_HEIGHT) + i)
                steps = _steps(i, runs) + over
                paths.append([{"place": p, "run": r} for p, r in steps])
                roots.append(subroot)
        yield pa.RecordBatch.from_arrays(
            [pa.array(groups, pa.string()), pa.array(numbers, pa.int64()), pa.array(paths, type_), pa.array(roots, pa.string())],
            ["group", "block", "above", "subroot"],
        )


def _steps(i: int, runs: list[list[str]]) -> list[tuple[int, str]]:
    out = []
    for run in runs:
        out.append((i & (1 << FAN_BITS) - 1, run[i >> FAN_BITS]))
        i >>= FAN_BITS
    return out


def _children(blocks: DataFrame, known: DataFrame) -> DataFrame:
    """The steps above each leaf of ``blocks``, from those above each block; block is then the leaf's index."""
    rows = blocks.join(known, ["group", "block"]).select("group", "block", "leaves", "height", "nodes", "above", "subroot")
    return stored(rows.mapInArrow(_above_children, f"group string, block long, above {ABOVE}, subroot string"))


def _descend(tiers: list[DataFrame], start: DataFrame | None) -> DataFrame:
    """The steps above each block of tier 0, from those above each group's tree (``start``; None: there are none) down
    through the tiers."""
    known = None
    for tier in reversed(tiers):
        # The only block of a group in its last tier; all other blocks are leaves of the tier above.
        tops = tier.filter(F.col("n") <= 1 << FAN_BITS * BLOCK_HEIGHT).select("group", "block")
        if start is None:
            tops = tops.withColumns({"above": F.array().cast(ABOVE), "subroot": F.lit(None).cast("string")})
        else:
            tops = tops.join(start, "group")
        known = (tops if known is None else tops.unionByName(known)).select("group", "block", "above", "subroot")
        if tier is not tiers[0]:
            known = _children(tier, known)
    return known


PROOFS = "doc_id long, leaf string, subroot string, root string, proof string, proof_sha256 string, folded_root string, verified boolean"


def _prove(whole: bool):
    def prove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for leaves, height, nodes, ids, without, tampered, changed, above, subroot, root in zip(
                *(c.to_pylist() for c in batch.columns), strict=True
            ):
                runs = sibling_runs(nodes, leaves, height)
                over = [(s["place"], s["run"]) for s in above]
                at = addresses(height + 1)[height][:leaves]
                own = np.frombuffer(nodes, np.uint8).reshape(-1, DIGEST)[at]
                ids = np.frombuffer(ids, "<i8").tolist()
                without = np.unpackbits(np.frombuffer(without, np.uint8), count=leaves)
                changed = np.unpackbits(np.frombuffer(changed, np.uint8), count=leaves)
                used = 0
                for i in range(leaves):
                    leaf = now = own[i].tobytes().hex()
                    if changed[i]:
                        now = tampered[used : used + DIGEST].hex()
                        used += DIGEST
                    steps = _steps(i, runs) + over
                    proof = proof_text(steps)
                    folded = fold(now, steps)
                    out.append(
                        (
                            None if without[i] else ids[i],
                            leaf,
                            subroot,
                            root,
                            proof if whole else None,
                            hashlib.sha256(proof.encode()).hexdigest(),
                            folded,
                            folded == root,
                        )
                    )
            types = [pa.int64(), *[pa.string()] * 6, pa.bool_()]
            columns = list(zip(*out, strict=True)) if out else [[]] * 8
            names = [c.split()[0] for c in PROOFS.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    return prove


@dataclass
class Manifest:
    """Blocks of a dataset's trees by tier: one tree per group of documents, one over the groups' roots."""

    groups: list[DataFrame]
    top: list[DataFrame]
    subroots: DataFrame

    def root(self) -> str | None:
        """The dataset's root in hex; null for an empty dataset."""
        row = _roots(self.top).first()
        return None if row is None else bytes(row.root).hex()

    def _above(self) -> DataFrame:
        """For every block of tier 0 of every group: the steps above its root, and its group's root."""
        over = _children(self.top[0], _descend(self.top, None)).drop("group", "subroot")
        named = self.subroots.select(F.col("index").alias("block"), F.col("name").alias("group"), F.lower(F.hex("digest")).alias("subroot"))
        return _descend(self.groups, over.join(named, "block").drop("block"))

    def proofs(self, whole: bool = False) -> DataFrame:
        """Each document's proof and the root that its tampered (else its own) leaf folds to."""
        root = self.root()
        blocks = self.groups[0].join(self._above(), ["group", "block"])
        return blocks.select(
            "leaves", "height", "nodes", "ids", "without_id", "tampered", "changed", "above", "subroot", F.lit(root).alias("root")
        ).mapInArrow(_prove(whole), PROOFS)


#: The documents' columns that make a leaf, in order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def manifest(docs: DataFrame, fields: tuple[str, ...] = FIELDS, group_col: str = "lang", tampered: Column | None = None) -> Manifest:
    """The Merkle manifest of ``docs``: a leaf for each row, a tree for each value of ``group_col``, a tree over theirs.

    A leaf hashes ``fields``, the first of which is the id; ``tampered`` is the text (last field) as found later, null
    where nothing changed. Leaves of a group ascend by id. Trees have eight children a node and are stored as aligned
    subtrees of 512 leaves, one row each, whose nodes stand in van Emde Boas order; building a block and finding the
    siblings of a leaf both go by ``addresses``. The roots of blocks are the leaves of the next tier.

    Only digests are shuffled: once by range, which gives each leaf its index, and once to its block. A block is all
    that a task holds, so a group may have any share of the rows; steps above a block are joined to it once, not to
    its documents.

    Defined results: nulls count as "-" in a leaf; a null group is a group of its own and stands first; null ids stand
    first in their group; rows with one id stand in the order of their leaves, so equal rows are interchangeable; an
    empty table has no root and no proofs; other columns are ignored; a text is hashed whole, whatever its length.
    """
    values = [F.col(c) for c in fields]
    changed = F.lit(None).cast("binary") if tampered is None else F.when(tampered.isNotNull(), leaf_digest(*values[:-1], tampered))
    rows = docs.select(
        # Null first, then by UTF-8 bytes.
        F.coalesce(F.concat(F.lit("="), F.col(group_col).cast("string")), F.lit("")).alias("group"),
        values[0].cast("long").alias("doc_id"),
        leaf_digest(*values).alias("digest"),
        changed.alias("tampered"),
    )
    groups = _forest(_positions(rows, "group", ["doc_id", "digest"]))
    names = _roots(groups).select(F.lit("").alias("group"), F.col("group").alias("name"), F.col("root").alias("digest"))
    subroots = stored(_positions(names, "group", ["name"]))
    return Manifest(groups, _forest(subroots), subroots)


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def tamper(doc_id: Column, text: Column) -> Column:
    """``text`` with A-Z in lower case where 3 divides the id's crc32, else null; null texts and ids stay as they are."""
    hit = F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 3 == 0
    return F.when(hit, F.translate(text, UPPER, LOWER))

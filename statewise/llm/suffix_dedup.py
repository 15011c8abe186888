"""Removal of long byte strings that begin in more than one place, by suffix arrays of anchored shards."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import durable, stored
from .exchange import REQUEST, answers, buckets_for, grow, reply_of, request_batch, requests, runs, shrunk, with_block
from .fingerprints import mix64
from .induced_sorting import repeated_starts

FACTOR = 0x9E3779B97F4A7C15
#: Bytes of contexts in a shard.
SHARD_BYTES = 1_000_000
#: An anchor with more different contexts than this is split by further anchors, at most so many times; contexts
#: that still share all of them are then cut into single places.
HOT_CONTEXTS, MOST_ANCHORS = 8192, 4


def gram_for(width: int) -> int:
    """Bytes of an anchor: a power of two of at most a third of ``width``."""
    return 1 << max(0, (width // 3).bit_length() - 1)


def gram_hashes(data: np.ndarray, gram: int, seed: int) -> np.ndarray:
    """A 64-bit hash of the ``gram`` bytes (a power of two) from each place on; polynomials of doubled length."""
    h = data.astype(np.uint64) + np.uint64(1)
    size, factor = 1, FACTOR
    while size < gram:
        h = h[:-size] * np.uint64(factor) + h[size:]
        size, factor = 2 * size, factor * factor % 2**64
    return mix64(h ^ np.uint64((seed * FACTOR) % 2**64))


def sliding_least(x: np.ndarray, w: int) -> np.ndarray:
    """The least of each ``w`` neighbours, by running minima from both ends of blocks of ``w``."""
    n = len(x) - w + 1
    blocks = np.concatenate([x, np.full(-len(x) % w, np.iinfo(x.dtype).max, x.dtype)]).reshape(-1, w)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[w - 1 : w - 1 + n])


NONE = np.empty(0, np.int64)


def contexts(data: bytes, width: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Key, first place and number of places of each context of a text, which share out the places where ``width``
    bytes begin. A place's key is the least hash of the anchors within its bytes, so places of equal bytes have one
    key. A context is a run of places of one key whose last anchor with that hash is the same, so equal bytes never
    begin twice in one context, also not in periodic text, and a context has no more places than hold one anchor."""
    if len(data) < width:
        return np.empty(0, np.uint64), NONE, NONE
    gram = gram_for(width)
    hashes = gram_hashes(np.frombuffer(data, np.uint8), gram, seed)
    least = sliding_least(hashes, width - gram + 1)
    new = np.r_[0, np.flatnonzero((least[1:] != least[:-1]) | (hashes[width - gram + 1 :] == least[1:])) + 1]
    return least[new], new, np.diff(np.r_[new, len(least)])


def digest(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=16).digest()


def _utf8(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def _ask(width: int, buckets: int):
    """Each block's distinct keys with the number of its contexts that have them. One text is held at a time."""

    def rows(block: int, keys: list[np.ndarray]) -> pa.RecordBatch:
        distinct, counts = np.unique(np.concatenate(keys), return_counts=True)
        return request_batch(requests(block, 1, distinct, counts, 8, buckets))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held = None, []
        for batch in batches:
            ids, texts = batch.column(0).to_numpy(), batch.column(1)
            for lo, hi in runs(ids):
                if block is not None and ids[lo] != block:
                    yield rows(block, held)
                    held = []
                block = int(ids[lo])
                held += [contexts(_utf8(texts[i].as_py()), width)[0] for i in range(lo, hi)]
        if block is not None:
            yield rows(block, held)

    return work


MARKED = "block long, row int, doc_id long, n_bytes long, sha string, packed binary, keys binary, starts binary, sizes binary, digests binary"
MARKED_TYPES = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.string(), *[pa.binary()] * 5]


def names_of(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def _batch(names: list[str], types: list[pa.DataType], rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[]] * len(types)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)


def _table(schema: str, types: list[pa.DataType], rows: list[tuple]) -> pa.Table:
    return pa.Table.from_batches([_batch(names_of(schema), types, rows)])


def _mark(width: int):
    def mark(docs: pa.Table, replies: pa.Table) -> pa.Table:
        """Documents of a block: those without a key that another context has are done, the others keep their text and
        such contexts."""
        blocks, ids, packed = (docs.column(c).to_pylist() for c in ("block", "doc_id", "packed"))
        found = [contexts(grow(p), width) for p in packed]
        distinct = np.unique(np.concatenate([k for k, _, _ in found])) if found else np.empty(0, np.uint64)
        shared = reply_of(replies, 1, len(distinct)) > 1
        out = []
        for row, (block, doc_id, p, (keys, starts, sizes)) in enumerate(zip(blocks, ids, packed, found, strict=True)):
            data = grow(p)
            some = shared[np.searchsorted(distinct, keys)]
            if not some.any():
                out.append((block, row, doc_id, len(data), hashlib.sha256(data).hexdigest(), *[None] * 5))
                continue
            keys, starts, sizes = keys[some], starts[some], sizes[some]
            digests = b"".join(digest(data[a : a + n + width - 1]) for a, n in zip(starts.tolist(), sizes.tolist(), strict=True))
            numbers = (keys.astype("<u8").tobytes(), starts.astype("<i8").tobytes(), sizes.astype("<i4").tobytes())
            out.append((block, row, doc_id, len(data), None, p, *numbers, digests))
        return _table(MARKED, MARKED_TYPES, out)

    return mark


CONTEXTS = "block long, row int, start long, n int, key long, digest binary"


def _list_contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = names_of(CONTEXTS)
    for batch in batches:
        blocks, rows, keys, starts, sizes, digests = (c.to_pylist() for c in batch.columns)
        each = [len(s) // 8 for s in starts]
        packed = b"".join(digests)
        columns = [
            np.repeat(np.array(blocks, np.int64), each),
            np.repeat(np.array(rows, np.int32), each),
            np.frombuffer(b"".join(starts), "<i8"),
            np.frombuffer(b"".join(sizes), "<i4"),
            np.frombuffer(b"".join(keys), "<i8"),
        ]
        sixteen = pa.FixedSizeBinaryArray.from_buffers(pa.binary(16), len(packed) // 16, [None, pa.py_buffer(packed)])
        yield pa.RecordBatch.from_arrays([*map(pa.array, columns), sixteen.cast(pa.binary())], names)


#: A class is all contexts of one key and equal bytes.
CLASSES = "key long, digest binary, weight long, n int, data binary"
CLASS_TYPES = [pa.int64(), pa.binary(), pa.int64(), pa.int32(), pa.binary()]


def _fetch(width: int):
    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The bytes of classes, each from the document that stands for it."""
        rows, size = [], 0
        for batch in batches:
            for packed, wanted in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                data = grow(packed)
                for w in wanted:
                    rows.append((w["key"], w["digest"], w["weight"], w["n"], data[w["start"] : w["start"] + w["n"] + width - 1]))
                    size += len(rows[-1][-1])
                if size > SHARD_BYTES:
                    yield _batch(names_of(CLASSES), CLASS_TYPES, rows)
                    rows, size = [], 0
        yield _batch(names_of(CLASSES), CLASS_TYPES, rows)

    return fetch


PARTS = "key long, digest binary, whole_key long, whole_digest binary, first int, weight long, n int, data binary"
PART_TYPES = [pa.int64(), pa.binary(), pa.int64(), pa.binary(), pa.int32(), pa.int64(), pa.int32(), pa.binary()]


def _split(width: int, seed: int, single: bool):
    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Contexts cut by a further anchor, or into single places; a part knows the whole that it is of."""
        for batch in batches:
            out = []
            for old, whole_key, whole_digest, first, weight, n, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if single:
                    cuts = [(i, 1) for i in range(n)]
                    keys = [int.from_bytes(digest(data[i : i + width])[:8], "little", signed=True) for i in range(n)]
                else:
                    found, starts, sizes = contexts(data[: n + width - 1], width, seed)
                    cuts = list(zip(starts.tolist(), sizes.tolist(), strict=True))
                    keys = mix64(found ^ mix64(np.array([old], np.int64).view(np.uint64))).view(np.int64).tolist()
                for key, (at, size) in zip(keys, cuts, strict=True):
                    part = data[at : at + size + width - 1]
                    out.append((key, digest(part), whole_key, whole_digest, first + at, weight, size, part))
            yield _batch(names_of(PARTS), PART_TYPES, out)

    return split


FLAGS = "key long, digest binary, flags binary"
FLAG_TYPES = [pa.int64(), pa.binary(), pa.binary()]


def _sort_shard(width: int):
    def sort_shard(rows: pa.Table) -> pa.Table:
        """For each class of a shard, which of its places begin bytes that other places begin too."""
        keys, digests, weights, sizes, data = (rows.column(c).to_pylist() for c in ("key", "digest", "weight", "n", "data"))
        found = repeated_starts(data, sizes, weights, width)
        some = [(k, d, np.packbits(f).tobytes()) for k, d, f in zip(keys, digests, found, strict=True) if f.any()]
        return _table(FLAGS, FLAG_TYPES, some)

    return sort_shard


def _sorted_shards(classes: DataFrame, width: int) -> DataFrame:
    """Flags of classes, by a suffix array for each shard; classes of one key share a shard."""
    total = classes.agg(F.sum(F.length("data"))).first()[0] or 0
    shards = -(-total // SHARD_BYTES) or 1
    return classes.groupBy(F.pmod(F.xxhash64("key"), F.lit(shards)).alias("shard")).applyInArrow(_sort_shard(width), FLAGS)


PLACES = "key long, digest binary, places binary"


def _join_flags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parts' flags as places of their wholes."""
    for batch in batches:
        out = []
        for key, d, first, n, flags in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            places = np.flatnonzero(np.unpackbits(np.frombuffer(flags, np.uint8), count=n)) + first
            out.append((key, d, places.astype("<i4").tobytes()))
        yield _batch(names_of(PLACES), FLAG_TYPES, out)


def _flags_of_hot(hot: DataFrame, width: int) -> DataFrame:
    """Flags of classes whose keys have too many of them for a shard: further anchors split their places."""
    parts = hot.select("key", F.col("key").alias("whole_key"), F.col("digest").alias("whole_digest"), F.lit(0).alias("first"), "weight", "n", "data")
    done = None
    for seed in range(1, MOST_ANCHORS + 2):
        last = seed > MOST_ANCHORS
        rows = stored(parts.mapInArrow(_split(width, seed, last), PARTS))
        classes = rows.groupBy("key", "digest").agg(F.sum("weight").alias("weight"), F.first("n").alias("n"), F.first("data").alias("data"))
        classes, still = _by_heat(stored(classes), last)
        flags = _sorted_shards(classes, width)
        found = rows.join(flags, ["key", "digest"]).select("whole_key", "whole_digest", "first", "n", "flags")
        found = found.mapInArrow(_join_flags, PLACES)
        done = found if done is None else done.unionByName(found)
        if still is None:
            break
        parts = rows.join(still.select("key").distinct(), "key").select("key", "whole_key", "whole_digest", "first", "weight", "n", "data")
    return done


def _by_heat(classes: DataFrame, last: bool) -> tuple[DataFrame, DataFrame | None]:
    """Classes whose key has few others, and the rest (None: there are none)."""
    if last:
        return classes, None
    hot = durable(classes.groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") > HOT_CONTEXTS).select("key"))
    if hot.limit(1).count() == 0:
        return classes, None
    # One key for thousands of classes. The join is dealt anew, so that a hot key's rows can be split.
    return classes.join(hot, "key", "left_anti"), stored(classes.join(hot, "key"))


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary, spans array<struct<start: long, length: long>>"
RESULT_NAMES = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept", "spans"]
RESULT_TYPES = [
    *[pa.int64()] * 4, pa.string(), pa.binary(), pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())])),
]


def _cut_out(width: int, whole: bool):
    def cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            found = batch.column(4)
            bounds, runs_ = found.offsets.to_numpy(), found.values
            all_starts, all_sizes = runs_.field("start").to_numpy(), runs_.field("n").to_numpy()
            all_flags, all_places = runs_.field("flags").to_pylist(), runs_.field("places").to_pylist()
            some = np.array([f is not None or p is not None for f, p in zip(all_flags, all_places, strict=True)], bool)
            for i, (doc_id, n, sha, packed) in enumerate(zip(*(c.to_pylist() for c in batch.columns[:4]), strict=True)):
                if packed is None and not whole:
                    out.append((doc_id, n, 0, 0, sha, None, None))
                    continue
                data = np.frombuffer(grow(packed), np.uint8)
                # Contexts that repeat at all places, then those with flags or with several parts' places; a place
                # stands in one context only.
                lo, hi = bounds[i], bounds[i + 1]
                every = lo + np.flatnonzero(~some[lo:hi])
                change = np.bincount(all_starts[every], minlength=n + 1) - np.bincount(all_starts[every] + all_sizes[every], minlength=n + 1)
                begins = np.cumsum(change)[:n] > 0
                for j in (lo + np.flatnonzero(some[lo:hi])).tolist():
                    start, size = int(all_starts[j]), int(all_sizes[j])
                    if all_flags[j] is not None:
                        begins[start : start + size] = np.unpackbits(np.frombuffer(all_flags[j], np.uint8), count=size)
                    else:
                        begins[start + np.frombuffer(all_places[j], "<i4")] = True
                # A byte goes if one of the ``width`` places up to it begins a repeated string.
                upto = np.cumsum(begins)
                gone = upto[:n] > np.r_[np.zeros(min(n, width), upto.dtype), upto[: max(0, n - width)]]
                kept = data[~gone].tobytes()
                spans = [(a, b - a) for a, b in runs(gone) if gone[a]]
                more = (kept, [{"start": a, "length": b} for a, b in spans]) if whole else (None, None)
                out.append((doc_id, n, int(gone.sum()), len(spans), hashlib.sha256(kept).hexdigest(), *more))
            yield _batch(RESULT_NAMES, RESULT_TYPES, out)

    return cut_out


def remove_repeated_bytes(docs: DataFrame, width: int = 200, id_col: str = "doc_id", text_col: str = "text", whole: bool = False) -> DataFrame:
    """What is left of every row of ``docs`` without the bytes of strings of ``width`` bytes that begin in more than
    one place, in whatever rows.

    Every place has a key, the least hash of the anchors within its ``width`` bytes, so equal strings have equal keys.
    Runs of places of one key are contexts. Blocks of rows learn from hash buckets (exchange.py) which keys several
    contexts have; all others are done. Equal contexts of one key become a class with a weight. A key of one class
    repeats at all its places. The rest go to shards by key; a shard sorts its suffixes by induced sorting
    (induced_sorting.py), and neighbours with a permuted common prefix of ``width`` bytes repeat. Hash collisions only
    bring more contexts into a shard, whose bytes decide.

    Texts move compressed, first with the counts of their block and then to fetch the bytes of classes and to be cut.
    A task holds a block's compressed texts, one text, or a shard of about SHARD_BYTES. A key with more than
    HOT_CONTEXTS classes is split by further anchors, at last into single places; copies are reduced to a class with
    a weight before anything is sorted, and the joins that bring flags back can split a class of many copies.

    Defined results: a null text has no bytes; null ids are kept, and rows count by themselves whatever their ids,
    so equal rows remove each other; an empty table gives no rows; other columns are ignored.

    Returns doc_id, n_bytes, n_removed, n_spans, kept_sha256, and if ``whole`` also the kept bytes and the spans.
    """
    rows = with_block(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")))
    asked = rows.select("block", "text").mapInArrow(_ask(width, buckets_for(docs.count())), REQUEST)
    marked = stored(
        shrunk(rows.select("block", "doc_id", "text"))
        .groupBy("block")
        .cogroup(answers(asked, {1: 8}).filter("block >= 0").groupBy("block"))
        .applyInArrow(_mark(width) if not whole else _mark_all(width), MARKED)
    )
    some = marked.filter("keys IS NOT NULL")
    found = some.select("block", "row", "keys", "starts", "sizes", "digests").mapInArrow(_list_contexts, CONTEXTS)
    classes = durable(
        found.groupBy("key", "digest").agg(
            F.count("*").alias("weight"), F.min(F.struct("block", "row", "start", "n")).alias("at")
        )
    )
    many = classes.groupBy("key").agg((F.count("*") > 1).alias("many"))
    classes = stored(classes.join(many, "key"))
    wanted = (
        classes.filter("many")
        .select("at.block", "at.row", F.struct("key", "digest", "weight", "at.n", "at.start").alias("class"))
        .groupBy("block", "row")
        .agg(F.collect_list("class").alias("wanted"))
    )
    fetched = stored(some.select("block", "row", "packed").join(wanted, ["block", "row"]).select("packed", "wanted").mapInArrow(_fetch(width), CLASSES))
    usual, hot = _by_heat(fetched, False)
    flags = _sorted_shards(usual, width).withColumn("places", F.lit(None).cast("binary"))
    alone = classes.filter("NOT many").select("key", "digest", *(F.lit(None).cast("binary").alias(c) for c in ("flags", "places")))
    flags = flags.unionByName(alone)
    if hot is not None:
        flags = flags.unionByName(_flags_of_hot(hot, width).withColumn("flags", F.lit(None).cast("binary")), allowMissingColumns=True)
    spans = (
        found.join(stored(flags), ["key", "digest"])
        .groupBy("block", "row")
        .agg(F.collect_list(F.struct("start", "n", "flags", "places")).alias("found"))
    )
    out = (
        marked.select("block", "row", "doc_id", "n_bytes", "sha", "packed")
        .join(spans, ["block", "row"], "left")
        .select("doc_id", "n_bytes", "sha", "packed", "found")
        .mapInArrow(_cut_out(width, whole), RESULT)
    )
    return out if whole else out.drop("kept", "spans")


def _mark_all(width: int):
    """As ``_mark``, but every document keeps its text."""
    mark = _mark(width)

    def mark_all(docs: pa.Table, replies: pa.Table) -> pa.Table:
        out = mark(docs, replies)
        return out.set_column(out.schema.get_field_index("packed"), "packed", docs.column("packed").cast(pa.binary()))

    return mark_all

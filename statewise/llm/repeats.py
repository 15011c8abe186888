"""Substring dedup by compaction of a de Bruijn graph of word k-mers, verified at source coordinates."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import durable, hash_words
from .exchange import (
    REQUEST,
    answers,
    buckets_for,
    by_block,
    cut,
    grow,
    reply_of,
    request_batch,
    requests,
    runs,
    shrunk,
    with_block,
)
from .fingerprints import mix64

#: Bytes of an edge's key on the wire; whole spans are told apart by digests of their words.
KEY = 6
#: Bits of the answer about an edge: a path begins with it, a path ends with it.
BEGINS, ENDS = 1, 2


#: Odd factor of the hash of a run of words.
FACTOR = np.uint64(0x9E3779B97F4A7C15)


def edges(h: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit hash of the k words (given as hashes) from each position on: the edge from their first k-1 to their last."""
    n = len(h) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = h[:n].copy()
    for i in range(1, k):
        out *= FACTOR
        out += h[i : i + n]
    return mix64(out)


def _block_edges(texts: list[bytes], k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys of the edges of all texts, the text that each belongs to, and the number of edges of each text."""
    words, lengths = [], np.empty(len(texts), np.int64)
    for i, text in enumerate(texts):
        found = text.split()
        words += found
        lengths[i] = len(found)
    e = edges(hash_words(words), k)
    owner = np.repeat(np.arange(len(texts)), lengths)
    # Runs of words that end in the text where they begin.
    inside = owner[: len(e)] == owner[k - 1 : k - 1 + len(e)]
    return cut(e[inside], KEY), owner[: len(e)][inside], np.maximum(lengths - k + 1, 0)


def _ask_repeats(k: int, buckets: int):
    """Each block's distinct edges, with 1 if one of its documents has them and 2 if more do."""

    def work(block: int, texts: list) -> pa.RecordBatch:
        keys, owner, _ = _block_edges([(t or "").encode("utf-8", "surrogatepass") for t in texts], k)
        if not len(keys):
            return request_batch([])
        order = np.argsort(keys)
        keys, owner = keys[order], owner[order]
        first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        several = np.minimum.reduceat(owner, first) != np.maximum.reduceat(owner, first)
        return request_batch(requests(block, 1, keys[first], 1 + several, KEY, buckets))

    return lambda batches: by_block(batches, work)


MARKED = "block long, row int, doc_id long, n_words long, sha string, packed binary, repeated binary"


def _sha(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def _mark(k: int):
    def mark(docs: pa.Table, replies: pa.Table) -> pa.Table:
        """Documents of a block: those without repeated edges are done, the others keep their text and which are repeated."""
        packed = docs.column("packed").to_pylist()
        texts = [grow(p) for p in packed]
        keys, _, each = _block_edges(texts, k)
        distinct, index = np.unique(keys, return_inverse=True)
        repeated = (reply_of(replies, 1, len(distinct)) > 1)[index]
        out, at = [], 0
        blocks, ids = docs.column("block").to_pylist(), docs.column("doc_id").to_pylist()
        for i, n in enumerate(each.tolist()):
            mine = repeated[at : at + n]
            at += n
            words = texts[i].split()
            some = bool(mine.any())
            out.append(
                (
                    blocks[i],
                    i,
                    ids[i],
                    len(words),
                    None if some else _sha(words),
                    packed[i] if some else None,
                    np.packbits(mine).tobytes() if some else None,
                )
            )
        types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.binary()]
        names = ["block", "row", "doc_id", "n_words", "sha", "packed", "repeated"]
        columns = list(zip(*out, strict=True)) if out else [[]] * 7
        return pa.table([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    return mark


def _repeated_runs(packed: bytes, repeated: bytes, k: int):
    """Words and edges of a text, and its runs of repeated edges."""
    words = grow(packed).split()
    e = edges(hash_words(words), k)
    marks = np.unpackbits(np.frombuffer(repeated, np.uint8), count=len(e))
    return words, e, [(lo, hi) for lo, hi in runs(marks) if marks[lo]]


def _tags(keys: np.ndarray) -> np.ndarray:
    """32-bit names of neighbouring edges; 0 stands for none."""
    return (keys >> np.uint64(32)).astype(np.uint32) | np.uint32(1)


def _ask_branches(k: int, buckets: int):
    """Each block's distinct repeated edges, with the one before and after each, or a mark that they differ."""

    def work(block: int, packed: list, repeated: list) -> pa.RecordBatch:
        keys, before, after = [], [], []
        for p, r in zip(packed, repeated, strict=True):
            _, e, spans = _repeated_runs(p, r, k)
            for lo, hi in spans:
                own = e[lo:hi]
                t = _tags(own)
                keys.append(cut(own, KEY))
                before.append(np.r_[np.uint32(0), t[:-1]])
                after.append(np.r_[t[1:], np.uint32(0)])
        if not keys:
            return request_batch([])
        distinct, index = np.unique(np.concatenate(keys), return_inverse=True)
        values = _one_neighbour(np.concatenate(before), np.concatenate(after), index, len(distinct))
        return request_batch(requests(block, 2, distinct, values, KEY, buckets, "<u8"))

    return lambda batches: by_block(batches, work)


def _one_neighbour(before: np.ndarray, after: np.ndarray, index: np.ndarray, n: int) -> np.ndarray:
    """For each key the tags of the only edge before it (high half) and after it (low half); 0 where there is none or more."""
    out = np.zeros(n, np.uint64)
    for tags, shift in ((before, 32), (after, 0)):
        low, high = np.full(n, 2**32 - 1, np.uint32), np.zeros(n, np.uint32)
        np.minimum.at(low, index, tags)
        np.maximum.at(high, index, tags)
        out |= np.where(low == high, high, 0).astype(np.uint64) << np.uint64(shift)
    return out


def _branches(values: np.ndarray, index: np.ndarray, n: int) -> np.ndarray:
    one = _one_neighbour((values >> np.uint64(32)).astype(np.uint32), values.astype(np.uint32), index, n)
    return np.where(one >> np.uint64(32) == 0, BEGINS, 0) + np.where(one.astype(np.uint32) == 0, ENDS, 0)


PATHS = "block long, row int, doc_id long, start int, length int, first long, digest binary"


def _paths(k: int):
    def paths(docs: pa.Table, replies: pa.Table) -> pa.Table:
        """The nonbranching paths that each document runs through, with their source coordinates and words' digest."""
        held = [
            (row, doc_id, *_repeated_runs(p, r, k))
            for row, doc_id, p, r in zip(*(docs.column(c).to_pylist() for c in ("row", "doc_id", "packed", "repeated")), strict=True)
        ]
        keys = [cut(e[lo:hi], KEY) for _, _, _, e, spans in held for lo, hi in spans]
        distinct, index = np.unique(np.concatenate(keys), return_inverse=True) if keys else (np.empty(0, np.uint64), np.empty(0, int))
        flags = reply_of(replies, 2, len(distinct))[index]
        block = docs.column("block")[0].as_py() if docs.num_rows else 0
        out, at = [], 0
        for row, doc_id, words, e, spans in held:
            for lo, hi in spans:
                f = flags[at : at + hi - lo]
                at += hi - lo
                cuts = np.flatnonzero((f[1:] & BEGINS > 0) | (f[:-1] & ENDS > 0)) + 1
                for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), hi - lo], strict=True):
                    span = b" ".join(words[lo + a : lo + b + k - 1])
                    out.append(
                        (block, row, doc_id, lo + a, b - a, int(e[lo + a].astype(np.int64)), hashlib.blake2b(span, digest_size=16).digest())
                    )
        types = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.binary()]
        names = ["block", "row", "doc_id", "start", "length", "first", "digest"]
        columns = list(zip(*out, strict=True)) if out else [[]] * 7
        return pa.table([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    return paths


KEPT = "doc_id long, n_words long, n_removed long, kept_sha256 string"


def _cut_out(k: int):
    def cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "n_words", "n_removed", "kept_sha256"]
        for batch in batches:
            out = []
            for doc_id, n, sha, packed, spans in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if packed is None:
                    out.append((doc_id, n, 0, sha))
                    continue
                words = grow(packed).split()
                keep = np.ones(len(words), bool)
                for s in spans or ():
                    keep[s["start"] : s["start"] + s["length"] + k - 1] = False
                kept = [w for w, x in zip(words, keep, strict=True) if x]
                out.append((doc_id, n, n - len(kept), _sha(kept)))
            types = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
            columns = list(zip(*out, strict=True)) if out else [[]] * len(types)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    return cut_out


def remove_repeats(docs: DataFrame, k: int = 13, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """What is left of every row of ``docs`` without the words of windows that a smaller id has too.

    Every k words of a document are an edge of the de Bruijn graph whose nodes are k-1 words. Blocks of documents learn
    from hash buckets which edges several documents have (exchange.py), then before and after which of them a path
    branches, begins or ends in any document. Between those places all documents run through the same edges, so a
    document's run of repeated edges falls into paths that are whole in each document which touches them. A path is
    one row: (document, start, length) with its first edge and a digest of its words; rows of equal paths meet in a
    Spark join, which finds the smallest id of each. Equal digests verify the spans, so hashes that collide remove
    nothing.

    Only compressed texts, packed edges and paths are shuffled. A path held by many documents is reduced to its least
    id before the join, and the join can split it.

    Defined results: a null or empty text has 0 words and the digest of the empty string; texts of fewer than k words
    keep all; a null id counts as larger than any id; rows that share an id do not remove from each other; an empty
    table gives no rows; other columns are ignored.

    Returns doc_id, n_words, n_removed, kept_sha256.
    """
    rows = with_block(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")))
    buckets = buckets_for(docs.count())
    asked = rows.select("block", "text").mapInArrow(_ask_repeats(k, buckets), REQUEST)
    marked = durable(
        shrunk(rows.select("block", "doc_id", "text"))
        .groupBy("block")
        .cogroup(answers(asked, {1: KEY}).filter("block >= 0").groupBy("block"))
        .applyInArrow(_mark(k), MARKED)
    )
    some = marked.filter("packed IS NOT NULL")
    asked = some.select("block", "packed", "repeated").mapInArrow(_ask_branches(k, buckets), REQUEST)
    paths = durable(
        some.groupBy("block")
        .cogroup(answers(asked, {2: KEY}, "<u8", _branches).filter("block >= 0").groupBy("block"))
        .applyInArrow(_paths(k), PATHS)
    )
    # The join takes one more key than the sum, so it deals both sides anew and can split a path of many documents.
    least = paths.groupBy("first", "digest").agg(F.min("doc_id").alias("least"), F.max("length").alias("length"))
    spans = (
        paths.join(least, ["first", "digest", "length"])
        .filter("least < doc_id OR (doc_id IS NULL AND least IS NOT NULL)")
        .groupBy("block", "row")
        .agg(F.collect_list(F.struct("start", "length")).alias("spans"))
    )
    return (
        marked.join(spans, ["block", "row"], "left")
        .select("doc_id", "n_words", "sha", "packed", "spans")
        .mapInArrow(_cut_out(k), KEPT)
    )

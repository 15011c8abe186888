"""Alignment of two tokenizers over a corpus: shared cuts, links, and inverted pair bitmaps for corpus-wide counts."""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored
from .fingerprints import mix64

#: A block of documents has at most so many rows, and ends after so many characters.
BLOCK_ROWS, BLOCK_CHARS = 4096, 3_000_000
#: Pairs are dealt to buckets by their A id. Pairs are bounded by the vocabularies, so their number need not grow.
BUCKETS = 32
#: Rows that a task merges at once.
MERGED = 64
#: A task remembers so many segments of at most so many characters; what it forgets is encoded again.
REMEMBERED, LONGEST_REMEMBERED = 300_000, 64

#: A text may be cut before a blank that follows a character which isn't white space: no token of either
#: vocabulary reaches over such a place (``Tokenizers`` checks it), and both have a token that ends there.
CUT = re.compile(r"(?<=\S)(?= )")
PREFIX = "▁"


def byte_level_bytes() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable ones for themselves, the others,
    in order, as the characters from 256 on."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


class Tokenizers:
    """Both tokenizers, from the contents of their files, with the bytes of every token."""

    def __init__(self, a_file: bytes, b_file: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        import tokenizers

        self.a = tokenizers.Tokenizer.from_str(a_file.decode())
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_file)
        level = byte_level_bytes()
        self.a_bytes = {
            i: bytes(map(level.__getitem__, t)) if all(c in level for c in t) else t.encode() for t, i in self.a.get_vocab().items()
        }
        n = self.b.get_piece_size()
        pieces = [self.b.id_to_piece(i) for i in range(n)]
        self.b_bytes = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(PREFIX, " ").encode() for i, p in enumerate(pieces)
        ]
        self.blank = self.b.piece_to_id(PREFIX)
        most = max(self.a_bytes) + 1
        self.a_length = np.array([len(self.a_bytes.get(i, b"")) for i in range(most)])
        self.b_length = np.array(list(map(len, self.b_bytes)))
        #: Ids as text with what follows: A's with "," and "|", B's with "," and ";".
        self.shown = [f"{i}{c}" for i in range(most) for c in ",|"] + [f"{i}{c}" for i in range(n) for c in ",;"]
        # Segments are encoded by themselves only if no token crosses a place where texts are cut.
        crossing = any(re.search(f"[^{PREFIX}]{PREFIX}", p) for p in pieces) or any(
            CUT.search(t.decode("utf-8", "replace")) for t in self.a_bytes.values()
        )
        self.cut = not crossing

    def segments(self, text: str) -> list[str]:
        """``text`` after a blank, in parts that both tokenizers encode as they would within the whole."""
        return CUT.split(f" {text}") if self.cut else [f" {text}"]

    def encode(self, segments: list[str]) -> list[tuple[list[int], list[int]]]:
        """A's and B's ids of segments, each of which begins with a blank."""
        a = [e.ids for e in self.a.encode_batch_fast(segments, add_special_tokens=False)]
        # B adds the first blank itself, but none to an empty text.
        b = [ids or [self.blank] for ids in self.b.encode([s[1:] for s in segments], num_threads=1)]
        return list(zip(a, b, strict=True))


class Segment(NamedTuple):
    """A segment's alignment: numbers of tokens, groups and links, groups as text, and the pair (A id << 32 | B id) of
    every link as 8 bytes, or of some with how many links they have in ``times``."""

    n_a: int
    n_b: int
    n_groups: int
    n_links: int
    text: str
    pairs: bytes
    times: np.ndarray | None


#: Groups of more links than this hold each pair once, with its number.
LARGE_GROUP = 4096


def _whole(segments: list[str], ids: list[tuple[list[int], list[int]]], both: Tokenizers) -> list[bool]:
    """Whether each segment is what its tokens' bytes of either kind make; halves are looked at only if all together differ."""
    sizes = np.array([len(s.encode("utf-8", "surrogatepass")) for s in segments])
    data = "".join(segments).encode("utf-8", "surrogatepass")
    same = True
    for k, (lengths, tokens) in enumerate(((both.a_length, both.a_bytes), (both.b_length, both.b_bytes))):
        every = list(chain.from_iterable(x[k] for x in ids))
        n = np.array([len(x[k]) for x in ids])
        ends = np.r_[0, np.cumsum(lengths[every])][np.cumsum(n)]
        same = same and np.array_equal(ends, np.cumsum(sizes)) and b"".join(map(tokens.__getitem__, every)) == data
    if same or len(segments) == 1:
        return [bool(same)] * len(segments)
    middle = len(segments) // 2
    return _whole(segments[:middle], ids[:middle], both) + _whole(segments[middle:], ids[middle:], both)


def aligned_segments(segments: list[str], both: Tokenizers) -> list[Segment | None]:
    """The alignment of segments; None where the tokens' bytes are not the segment's. All segments stand one after the
    other, so the places where a token of each ends are common values of two running sums."""
    if not segments:
        return []
    ids = both.encode(segments)
    right = _whole(segments, ids, both)
    out: list[Segment | None] = [None] * len(segments)
    good = [i for i, x in enumerate(right) if x]
    if not good:
        return out
    n_a, n_b = (np.array([len(ids[i][k]) for i in good]) for k in (0, 1))
    a, b = (np.fromiter(chain.from_iterable(ids[i][k] for i in good), np.int64) for k in (0, 1))
    a_end, b_end = np.cumsum(both.a_length[a]), np.cumsum(both.b_length[b])
    cuts = np.intersect1d(a_end, b_end, assume_unique=True)
    of_a, of_b = np.searchsorted(cuts, a_end), np.searchsorted(cuts, b_end)
    in_a, in_b = np.bincount(of_a, minlength=len(cuts)), np.bincount(of_b, minlength=len(cuts))
    # Groups as text: A's ids of a group, then B's, each with what follows it.
    a_code = 2 * a + np.r_[of_a[1:] != of_a[:-1], True]
    b_code = 2 * (len(both.a_length) + b) + np.r_[of_b[1:] != of_b[:-1], True]
    order = np.argsort(np.r_[2 * of_a, 2 * of_b + 1], kind="stable")
    shown = list(map(both.shown.__getitem__, np.r_[a_code, b_code][order].tolist()))
    # Links: every A token with all B tokens of its group, unless the group is large.
    links = in_a * in_b
    small = links <= LARGE_GROUP
    first_b = np.cumsum(in_b) - in_b
    each = np.where(small[of_a], in_b[of_a], 0)
    at = np.arange(int(each.sum())) - np.repeat(np.cumsum(each) - each, each) + np.repeat(first_b[of_a], each)
    pairs = np.repeat(a, each).astype(np.uint64) << np.uint64(32) | b[at].astype(np.uint64)
    a_to, b_to = np.cumsum(n_a), np.cumsum(n_b)
    group_to = np.searchsorted(cuts, a_end[a_to - 1]) + 1
    pair_to = np.cumsum(each)[a_to - 1]
    link_to = np.cumsum(links)[group_to - 1]
    large: dict[int, list[int]] = {}
    for g in np.flatnonzero(~small).tolist():
        large.setdefault(int(np.searchsorted(group_to, g, "right")), []).append(g)
    n_groups, n_links = np.diff(group_to, prepend=0), np.diff(link_to, prepend=0)
    token_to = a_to + b_to
    rows = zip(good, n_a.tolist(), n_b.tolist(), n_groups.tolist(), n_links.tolist(), token_to.tolist(), pair_to.tolist(), strict=True)
    packed = pairs.tobytes()
    token, pair = 0, 0
    for k, (i, x, y, groups, number, to, upto) in enumerate(rows):
        mine, times = packed[8 * pair : 8 * upto], None
        if k in large:
            every, times = _with_large_groups(pairs[pair:upto], [(a[of_a == g], b[of_b == g]) for g in large[k]])
            mine = every.tobytes()
        out[i] = Segment(x, y, groups, number, "".join(shown[token:to])[:-1], mine, times)
        token, pair = to, upto
    return out


def _with_large_groups(pairs: np.ndarray, groups: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    all_pairs, all_times = [pairs], [np.ones(len(pairs), np.int64)]
    for a, b in groups:
        (x, m), (y, n) = np.unique(a, return_counts=True), np.unique(b, return_counts=True)
        all_pairs.append((x.astype(np.uint64)[:, None] << np.uint64(32) | y.astype(np.uint64)[None, :]).ravel())
        all_times.append((m[:, None] * n[None, :]).ravel())
    return np.concatenate(all_pairs), np.concatenate(all_times)


def pack(numbers: np.ndarray) -> bytes:
    return zstandard.compress(numbers.tobytes(), 3)


def unpack(data: bytes, dtype: str) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(data), dtype)


def bucket_of(pairs: np.ndarray) -> np.ndarray:
    return (mix64(pairs >> np.uint64(32)) >> np.uint64(32)) % np.uint64(BUCKETS)


def pack_bitmaps(rows: np.ndarray, counts: np.ndarray, n: int) -> bytes:
    """Bitmaps over ``n`` rows of a block, one after the other: ``counts`` rows of each, ascending. Where at least one
    row in 16 is set a bitmap is its bits, else the steps from row to row."""
    dense = counts * 16 >= n
    owner = np.repeat(np.arange(len(counts)), counts)
    of_dense = dense[owner]
    bits = np.zeros((int(dense.sum()), n), bool)
    bits[(np.cumsum(dense) - 1)[owner[of_dense]], rows[of_dense]] = True
    sparse = rows[~of_dense].astype(np.int64)
    steps = np.diff(sparse, prepend=0)
    first = np.r_[True, owner[~of_dense][1:] != owner[~of_dense][:-1]] if len(sparse) else np.zeros(0, bool)
    steps[first] = sparse[first]
    return zstandard.compress(np.packbits(bits, axis=1).tobytes() + steps.astype("<u2").tobytes(), 3)


def unpack_bitmaps(data: bytes, counts: np.ndarray, n: int) -> np.ndarray:
    """The rows of each bitmap, one bitmap after the other."""
    dense = counts * 16 >= n
    raw = zstandard.decompress(data)
    width, many = -(-n // 8), int(dense.sum())
    bits = np.unpackbits(np.frombuffer(raw[: width * many], np.uint8).reshape(many, width), axis=1, count=n)
    out = np.empty(int(counts.sum()), np.int64)
    of_dense = np.repeat(dense, counts)
    out[of_dense] = np.nonzero(bits)[1]
    steps = np.frombuffer(raw[width * many :], "<u2").astype(np.int64)
    total = np.cumsum(steps)
    sizes = counts[~dense]
    starts = np.cumsum(sizes) - sizes
    before = np.where(starts > 0, total[np.maximum(starts - 1, 0)], 0) if len(sizes) else starts
    out[~of_dense] = total - np.repeat(before, sizes)
    return out


def pack_planes(numbers: np.ndarray) -> bytes:
    """Numbers from 1 on as planes: the bits of one place of all numbers, from the lowest place on."""
    places = int(numbers.max()).bit_length()
    return zstandard.compress(b"".join(np.packbits(numbers >> j & 1).tobytes() for j in range(places)), 3)


def unpack_planes(data: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(-1, -(-n // 8))
    return sum(np.unpackbits(p, count=n).astype(np.int64) << j for j, p in enumerate(planes))


DOC = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "groups")
#: Rows of documents (bucket -1) and of postings: the bitmaps of a block's pairs in a bucket.
ROWS = (
    "block long, row int, bucket int, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "groups string, n_rows int, pairs binary, docs binary, links binary, bitmaps binary, planes binary"
)
ROW_TYPES = [
    pa.int64(), pa.int32(), pa.int32(), *[pa.int64()] * 5, pa.string(), pa.string(), pa.int32(), *[pa.binary()] * 5,
]
ROW_NAMES = [c.split()[0] for c in ROWS.split(", ")]


class Encoder:
    """Blocks of texts to rows, with the segments seen lately."""

    def __init__(self, a_file: bytes, b_file: bytes, whole: bool):
        self.both, self.whole = Tokenizers(a_file, b_file), whole
        self.seen: dict[str, Segment | None] = {}
        self.before: dict[str, Segment | None] = {}

    def aligned(self, distinct: list[str]) -> list[Segment | None]:
        if len(self.seen) > REMEMBERED:
            self.before, self.seen = self.seen, {}
        for s in distinct:
            if s not in self.seen and s in self.before:
                self.seen[s] = self.before[s]
        fresh = [s for s in distinct if s not in self.seen]
        found = dict(zip(fresh, aligned_segments(fresh, self.both), strict=True))
        out = [found[s] if s in found else self.seen[s] for s in distinct]
        self.seen.update((s, x) for s, x in found.items() if len(s) <= LONGEST_REMEMBERED)
        return out

    def block(self, number: int, ids: list, texts: list[str | None]) -> pa.RecordBatch:
        split = [self.both.segments(t) if t else [] for t in texts]
        distinct: dict[str, int] = {}
        numbers = [[distinct.setdefault(s, len(distinct)) for s in part] for part in split]
        held = self.aligned(list(distinct))
        wrong = {i for i, x in enumerate(held) if x is None}
        if wrong:
            numbers = [[] if not wrong.isdisjoint(at) else at for at in numbers]
        counts = np.array([(0, 0, 0, 0) if x is None else x[:4] for x in held], np.int64).reshape(-1, 4)
        shown = ["" if x is None else x.text for x in held]
        rows: list[tuple] = []
        numbers = [np.array(at, np.int64) for at in numbers]
        for row, (doc_id, at) in enumerate(zip(ids, numbers, strict=True)):
            text = ";".join(map(shown.__getitem__, at.tolist()))
            sha = hashlib.sha256(text.encode()).hexdigest() if len(at) else ""
            rows.append((number, row, -1, doc_id, *counts[at].sum(0).tolist(), sha, text if self.whole else None, *[None] * 6))
        rows += self.postings(number, numbers, held)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), ROW_TYPES, strict=True)], ROW_NAMES)

    @staticmethod
    def postings(number: int, numbers: list[np.ndarray], held: list[Segment | None]) -> Iterator[tuple]:
        n = len(numbers)
        doc = np.repeat(np.arange(n), [len(x) for x in numbers])
        if not len(doc):
            return
        # Each document's distinct segments, then their pairs, then each pair's documents with the links in each.
        both, times = np.unique(doc * len(held) + np.concatenate(numbers), return_counts=True)
        doc, segment = np.divmod(both, len(held))
        used = [b"" if s is None else s.pairs for s in held]
        sizes = np.array(list(map(len, used))) // 8
        pairs = np.frombuffer(b"".join(used), np.uint64)
        links = np.ones(len(pairs), np.int64)
        ends = np.cumsum(sizes)
        for i, s in enumerate(held):
            if s is not None and s.times is not None:
                links[ends[i] - sizes[i] : ends[i]] = s.times
        distinct, index = np.unique(pairs, return_inverse=True)
        order = np.argsort(bucket_of(distinct), kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        distinct, index = distinct[order], place[index]
        each = sizes[segment]
        at = np.arange(int(each.sum())) + np.repeat((np.cumsum(sizes) - sizes)[segment] - (np.cumsum(each) - each), each)
        key = index[at] * n + np.repeat(doc, each)
        weight = links[at] * np.repeat(times, each)
        order = np.argsort(key, kind="stable")
        key, weight = key[order], weight[order]
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        weight = np.add.reduceat(weight, first)
        pair, doc = np.divmod(key[first], n)
        counts = np.bincount(pair, minlength=len(distinct))
        ends = np.r_[0, np.cumsum(counts)]
        cuts = np.searchsorted(bucket_of(distinct), np.arange(BUCKETS + 1, dtype=np.uint64))
        for bucket in range(BUCKETS):
            lo, hi = cuts[bucket], cuts[bucket + 1]
            if lo < hi:
                mine = slice(ends[lo], ends[hi])
                total = np.add.reduceat(weight[mine], ends[lo:hi] - ends[lo])
                packed = (
                    pack(np.diff(distinct[lo:hi], prepend=np.uint64(0))),
                    pack(counts[lo:hi].astype("<u4")),
                    pack(total.astype("<u8")),
                    pack_bitmaps(doc[mine], counts[lo:hi], n),
                    pack_planes(weight[mine]),
                )
                yield (number, None, bucket, *[None] * 7, n, *packed)


def _encode(a_file: bytes, b_file: bytes, whole: bool):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import gc

        from pyspark import TaskContext

        # What is remembered has no cycles; looking for some takes a fifth of the time.
        gc.disable()
        encoder = Encoder(a_file, b_file, whole)
        number = TaskContext.get().partitionId() << 32
        ids, texts, chars = [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids.append(doc_id)
                texts.append(text)
                chars += len(text or "")
                if len(ids) >= BLOCK_ROWS or chars >= BLOCK_CHARS:
                    yield encoder.block(number, ids, texts)
                    number, ids, texts, chars = number + 1, [], [], 0
        if ids:
            yield encoder.block(number, ids, texts)
        gc.enable()

    return work


COUNTS = "bucket int, part long, pairs binary, docs binary, links binary"


def _merge(rows: pa.Table) -> pa.Table:
    """Counts of equal pairs added up. Bitmaps of different blocks have no row in common, so what their OR has set is
    the sum of what each has set, and only that is shuffled."""
    pairs = [np.cumsum(unpack(p, "<u8"), dtype=np.uint64) for p in rows.column("pairs").to_pylist()]
    distinct, index = np.unique(np.concatenate(pairs), return_inverse=True)
    sums = []
    for name, dtype in (("docs", "<u8"), ("links", "<u8")):
        out = np.zeros(len(distinct), dtype)
        given = "<u4" if name == "docs" and rows.column("first")[0].as_py() else "<u8"
        np.add.at(out, index, np.concatenate([unpack(x, given) for x in rows.column(name).to_pylist()]).astype(dtype))
        sums.append(pack(out))
    values = [rows.column("bucket")[0].as_py(), rows.column("part")[0].as_py(), pack(np.diff(distinct, prepend=np.uint64(0))), *sums]
    types = [pa.int32(), pa.int64(), *[pa.binary()] * 3]
    return pa.table([pa.array([v], t) for v, t in zip(values, types, strict=True)], names=["bucket", "part", "pairs", "docs", "links"])


SCORES = "block long, sums binary, best binary"


def _score(postings: pa.Table, counts: pa.Table) -> pa.Table:
    """What each document of each block gets from the pairs of one bucket: the sum of counts over its links, and its
    links whose count is the highest of their A id."""
    out = []
    if postings.num_rows:
        pairs = np.cumsum(unpack(counts.column("pairs")[0].as_py(), "<u8"), dtype=np.uint64)
        docs = unpack(counts.column("docs")[0].as_py(), "<u8").astype(np.int64)
        a = pairs >> np.uint64(32)
        first = np.flatnonzero(np.r_[True, a[1:] != a[:-1]])
        most = np.repeat(np.maximum.reduceat(docs, first), np.diff(np.r_[first, len(a)]))
        best = docs == most
        names = ("block", "n_rows", "pairs", "docs", "bitmaps", "planes")
        for block, n, packed, n_docs, bitmaps, planes in zip(*(postings.column(c).to_pylist() for c in names), strict=True):
            at = np.searchsorted(pairs, np.cumsum(unpack(packed, "<u8"), dtype=np.uint64))
            each = unpack(n_docs, "<u4").astype(np.int64)
            rows, times = unpack_bitmaps(bitmaps, each, n), unpack_planes(planes, int(each.sum()))
            sums, hits = np.zeros(n, np.int64), np.zeros(n, np.int64)
            np.add.at(sums, rows, times * np.repeat(docs[at], each))
            np.add.at(hits, rows, times * np.repeat(best[at], each))
            out.append((block, pack(sums.astype("<i8")), pack(hits.astype("<i8"))))
    columns = list(zip(*out, strict=True)) if out else [[]] * 3
    return pa.table([pa.array(c, t) for c, t in zip(columns, [pa.int64(), pa.binary(), pa.binary()], strict=True)], names=["block", "sums", "best"])


ALIGNED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string, groups string"


def _finish(docs: pa.Table, scores: pa.Table) -> pa.Table:
    n = (max(docs.column("row").to_pylist()) if docs.num_rows else -1) + 1
    sums, best = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for s, b in zip(scores.column("sums").to_pylist(), scores.column("best").to_pylist(), strict=True):
        sums += unpack(s, "<i8")
        best += unpack(b, "<i8")
    row = docs.column("row").to_numpy()
    columns = {c: docs.column(c) for c in DOC} | {"n_best": pa.array(best[row]), "count_sum": pa.array(sums[row])}
    return pa.table({c.split()[0]: columns[c.split()[0]] for c in ALIGNED.split(", ")})


def read_file(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def align_tokenizers(
    docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text", whole: bool = False
) -> tuple[DataFrame, DataFrame]:
    """How tokens of two tokenizers share the text of every row of ``docs``.

    ``a_path`` is a byte-level BPE (tokenizers, JSON), ``b_path`` a sentencepiece model; the driver reads both files and
    sends their few MB with the job. Byte offsets where a token of each ends cut a text into groups; within a group
    each occurrence of an A token is linked with each of a B token. A link of ids counts once for a document that holds it.

    Blocks of documents are encoded in one pass; a segment between cuts is encoded once per task. Each block keeps, for
    every id pair, a compressed bitmap of its documents and bit planes of the links in each, filed under buckets of
    A ids. Counts meet in a tree of merges of at most 64 rows each; then every posting list goes to its bucket's
    counts and returns a score per document. No pair of occurrences is written out, and no task holds more than 64
    blocks of a bucket or a bucket's pairs, however hot a token is.

    Defined results: null and empty texts, and those whose tokens' bytes differ from a blank and the text, have no
    tokens, zeros and groups ''; rows count by themselves, whether ids are null or repeated; an empty table gives
    empty tables; other columns are ignored; texts are encoded whole.

    Returns the documents (doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256, and groups as text if
    ``whole``) and the pairs (a, b, docs, links).
    """
    work = _encode(read_file(a_path), read_file(b_path), whole)
    rows = stored(docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(work, ROWS))
    postings = rows.filter("bucket >= 0")
    blocks = rows.filter("row = 0").count()
    part = lambda n: F.pmod(F.xxhash64("block"), F.lit(n))
    parts = -(-blocks // MERGED) or 1
    first = part(parts)
    counts = postings.select("bucket", first.alias("part"), "pairs", "docs", "links", F.lit(True).alias("first"))
    n = parts
    while True:
        counts = counts.groupBy("bucket", "part").applyInArrow(_merge, COUNTS)
        if n == 1:
            break
        n = -(-n // MERGED)
        counts = counts.select("bucket", F.pmod("part", F.lit(n)).alias("part"), "pairs", "docs", "links", F.lit(False).alias("first"))
    counts = stored(counts.drop("part"))
    scores = (
        postings.select("bucket", first.alias("part"), "block", "n_rows", "pairs", "docs", "bitmaps", "planes")
        .groupBy("bucket", "part")
        .cogroup(counts.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))).alias("part")).groupBy("bucket", "part"))
        .applyInArrow(_score, SCORES)
    )
    aligned = rows.filter("bucket = -1").select("block", "row", *DOC).groupBy("block").cogroup(scores.groupBy("block")).applyInArrow(_finish, ALIGNED)
    return aligned if whole else aligned.drop("groups"), counts.mapInArrow(_list_pairs, "a int, b int, docs long, links long")


def _list_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for p, d, n in zip(*(batch.column(c).to_pylist() for c in ("pairs", "docs", "links")), strict=True):
            pairs = np.cumsum(unpack(p, "<u8"), dtype=np.uint64)
            columns = [(pairs >> np.uint64(32)).astype(np.int32), (pairs & np.uint64(2**32 - 1)).astype(np.int32)]
            columns += [unpack(x, "<u8").astype(np.int64) for x in (d, n)]
            yield pa.RecordBatch.from_arrays(list(map(pa.array, columns)), ["a", "b", "docs", "links"])

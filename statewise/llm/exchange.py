"""Corpus counts without a row for every key: blocks of documents ask hash buckets for what all blocks hold.

A block is a run of neighbouring rows of one scan partition. It sends each bucket of the hash space one row with the
sorted distinct keys that it holds there, packed, and a number for each. A bucket adds up the numbers of all blocks and
answers each block with the sums in the order of the keys that it sent, so answers carry no keys. Every task holds one
block or one bucket.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

#: Rows of a block are a power of two.
BLOCK_BITS = 12
REQUEST = "bucket int, block long, kind int, keys binary, counts binary"
ANSWER = "bucket int, block long, kind int, counts binary, distinct long, total long"


def is_scan(docs: DataFrame) -> bool:
    """Whether ``docs`` is a table of files with projections and filters at most."""
    plans = [docs._jdf.queryExecution().optimizedPlan()]
    while plans:
        node = plans.pop()
        if node.getClass().getSimpleName() not in ("LogicalRelation", "Project", "Filter"):
            return False
        children = node.children()
        plans += [children.apply(i) for i in range(children.size())]
    return True


def with_block(docs: DataFrame) -> DataFrame:
    """``docs`` with the column block, the same each time that it is computed.

    A scan deals files to partitions by their sizes alone. Anything else is stored as files first, as another plan
    may deal its rows differently for other columns.
    """
    docs = docs if is_scan(docs) else stored(docs)
    return docs.withColumn("block", F.shiftright(F.monotonically_increasing_id(), BLOCK_BITS))


def buckets_for(rows: int) -> int:
    """Number of buckets, a power of two: one for about four blocks, 64 at least."""
    return max(64, 1 << max(0, (rows >> (BLOCK_BITS + 2)).bit_length()))


MORE = 2**32 - 1


def pack(keys: np.ndarray, width: int) -> bytes:
    """Sorted 64-bit keys: those of 8 bytes as they are, shorter ones as the first and the differences of their top
    ``width`` bytes. A difference is a 32-bit number below MORE, after as many times MORE as it holds.
    """
    if width == 8 or not len(keys):
        return keys.astype("<u8").tobytes()
    step = np.diff(keys >> np.uint64(64 - 8 * width), prepend=keys[:1] >> np.uint64(64 - 8 * width))
    times = (step // np.uint64(MORE)).astype(np.int64)
    out = np.full(len(keys) + int(times.sum()), MORE, "<u4")
    out[np.cumsum(times + 1) - 1] = step % np.uint64(MORE)
    return keys[:1].astype("<u8").tobytes() + out.tobytes()


def unpack(data: bytes, width: int) -> np.ndarray:
    if width == 8 or not data:
        return np.frombuffer(data, "<u8")
    first, steps = np.frombuffer(data[:8], "<u8"), np.frombuffer(data[8:], "<u4")
    return first + (np.cumsum(steps.astype(np.uint64))[steps != MORE] << np.uint64(64 - 8 * width))


def cut(keys: np.ndarray, width: int) -> np.ndarray:
    """64-bit keys with all but the top ``width`` bytes zero."""
    return keys & np.uint64(2**64 - 2 ** (64 - 8 * width))


def ends(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Where the part of each bucket begins and ends in sorted keys; bucket is the top bits."""
    shift = np.uint64(64 - (buckets.bit_length() - 1))
    return np.searchsorted(keys >> shift, np.arange(buckets + 1, dtype=np.uint64))


def requests(
    block: int, kind: int, keys: np.ndarray, values: np.ndarray, width: int, buckets: int, dtype: str = "<u4"
) -> list[tuple]:
    """Request rows of one block for sorted distinct ``keys``."""
    at = ends(keys, buckets)
    values = values.astype(dtype)
    return [
        (b, block, kind, pack(keys[lo:hi], width), zlib.compress(values[lo:hi].tobytes(), 1))
        for b, (lo, hi) in enumerate(zip(at[:-1], at[1:], strict=True))
        if hi > lo
    ]


def request_batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary()]
    columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["bucket", "block", "kind", "keys", "counts"]
    )


def add_up(
    widths: dict[int, int], dtype: str = "<u4", combine: Callable[[np.ndarray, np.ndarray, int], np.ndarray] | None = None
):
    """The function of a bucket. ``combine`` (values, key indexes, number of keys) gives a number for each key; by
    default the sum. The answer to block -1 has the number of keys above 0 and the total of each kind."""

    def answer(asked: pa.Table) -> pa.Table:
        bucket = asked.column("bucket")[0].as_py()
        blocks, kinds = asked.column("block").to_numpy(), asked.column("kind").to_numpy()
        keys, counts = asked.column("keys").to_pylist(), asked.column("counts").to_pylist()
        out = []
        for kind, width in widths.items():
            rows = np.flatnonzero(kinds == kind)
            if not len(rows):
                continue
            each = [unpack(keys[i], width) for i in rows]
            distinct, index = np.unique(np.concatenate(each), return_inverse=True)
            values = np.concatenate([np.frombuffer(zlib.decompress(counts[i]), dtype) for i in rows])
            if combine is None:
                sums = np.bincount(index, values, len(distinct)).astype(np.int64)
            else:
                sums = combine(values, index, len(distinct))
            reply = np.minimum(sums, 2**32 - 1).astype("<u4")[index]
            lo = 0
            for i, k in zip(rows, each, strict=True):
                out.append((bucket, int(blocks[i]), kind, zlib.compress(reply[lo : lo + len(k)].tobytes(), 1), None, None))
                lo += len(k)
            out.append((bucket, -1, kind, b"", int((sums > 0).sum()), int(sums.sum())))
        types = [pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.int64()]
        return pa.table(
            [pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)],
            names=["bucket", "block", "kind", "counts", "distinct", "total"],
        )

    return answer


def answers(asked: DataFrame, widths: dict[int, int], dtype: str = "<u4", combine=None) -> DataFrame:
    return asked.groupBy("bucket").applyInArrow(add_up(widths, dtype, combine), ANSWER)


def reply_of(replies: pa.Table, kind: int, length: int) -> np.ndarray:
    """The numbers for a block's sorted distinct keys of one kind."""
    rows = [
        (b, c)
        for b, k, c in zip(*(replies.column(n).to_pylist() for n in ("bucket", "kind", "counts")), strict=True)
        if k == kind
    ]
    data = b"".join(zlib.decompress(c) for _, c in sorted(rows))
    if len(data) != 4 * length:
        raise RuntimeError("the block's rows differ from those that asked; read the documents from unchanged files")
    return np.frombuffer(data, "<u4").astype(np.int64)


def runs(ids: np.ndarray) -> list[tuple[int, int]]:
    """First and last + 1 of each run of equal values."""
    if not len(ids):
        return []
    at = [0, *(np.flatnonzero(np.diff(ids)) + 1).tolist(), len(ids)]
    return list(zip(at[:-1], at[1:], strict=True))


def by_block(batches: Iterator[pa.RecordBatch], work) -> Iterator[pa.RecordBatch]:
    """Calls work(block, lists of the other columns' values) for each run of equal blocks, which are column 0."""
    block, held = None, []
    for batch in batches:
        ids = batch.column(0).to_numpy()
        columns = [batch.column(i).to_pylist() for i in range(1, batch.num_columns)]
        for lo, hi in runs(ids):
            if block is not None and ids[lo] != block:
                yield work(block, *held)
                held = []
            block = int(ids[lo])
            held = held or [[] for _ in columns]
            for h, c in zip(held, columns, strict=True):
                h.extend(c[lo:hi])
    if block is not None:
        yield work(block, *held)


def shrink(text: str | None) -> bytes:
    """A text in UTF-8, compressed, for shuffles."""
    return zstandard.compress((text or "").encode("utf-8", "surrogatepass"), 3)


def grow(data: bytes) -> bytes:
    return zstandard.decompress(data)


def shrunk(docs: DataFrame) -> DataFrame:
    """``docs`` with its column text compressed and named packed, to be shuffled by block."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            i = batch.schema.get_field_index("text")
            packed = pa.array([shrink(t) for t in batch.column(i).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([c if j != i else packed for j, c in enumerate(batch.columns)], names)

    names = ["packed" if f.name == "text" else f.name for f in docs.schema]
    schema = ", ".join(f"{n} {'binary' if n == 'packed' else f.dataType.simpleString()}" for n, f in zip(names, docs.schema, strict=True))
    return docs.mapInArrow(work, schema)

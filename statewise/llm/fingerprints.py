"""Document fingerprints: bottom-k sketches of shingle hashes, mergeable, for likeness, containment and counts."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Bytes of a shingle: so many that one fills 64 bits, and the mixed value has no collisions.
WIDTH = 8
#: Hashes kept of a document.
K = 128
#: Most ranges that ids are dealt to.
MOST_RANGES = 16_384


def mix64(x: np.ndarray) -> np.ndarray:
    """A one-to-one mixing of 64-bit values (the finisher of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def sketch(text: str | None, k: int = K) -> np.ndarray:
    """The k smallest distinct hashes of the text's byte shingles, ascending; a short text is one shingle, an empty none."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    if not raw:
        return np.empty(0, np.uint64)
    if len(raw) < WIDTH:
        return mix64(np.frombuffer(raw + bytes([len(raw)]).rjust(8 - len(raw), b"\0"), np.uint64))
    n = len(raw) - WIDTH + 1
    h = mix64(np.ndarray((n,), "<u8", raw, 0, (1,)))  # a window of eight bytes at every byte
    if n > 8 * k:  # the smallest k are nearly always among these
        low = np.unique(h[h < np.uint64(int(2**64 * (4 * k / n)))])
        if len(low) >= k:
            return low[:k]
    return np.unique(h)[:k]


def merge(a: np.ndarray, b: np.ndarray, k: int = K) -> np.ndarray:
    """The sketch of both texts' shingles together."""
    return np.union1d(a, b)[:k]


def distinct(a: np.ndarray, k: int = K) -> float:
    """Number of distinct shingles: exact below k, else estimated from the k-th smallest hash."""
    return float(len(a)) if len(a) < k else (k - 1) / (float(a[-1]) / 2.0**64)


def resemblance(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated share of common shingles in the union; 1 for two empty sketches, 0 for one."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    both = merge(a, b, k)
    last = both[-1]
    a, b = a[a <= last], b[b <= last]
    return len(np.intersect1d(a, b, assume_unique=True)) / len(both)


def containment(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated share of a's shingles that b has too; 1 for an empty a."""
    if not len(a):
        return 1.0
    common = resemblance(a, b, k) * distinct(merge(a, b, k), k)
    return min(1.0, common / distinct(a, k))


def to_text(a: np.ndarray) -> str:
    return f"{WIDTH}.{K}." + base64.b64encode(a.astype(">u8").tobytes()).decode()


def from_text(s: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(s.split(".", 2)[2]), ">u8").astype(np.uint64)


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order: each document is followed by its next one in the same range, the last of a range by a guest."""
    waiting: tuple | None = None  # a document of which the next one is to come
    for batch in batches:
        out: list[tuple] = []
        columns = (batch.column(i).to_pylist() for i in range(4))
        for at, guest, doc_id, text in zip(*columns, strict=True):
            text = text or ""
            own = sketch(text)
            if waiting is not None and waiting[0] == at:
                _, one_id, one, one_sketch = waiting
                half = len(one) // 2
                edited = one[: len(one) - half] + text[:half]
                edited_sketch = sketch(edited)
                out.append(
                    (
                        one_id,
                        len(one),
                        hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(),
                        to_text(one_sketch),
                        to_text(edited_sketch),
                        resemblance(one_sketch, edited_sketch),
                        resemblance(one_sketch, own),
                        distinct(one_sketch),
                        containment(one_sketch, edited_sketch),
                    )
                )
            waiting = None if guest else (at, doc_id, text, own)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 9, TYPES, strict=True)], NAMES)


NAMES = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "n_shingles", "contained"]
TYPES = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), *[pa.float64()] * 4]
SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, n_shingles double, contained double"


def fingerprint_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited form, and how like they and the next document's are.

    Documents stand in descending id. Ids are dealt to ranges in that order (about 256 documents each, at most 16,384
    ranges); a range is sorted and read as a stream that holds two texts at a time. The document that follows the last
    of a range is the first of the next range: it comes to the range as a guest. Guests are one per range, so their
    ids are a list of bounded size.

    Defined results: a null text counts as empty; a null id stands last; rows with the same id stand in the order of
    their texts; a single row follows itself; an empty table gives no rows; other columns are ignored. A text shorter
    than eight bytes is one shingle; an empty text has an empty sketch, like only to another empty one.

    Returns doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, n_shingles
    (estimated distinct shingles), contained (estimated share of them that the edited text keeps).
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    n, lowest, highest = rows.agg(F.count("*"), F.min("doc_id"), F.max("doc_id")).first()
    lowest, highest = lowest or 0, highest or 0
    ranges = min(MOST_RANGES, max(1, n // 256))
    share = (F.col("doc_id").cast("double") - float(lowest)) / float(highest - lowest + 1)
    rows = rows.withColumn("at", F.coalesce(F.floor(share * ranges), F.lit(-1)).cast("long"))
    heads = (
        rows.groupBy("at")
        .agg(F.max("doc_id").alias("head"))
        .withColumn("to", F.coalesce(F.lead("at").over(Window.orderBy("at")), F.min("at").over(Window.partitionBy())))
        .withColumnRenamed("at", "of")
    )
    # One row for each range: at most 16,385 rows.
    guests = rows.join(F.broadcast(heads), (F.col("at") == F.col("of")) & F.col("doc_id").eqNullSafe(F.col("head")))
    streamed = (
        rows.select("at", F.lit(0).alias("guest"), "doc_id", "text")
        .unionByName(guests.select(F.col("to").alias("at"), F.lit(1).alias("guest"), "doc_id", "text"))
        .repartition("at")
        .sortWithinPartitions("at", "guest", F.col("doc_id").desc_nulls_last(), "text")
    )
    return streamed.mapInArrow(_compare, SCHEMA)


def sketch_groups(docs: DataFrame, group_col: str, text_col: str = "text") -> DataFrame:
    """One fingerprint for all texts of each group. Every task merges what it reads first, so a hot group stays small."""

    def parts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict = {}
        for pdf in batches:
            for group, text in zip(pdf["g"], pdf["t"], strict=True):
                held[group] = merge(held.get(group, np.empty(0, np.uint64)), sketch(text))
        yield pd.DataFrame({"g": list(held), "s": [to_text(a) for a in held.values()]}, dtype=object)

    def whole(pdf: pd.DataFrame) -> pd.DataFrame:
        held = np.empty(0, np.uint64)
        for s in pdf["s"]:
            held = merge(held, from_text(s))
        return pd.DataFrame({"g": [pdf["g"].iloc[0]], "s": [to_text(held)]}, dtype=object)

    rows = docs.select(F.col(group_col).cast("string").alias("g"), F.col(text_col).alias("t"))
    return (
        rows.mapInPandas(parts, "g string, s string")
        .groupBy("g")
        .applyInPandas(whole, "g string, s string")
        .select(F.col("g").alias(group_col), F.col("s").alias("fingerprint"))
    )

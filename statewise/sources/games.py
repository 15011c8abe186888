"""Game texts, and the tables made of them: reading, compacting, writing. Paths always come from the caller."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from statewise.operators.game_filter import CLEAN, REASONS, sorted_games
from statewise.operators.profile import upsert
from statewise.operators.stats import STATE

MARK = "[Event "
#: So many request keys are broadcast (some 100 bytes each).
BROADCAST_REQUESTS = 500_000


def read_game_texts(spark: SparkSession, path: str) -> DataFrame:
    """One row (path, value) for each game of text files. A file is split between tasks at any game.

    Text before a file's first game and a byte order mark are dropped; bytes that aren't UTF-8 become replacement
    characters in their own game only. A compressed file is read whole by one task.
    """
    rows = spark.read.option("lineSep", f"\n{MARK}").text(path).select(
        F.col("_metadata.file_path").alias("path"), F.regexp_replace("value", "^﻿", "").alias("value")
    )
    # The separator takes the mark from all games but a file's first.
    first = F.col("value").startswith(MARK)
    value = F.when(first, F.col("value")).otherwise(F.concat(F.lit(MARK), F.col("value")))
    return rows.withColumn("value", value).filter(F.col("value").rlike(r'^\[Event "[^\n]*"\]'))


def split_records(texts: DataFrame, key: str, text_col: str = "value") -> DataFrame:
    """One row (key, record, value) for each game of texts that hold several."""
    records = F.filter(F.split(F.col(text_col), r"(?m)^(?=\[Event )"), lambda r: r.startswith(MARK))
    return texts.select(key, F.posexplode(records).alias("record", "value"))


def numbered_records(records: DataFrame, key: str, file: str, own: str) -> DataFrame:
    """``records``, which have a number ``own`` (0..) in their file, with the number ``record`` among all of their key.

    Files of a key stand in order. One row for each file is all that is dealt by key alone.
    """
    counts = records.groupBy(F.col(key).alias("__key"), F.col(file).alias("__file")).agg(F.count("*").alias("__n"))
    before = F.sum("__n").over(Window.partitionBy("__key").orderBy("__file").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("__key", "__file", F.coalesce(before, F.lit(0)).alias("__before"))
    joined = records.join(offsets, F.col(key).eqNullSafe(F.col("__key")) & F.col(file).eqNullSafe(F.col("__file")))
    return joined.withColumn("record", F.col("__before") + F.col(own)).drop("__key", "__file", "__before")


def archive_records(archives: DataFrame, key: str = "path", content: str = "content", chunk: int = 1 << 20) -> DataFrame:
    """One row (key, record, value) for each game of compressed or plain archives, one archive a row of ``archives``.

    An archive is unpacked as a stream: a task holds its compressed bytes, what a sixteenth of ``chunk`` of them
    unpacks to and the game being read, whatever the size of the text. What is left of a chunk after its last complete game is carried to the next. zstandard (of
    any number of frames) and gzip are told by their first bytes. Bytes that aren't UTF-8 are skipped; text before the
    first game is dropped; an empty or null archive has no games; a damaged archive fails the job.
    """

    def work(batches):
        import codecs
        import io
        import zlib
        from itertools import chain

        import pyarrow as pa

        def chunks(data):
            if data[:4] == b"\x28\xb5\x2f\xfd":
                import zstandard

                rest, step = data, max(1, chunk >> 4)
                while rest:
                    one, at = zstandard.ZstdDecompressor().decompressobj(), 0
                    while not one.eof:
                        if at >= len(rest):
                            raise ValueError("a zstd archive ends within its data")
                        yield one.decompress(rest[at : at + step])
                        at += step
                    rest = one.unused_data + rest[at:]
            elif data[:2] == b"\x1f\x8b":
                rest = data
                while rest:
                    one = zlib.decompressobj(31)
                    while not one.eof:
                        part = one.decompress(rest, chunk)
                        if not part and not one.unconsumed_tail and not one.eof:
                            raise ValueError("a gzip archive ends within its data")
                        yield part
                        rest = one.unconsumed_tail
                    rest = one.unused_data
            else:
                for i in range(0, len(data), chunk):
                    yield data[i : i + chunk]

        def records(data):
            decoder = codecs.getincrementaldecoder("utf-8-sig")("ignore")
            # ``carry`` is the game being read, without its mark; before the first game, the end of what is dropped.
            carry, begun = "\n", False
            for part in chain(map(decoder.decode, chunks(data)), [None]):
                *complete, carry = (carry + (decoder.decode(b"", True) if part is None else part)).split(f"\n{MARK}")
                for value in complete:
                    if begun:
                        yield f"{MARK}{value}\n"
                    begun = True
                if not begun:
                    carry = carry[-len(MARK) :]
            if begun:
                yield MARK + carry

        def batch(rows):
            keys, numbers, values = zip(*rows, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(numbers, pa.int64()), pa.array(values, pa.string())], [key, "record", "value"])

        for given in batches:
            for name, data in zip(given.column(0).to_pylist(), given.column(1).to_pylist(), strict=True):
                held, size = [], 0
                for number, value in enumerate(records(data or b"")):
                    held.append((name, number, value))
                    size += len(value)
                    if size >= 4 * chunk:
                        yield batch(held)
                        held, size = [], 0
                if held:
                    yield batch(held)

    return archives.select(F.col(key).cast("string").alias(key), content).mapInArrow(work, f"`{key}` string, record long, value string")


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """The games (path, record, value) of archive files, one task a file; Spark reads files of up to 2 GB in this way."""
    return archive_records(spark.read.format("binaryFile").load(path).select("path", "content"))


def compact_plan(records: DataFrame, key: str, order: str, size: str, most_bytes: int = 120_000_000, rows: int = 4096) -> DataFrame:
    """``records`` with the number of the piece that each goes to, counted for each ``key``.

    A record goes to the piece in whose ``most_bytes`` it begins, so pieces are cut between records and are longer by
    less than one record. Records are numbered by ``order`` (0.. or any whole numbers); ``rows`` numbers make a
    bucket. Running sums are taken in buckets, and over buckets from their totals, so no task holds a whole key.
    """
    bucketed_ = records.withColumn("__bucket", F.floor(F.col(order) / rows))
    before = lambda w: F.coalesce(F.sum("__size").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    totals = bucketed_.groupBy(F.col(key).alias("__key"), F.col("__bucket").alias("__b")).agg(F.sum(size).alias("__size"))
    offsets = totals.withColumn("__offset", before(Window.partitionBy("__key").orderBy("__b"))).drop("__size")
    inside = Window.partitionBy(key, "__bucket").orderBy(order)
    placed = bucketed_.withColumn("__size", F.col(size)).withColumn("__own", before(inside))
    joined = placed.join(offsets, F.col(key).eqNullSafe(F.col("__key")) & F.col("__bucket").eqNullSafe(F.col("__b")))
    piece = F.floor((F.col("__offset") + F.col("__own")) / most_bytes).cast("int")
    return joined.withColumn("piece", piece).drop("__bucket", "__size", "__own", "__offset", "__key", "__b")


def write_pieces(planned: DataFrame, path: str, key: str, order: str, text_col: str = "value") -> None:
    """Writes the text of ``planned`` (see ``compact_plan``) under ``path``, one ordered file for each piece.

    A piece is dealt to one task, which writes it row by row. Every record ends with one line feed, which it has
    already or is given.
    """
    rows = planned.select(key, "piece", order, F.regexp_replace(text_col, r"\n\z", "").alias("value"))
    ordered = rows.repartition(key, "piece").sortWithinPartitions(key, "piece", order)
    ordered.select(key, "piece", "value").write.partitionBy(key, "piece").mode("overwrite").text(path)


def write_judged(judged: DataFrame, path: str, *keep: str) -> dict[str, int]:
    """Clean games and rejects in one pass: folders by reason ("clean" for none), and the number of rows of each.

    The input is read once; the counts are observed on the way to the files, which are of even size.
    """
    seen = Observation()
    rows = sorted_games(judged, *keep).observe(seen, *(F.count_if(F.col("Reason") == r).alias(r) for r in (CLEAN, *REASONS)))
    rows.hint("rebalance", "Reason").write.partitionBy("Reason").mode("overwrite").parquet(path)
    return seen.get


def write_positions(positions: DataFrame, name: str, buckets: int = 64, state: str = STATE, path: str | None = None) -> None:
    """Positions as a table that is bucketed and sorted by state, so statistics by state and choice don't shuffle rows.

    A state's rows are in one bucket and their combining is one task's work: choose this layout when no state holds
    more rows than a task should read, and ``write_balanced`` (whose statistics combine before a shuffle) otherwise.
    Without ``path`` the table lies in the warehouse.
    """
    writer = positions.write.bucketBy(buckets, state).sortBy(state).mode("overwrite")
    (writer.option("path", path) if path else writer).saveAsTable(name)


def write_balanced(df: DataFrame, path: str, most_rows: int = 0) -> None:
    """``df`` as Parquet in files of even size, of at most ``most_rows`` rows if that is given."""
    writer = df.hint("rebalance").write.mode("overwrite")
    (writer.option("maxRecordsPerFile", most_rows) if most_rows else writer).parquet(path)


def write_tensors(df: DataFrame, path: str, most_rows: int = 40_000) -> None:
    """Rows of about 3 KB, so that a file has some 128 MB."""
    write_balanced(df, path, most_rows)


def write_counted(df: DataFrame, path: str) -> int:
    """Writes ``df`` and returns its row count, from the same pass."""
    seen = Observation()
    write_balanced(df.observe(seen, F.count(F.lit(1)).alias("rows")), path)
    return seen.get["rows"]


def write_profile(documents: DataFrame, path: str, buckets: int = 64, key: str = "_id") -> None:
    """A profile in folders by a hash of its key, so that an upsert rewrites only what it touches."""
    bucketed(documents, buckets, key).write.partitionBy("bucket").mode("overwrite").parquet(path)


def bucketed(documents: DataFrame, buckets: int, key: str) -> DataFrame:
    return documents.withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")).repartition("bucket")


def upsert_profile(spark: SparkSession, path: str, delta: DataFrame, order_by: str, buckets: int = 64, key: str = "_id") -> None:
    """Upserts ``delta`` into the profile at ``path``: the buckets it touches are rewritten, staged beside the profile.

    The staged copy is read back before any bucket is replaced, so the profile is never read while it is written.
    """
    delta = bucketed(delta, buckets, key)
    touched = [r.bucket for r in delta.select("bucket").distinct().collect()]  # at most ``buckets`` numbers
    base = spark.read.parquet(path)
    staged = f"{path.rstrip('/')}_staged"
    merged = upsert(base.filter(F.col("bucket").isin(touched)).drop("bucket"), delta.drop("bucket"), order_by, key)
    bucketed(merged, buckets, key).write.partitionBy("bucket").mode("overwrite").parquet(staged)
    (
        spark.read.parquet(staged)
        .write.partitionBy("bucket")
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .parquet(path)
    )


def lookup_in_folders(spark: SparkSession, path: str, requests: DataFrame, buckets: int = 64, key: str = "_id") -> DataFrame:
    """``profile.lookup`` in a profile written by ``write_profile``: only the folders that requests touch are read.

    Requests get the folder number of their key, and the join on it lets Spark prune folders at run time. That needs
    requests few enough to broadcast, which is counted first; more of them touch every folder and are joined by a shuffle.
    """
    documents = spark.read.parquet(path)
    folder = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")
    # A test that every key passes; Spark prunes only for a side that is filtered.
    asked = requests.filter(F.col(key) >= "").select(key, folder.alias("bucket")).distinct()
    asked = F.broadcast(asked) if asked.limit(BROADCAST_REQUESTS + 1).count() <= BROADCAST_REQUESTS else asked
    hits = documents.join(asked, ["bucket", key]).drop("bucket")
    return requests.join(hits, key, "left").withColumn("found", F.col("total_samples").isNotNull())


def save_bucketed(documents: DataFrame, name: str, buckets: int = 64, key: str = "_id") -> None:
    """A profile as a table that is bucketed and sorted by its key: lookups by join don't shuffle it."""
    documents.write.bucketBy(buckets, key).sortBy(key).mode("overwrite").saveAsTable(name)

"""Files: reading game texts, compacting, writing and upserting."""

import random

from pyspark.sql import functions as F

from statewise.operators import profile, sequences, stats
from statewise.sources import games as sources


def test_read_game_texts(spark, tmp_path):
    one = '[Event "a"]\n[Result "1-0"]\n\n1. e4 1-0\n\n'
    (tmp_path / "x.pgn").write_bytes(b"\xef\xbb\xbf" + (one * 50).encode() + b'[Event "bad \xff"]\n\n1. d4 *\n')
    (tmp_path / "y.pgn").write_bytes(b"junk before\n" + one.replace("\n", "\r\n").encode() * 3)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    try:
        rows = sources.read_game_texts(spark, str(tmp_path)).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sum(r.path.endswith("x.pgn") for r in rows) == 51 and sum(r.path.endswith("y.pgn") for r in rows) == 3
    assert all(r.value.startswith('[Event "') for r in rows)


def test_compact_cuts_at_records(spark):
    records = spark.createDataFrame([("p", i, random.Random(i).randrange(1, 50)) for i in range(100)], "path string, record int, bytes int")
    pieces = sources.compact_plan(records, "path", "record", "bytes", 200, rows=7).groupBy("piece").agg(F.sum("bytes").alias("b")).collect()
    assert len(pieces) > 5 and max(r.b for r in pieces) < 300


def test_writes(spark, tmp_path):
    df = spark.range(100).withColumn("x", F.col("id") * 2)
    assert sources.write_counted(df, str(tmp_path / "t")) == 100
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "t")).collect())) == sorted(map(tuple, df.collect()))
    board = "rnbqkbnr/pppppppp/8/8/8/8/PPPPPPPP/RNBQKBNR w KQkq -"
    positions = spark.range(90).select(F.lit(board).alias("Position_FEN"), F.lit("e2e4").alias("Move_Played"), (F.col("id") * 50).cast("int").alias("Player_Elo"))
    sources.write_tensors(sequences.tensors(positions), str(tmp_path / "n"), 7)
    back = spark.read.parquet(str(tmp_path / "n"))
    assert back.count() == 50 and max(r["count"] for r in back.groupBy(F.input_file_name()).count().collect()) <= 7


def test_profile_upsert_rewrites_only_touched_buckets(spark, tmp_path):
    rows = spark.range(2000).selectExpr("cast(id % 40 as string) Position_FEN", "cast(id % 3 as string) Move_Played", "2100 Player_Elo", "cast(id % 2 as double) Player_Result")
    documents = profile.profile(stats.move_stats(rows))
    path = str(tmp_path / "profile")
    sources.write_profile(documents, path, 8)
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "profile").rglob("*.parquet")}
    delta = documents.filter("_id = '7'").withColumn("total_samples", F.lit(1).cast("long")).withColumn("at", F.lit(1))
    sources.upsert_profile(spark, path, delta, "at", 8)
    after = {r._id: r.total_samples for r in spark.read.parquet(path).collect()}
    assert len(after) == 40 and after["7"] == 1 and after["8"] == 50
    kept = [p for p, t in before.items() if p.exists() and p.stat().st_mtime_ns == t]
    assert len(kept) >= len(before) - 2


def test_bucketed_profile_is_not_shuffled_for_lookups(spark):
    rows = spark.range(500).selectExpr("cast(id % 40 as string) Position_FEN", "'m' Move_Played", "2100 Player_Elo", "1.0D Player_Result")
    sources.save_bucketed(profile.profile(stats.move_stats(rows)), "looked_up", 8)
    requests = spark.range(60).selectExpr("cast(id as string) _id")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        hits = spark.table("looked_up").join(requests, "_id")
        plan = hits._jdf.queryExecution().executedPlan().toString()
        found = profile.lookup(requests, spark.table("looked_up"))
        assert found.filter("found").count() == 40 and found.count() == 60
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange") == 1 and "SelectedBucketsCount: 8 out of 8" in plan


def test_compact_cuts_records_out_of_the_files_of_a_key(spark, tmp_path):
    import duckdb

    from statewise.queries import QUERIES, SQL

    customers = spark.range(1, 400).selectExpr("id c_custkey", "cast(if(id % 5 = 4, null, id % 3) as int) c_nationkey")
    orders = spark.range(6000).selectExpr("id o_orderkey", "id % 390 o_custkey", "timestamp_seconds(id * 1000) o_orderdate")
    customers.write.parquet(str(tmp_path / "customer.parquet"))
    orders.write.parquet(str(tmp_path / "orders.parquet"))
    db = duckdb.connect()
    for t in ("customer", "orders"):
        db.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tmp_path}/{t}.parquet/*.parquet')")
    got = QUERIES["src_compact"](spark, str(tmp_path))
    assert got.columns == ["c_nationkey", "record", "piece"]
    rows = sorted(map(tuple, got.collect()), key=str)
    assert rows == sorted(db.sql(SQL["src_compact"]).fetchall(), key=str) and len(rows) == 389 and max(r[2] for r in rows) > 2


def test_records_are_numbered_over_files(spark):
    files = [(k, f, i) for k in ("a", None) for f, n in ((0, 3), (4, 1), (None, 2)) for i in range(n)]
    got = sources.numbered_records(spark.createDataFrame(files, "k string, f int, i int"), "k", "f", "i")
    for k in ("a", None):
        assert sorted((r.f is not None, r.f or 0, r.i, r.record) for r in got.collect() if r.k == k) == [
            (False, 0, 0, 0), (False, 0, 1, 1), (True, 0, 0, 2), (True, 0, 1, 3), (True, 0, 2, 4), (True, 4, 0, 5),
        ]

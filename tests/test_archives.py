"""Archives, pieces, sorted games, laid-out tables and pruned lookups: what only files show."""

import gzip
import random
from collections import Counter

import pytest
import zstandard
from pyspark.sql import functions as F

from statewise.functions import games as g
from statewise.operators import game_filter, profile, sequences, stats
from statewise.sources import games as sources


def game(i, size=3):
    return f'[Event "{i}"]\n[Result "1-0"]\n\n{" ".join(f"{n}. e4 é" for n in range(size))} 1-0\n\n'


def frames(data, n):
    step = -(-len(data) // n) or 1
    return b"".join(zstandard.ZstdCompressor().compress(data[i : i + step]) for i in range(0, len(data), step))


@pytest.mark.parametrize("chunk", [1, 7, 64, 1 << 20])
def test_archives_equal_plain_text(spark, chunk):
    games = [game(i, random.Random(i).randrange(0, 9)) for i in range(12)]
    text = "".join(games).encode()
    bad = b"\xef\xbb\xbfjunk [Event \n" + text.replace("é".encode(), b"\xff\xc3\xa9")
    archives = {
        "plain": text, "bad": bad, "zst": frames(text, 1), "frames": frames(bad, 5), "gz": gzip.compress(text), "members": gzip.compress(bad[:50]) + gzip.compress(bad[50:]),
        "crlf": text.replace(b"\n", b"\r\n"), "empty": b"", "null": None, "none": b"no game here", "one": games[0].encode().rstrip(b"\n"),
    }
    rows = spark.createDataFrame([(k, bytearray(v) if v is not None else None, 1) for k, v in archives.items()], "path string, content binary, record int")
    got = {}
    for r in sources.archive_records(rows, chunk=chunk).orderBy("path", "record").collect():
        got.setdefault(r.path, []).append(r.value)
    for name in ("plain", "bad", "zst", "frames", "gz", "members"):
        assert got[name] == games, name
    assert got["crlf"] == [x.replace("\n", "\r\n") for x in games] and got["one"] == [games[0].rstrip("\n")]
    assert set(got) == {"plain", "bad", "zst", "frames", "gz", "members", "crlf", "one"}


def test_damaged_archive_fails(spark):
    for data in (frames(game(1).encode() * 99, 1)[:-20], gzip.compress(game(1).encode() * 99)[:-20]):
        rows = spark.createDataFrame([("x", bytearray(data))], "path string, content binary")
        with pytest.raises(Exception, match="archive ends within its data"):
            sources.archive_records(rows).collect()


def test_read_archives_and_write_pieces(spark, tmp_path):
    games = {f"{n}.pgn.zst": [game(f"{n}/{i}", i % 7) for i in range(40)] for n in "ab"}
    (tmp_path / "in").mkdir()
    for name, texts in games.items():
        (tmp_path / "in" / name).write_bytes(frames("".join(texts).encode(), 3))
    read = sources.read_archives(spark, str(tmp_path / "in")).withColumn("path", F.substring_index("path", "/", -1))
    records = read.withColumn("bytes", F.octet_length("value"))
    planned = sources.compact_plan(records, "path", "record", "bytes", 500, rows=8)
    sources.write_pieces(planned, str(tmp_path / "out"), "path", "record")
    for name, texts in games.items():
        pieces = sorted((tmp_path / "out" / f"path={name}").iterdir(), key=lambda p: int(p.name.split("=")[1]))
        files = [[f.read_bytes().decode() for f in p.iterdir() if f.name.startswith("part-")] for p in pieces]
        assert len(pieces) > 3 and all(len(f) == 1 for f in files)
        assert "".join(f for (f,) in files) == "".join(texts)
        assert all(f.startswith("[Event ") and len(f.encode()) < 500 + 120 for (f,) in files)
    back = sources.read_game_texts(spark, str(tmp_path / "out" / "*" / "*"))
    assert back.count() == 80


def test_plan_of_pieces_equals_a_running_sum(spark):
    rng = random.Random(3)
    rows = [(k, i, rng.randrange(1, 60)) for k in ("p", None, "q") for i in range(-40, 90)]
    got = {(r.k, r.i): r.piece for r in sources.compact_plan(spark.createDataFrame(rows, "k string, i int, size int"), "k", "i", "size", 100, rows=16).collect()}
    want, at = {}, {}
    for k, i, size in rows:
        want[k, i] = at.get(k, 0) // 100
        at[k] = at.get(k, 0) + size
    assert got == want


def tasks_of(df, where):
    """Rows of each task that holds rows of ``where``, without empty ones."""
    return list(Counter(r.task for r in df.withColumn("task", F.spark_partition_id()).filter(where).collect()).values())


def test_a_hot_sequence_fills_many_tasks(spark):
    rows = spark.range(4000).selectExpr("if(id % 10 < 9, 1L, id) AS k", "id AS at", "id % 3 AS same", "cast(id % 7 as string) AS item")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plain = sequences.explode_rows(rows, "k", "at", "item", 3)
        dealt = sequences.explode_rows(rows, "k", "at", "item", 3, F.floor(F.col("at") / 100))
        assert sorted(map(str, plain.collect())) == sorted(map(str, dealt.collect()))
        assert len(tasks_of(plain, "k = 1")) == 1 and len(tasks_of(dealt, "k = 1")) == 8
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_steps_of_sparse_buckets_nulls_and_no_rows(spark):
    rows = [("a", 1, "x"), ("a", 50, None), ("a", 90, "y"), ("a", 91, "z"), (None, 3, "n"), (None, 300, "m"), ("b", 5, "q")]
    df = spark.createDataFrame(rows, "k string, at int, item string")
    bucket = F.floor(F.col("at") / 10)
    for history in (1, 2, 3):
        assert sorted(map(str, sequences.explode_rows(df, "k", "at", "item", history, bucket).collect())) == sorted(
            map(str, sequences.explode_rows(df, "k", "at", "item", history).collect())
        )
    assert sequences.explode_rows(df.limit(0), "k", "at", "item", 2, bucket).count() == 0


def test_movetext_of_any_depth(spark):
    nested = lambda n: f"({n}... a{n} {nested(n - 1) if n else ''} b{n})"
    cases = {
        f"1. e4 e5 {nested(40)} 2. Nf3 1-0": ["e4", "e5", "Nf3"],
        "1. e4 e5 (1... a (b (c (d (e f) g) h) i) j) 2. Nf3 1-0": ["e4", "e5", "Nf3"],
        "1. e4) e5 )) 2. Nf3": ["e4", "e5", "Nf3"],
        "1. e4 (1. d4 e5 2. Nf3": ["e4"],
        "(1. d4) 1. e4(1. c4)e5": ["e4", "e5"],
        "1. e4 {a ) b ( c} e5 {open (": ["e4", "e5"],
        "()": [],
        "": [],
    }
    df = spark.createDataFrame([(i, f'[Event "x"]\n\n{t}') for i, t in enumerate(cases)], "i int, t string")
    got = {r.i: r.m for r in df.select("i", g.movetext_tokens(F.col("t")).alias("m")).collect()}
    assert [got[i] for i in range(len(cases))] == list(cases.values())


def scans(df):
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def test_sorted_games_are_written_in_one_pass(spark, tmp_path):
    head = '[Event "x"]\n[WhiteElo "1800"]\n[BlackElo "1900"]\n[Result "1-0"]\n\n'
    moves = " ".join(f"e{i}" for i in range(12))
    texts = [head + moves] * 5 + [head.replace("1800", "1200") + moves] * 3 + [head + "e4"] * 2 + [None]
    spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, value string").write.parquet(str(tmp_path / "texts"))
    judged = game_filter.judged_games(game_filter.parsed_games(spark.read.parquet(str(tmp_path / "texts"))))
    counts = sources.write_judged(judged, str(tmp_path / "games"), "id")
    assert counts == {"clean": 5, "empty": 1, "variant": 0, "rating": 0, "low_rating": 3, "short": 2, "undecided": 0}
    back = spark.read.parquet(str(tmp_path / "games"))
    assert {r.Reason: r["count"] for r in back.groupBy("Reason").count().collect()} == {k: n for k, n in counts.items() if n}
    clean = back.filter("Reason = 'clean'").drop("Reason")
    assert sorted(map(str, clean.collect())) == sorted(map(str, game_filter.clean_games(judged, "id").select(clean.columns).collect()))
    assert scans(game_filter.sorted_games(judged, "id")).count("FileScan") == 1


def positions(spark, n=4000):
    return spark.range(n).selectExpr(
        "cast(id % 40 as string) Position_FEN", "cast(id % 3 as string) Move_Played", "cast(2100 - id % 500 as int) Player_Elo", "cast(id % 2 as double) Player_Result"
    )


def test_statistics_of_laid_out_positions_are_not_shuffled(spark):
    rows = positions(spark)
    sources.write_positions(rows, "laid_out", 8)
    laid = spark.table("laid_out")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for make in (stats.choice_cells, lambda r: stats.choice_share(stats.choice_cells(r)), lambda r: profile.profile(stats.move_stats(r))):
            assert "Exchange" not in scans(make(laid)).replace("ReusedExchange", "")
            assert sorted(map(str, make(laid).collect())) == sorted(map(str, make(rows).collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_statistics_written_and_read_again(spark, tmp_path):
    made = stats.move_stats(positions(spark))
    sources.write_balanced(made, str(tmp_path / "stats"))
    back = spark.read.parquet(str(tmp_path / "stats"))
    assert back.schema.names == made.schema.names and sorted(map(str, back.collect())) == sorted(map(str, made.collect()))
    assert sorted(map(str, profile.profile(back).collect())) == sorted(map(str, profile.profile(made).collect()))


def test_lookups_read_only_touched_folders(spark, tmp_path):
    documents = profile.profile(stats.move_stats(positions(spark)))
    path = str(tmp_path / "profile")
    sources.write_profile(documents, path, 16)
    requests = spark.createDataFrame([("7",), ("9",), ("9",), ("absent",), (None,)], "_id string")
    found = sources.lookup_in_folders(spark, path, requests, 16)
    want = profile.lookup(requests, documents)
    assert sorted(map(str, found.select(sorted(found.columns)).collect())) == sorted(map(str, want.select(sorted(want.columns)).collect()))
    found.collect()
    assert "dynamicpruning" in found._jdf.queryExecution().executedPlan().toString().lower()
    scan = [n for n in _nodes(found) if n.nodeName().startswith("Scan parquet")]
    files = sum(n.metrics().apply("numFiles").value() for n in scan)
    assert 0 < files <= 3  # of 16


def _nodes(df):
    out, left = [], [df._jdf.queryExecution().executedPlan()]
    while left:
        node = left.pop()
        out.append(node)
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            left.append(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            left.append(node.plan())
        else:
            children = node.children()
            left += [children.apply(i) for i in range(children.size())]
    return out

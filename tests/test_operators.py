"""Worked cases, and properties that hold for any rows."""

import math

import pytest
from pyspark.sql import functions as F

from statewise.functions import games as g
from statewise.operators import game_filter, policy, profile, sequences, stats

ROWS = "Position_FEN string, Move_Played string, Player_Elo int, Player_Result double"


def rows_of(spark, *groups):
    return spark.createDataFrame([r for n, r in groups for _ in range(n)], ROWS)


def test_worked_rates(spark):
    df = rows_of(
        spark,
        (15, ("a", "x", 1500, 1.0)),
        (5, ("a", "x", 1500, 0.0)),
        (9, ("b", "y", 2000, 1.0)),
        (10, ("c", "z", None, 1.0)),
        (1, ("c", "rare", 1200, None)),
        (3, (None, "x", 1500, 1.0)),
    )
    got = {(r.Position_FEN, r.Move_Played): r for r in stats.move_stats(df).collect()}
    assert set(got) == {("a", "x"), ("b", "y"), ("c", "z")}  # a choice without outcomes has share 0
    a, b, c = got["a", "x"], got["b", "y"], got["c", "z"]
    assert a.Win_Probability == 20 / 30 and a.Expert_Wins is None and a.Expert_Games == 0
    assert "66.7%" in a.Explanation and a.Explanation.endswith("Limited data at expert levels.")
    assert b.Expert_WP is None and b.Expert_Games == 9
    assert c.Expert_WP == 0.75 and c.Explanation.endswith("Experts win with this 75.0% of the time.")
    assert c.Total_Samples == 11 and c.Frequency == 10  # all rows count for the state, also those without outcome


def test_floors_and_ties(spark):
    df = rows_of(spark, (198, ("s", "m", 1999, 0.0)), (1, ("s", "n", 1999, 1.0)), (1, ("s", "l", 1999, 1.0)), (2, ("t", "q", 1, 1.0)), (2, ("t", "p", 1, 1.0)))
    documents = {r._id: r.recommendations for r in profile.profile(stats.move_stats(df)).collect()}
    assert documents["s"].most_popular.move == "m" and documents["s"].highest_success.move == "m"  # 1 of 200 may be shown, not win
    assert documents["t"].most_popular.move == "p" and documents["t"].pro_choice is None


def test_blended_and_buckets(spark):
    assert spark.range(1).select(g.blended(F.lit(0.5), F.lit(1500), F.lit(1.0))).first()[0] == pytest.approx(0.6)
    ratings = spark.createDataFrame([(x,) for x in (1199, 1200, 1599, 1600, 1999, 2000, None)], "r int")
    assert [r[0] for r in ratings.select(g.rating_bucket(F.col("r"))).collect()] == [
        "Novice", "Intermediate", "Intermediate", "Advanced", "Advanced", "Expert", "Expert",
    ]


@pytest.mark.parametrize("parts", [1, 5])
def test_shares_add_up_however_rows_are_dealt(spark, parts):
    df = spark.range(1000).selectExpr("cast(id % 7 as string) Position_FEN", "cast(id % 31 as string) Move_Played", "cast(id as int) Player_Elo", "cast(id % 3 / 2 as double) Player_Result")
    shares = stats.choice_share(stats.choice_cells(df.repartition(parts))).groupBy("Position_FEN").agg(F.sum("Popularity_Dec").alias("s"))
    assert all(math.isclose(r.s, 1.0) for r in shares.collect())


def plan(df):
    """The plan that ran."""
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def lines(spark):
    return spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").selectExpr(
        "cast(l_suppkey as string) Position_FEN", "l_linestatus Move_Played", "cast(l_partkey as int) Player_Elo", "l_quantity Player_Result"
    )


def test_profile_plan_has_neither_python_nor_windows(spark):
    text = plan(profile.profile(stats.move_stats(lines(spark))))
    assert not any(word in text for word in ("Python", "Window", "Cartesian", "NestedLoop"))


def test_totals_share_the_aggregate_of_raw_rows(spark):
    text = plan(stats.choice_share(stats.choice_cells(lines(spark))))
    assert text.count("FileScan") == 1 and "ReusedExchange" in text


def test_expert_filter_reaches_the_scan(spark, tmp_path):
    lines(spark).write.parquet(str(tmp_path / "p"))
    text = plan(sequences.expert_rows(spark.read.parquet(str(tmp_path / "p"))).select("Move_Played"))
    assert "GreaterThanOrEqual(Player_Elo,2000)" in text and "ReadSchema: struct<Move_Played:string,Player_Elo:int>" in text


def game(elo="1500", moves=10, result="1-0", extra="", nl="\n"):
    text = " ".join(f"{i // 2 + 1}. e{i}" if i % 2 == 0 else f"e{i}" for i in range(moves))
    return nl.join(['[Event "x"]', f'[WhiteElo "{elo}"]', '[BlackElo "1600"]', f'[Result "{result}"]', extra, "", f"{text} {result}", ""]).replace(nl * 3, nl * 2)


CASES = [
    ("ok", game(), None),
    ("low", game("1499"), "low_rating"),
    ("unknown", game("?"), "rating"),
    ("odd", game("1500?"), "rating"),
    ("padded", game(" 1500 "), None),
    ("signed", game("+1500"), None),
    ("short", game(moves=9), "short"),
    ("open", game(result="*"), "undecided"),
    ("draw", game(result="1/2-1/2"), None),
    ("variant", game(extra='[Variant "Crazyhouse"]'), "variant"),
    ("twice", game(extra='[ECO "A00"]\n[ECO "B01"]'), None),
    ("crlf", game(nl="\r\n"), None),
    ("blank", " ", "empty"),
    ("null", None, "empty"),
]


def test_game_cases(spark):
    judged = game_filter.judged_games(game_filter.parsed_games(spark.createDataFrame([c[:2] for c in CASES], "name string, value string")))
    assert {r.name: r.Reason for r in judged.collect()} == {n: r for n, _, r in CASES}
    clean = {r.name: r for r in game_filter.clean_games(judged, "name").collect()}
    assert clean["ok"].ECO == "???" and clean["twice"].ECO == "B01" and clean["draw"].Result_Num == 0.5
    assert clean["ok"].Move_List == clean["crlf"].Move_List and clean["ok"].Position_FEN == g.START
    assert game_filter.rejected_games(judged, "name").count() + len(clean) == len(CASES)


def test_movetext(spark):
    text = '[Event "x"]\n\n1. e4! {a (b) [%clk 1]} e5 $1 (1... c5 (1... d5 2. c4) 2. Nf3) 2. Nf3?! ; rest\nNc6 3. O-O-O+ 1-0'
    assert spark.range(1).select(g.movetext_tokens(F.lit(text))).first()[0] == ["e4", "e5", "Nf3", "Nc6", "O-O-O+"]


def test_steps(spark):
    games = [(1, None, 1600, 1700, 1.0, "e2e4  e7e5"), (2, "8/8 b - - 0 1", 1600, 1700, 1.0, "a1a2 b1b2 0000 c1c2"), (3, "", 1, 2, None, "")]
    df = spark.createDataFrame(games, "id long, Position_FEN string, White_Elo int, Black_Elo int, Result_Num double, Move_List string")
    got = [tuple(r) for r in sequences.explode_moves(df, "id").orderBy("id", "ply").collect()]
    start = " ".join(g.START.split()[:4])
    assert got == [
        (1, start, "e2e4", 1600, 1.0, 0),
        (1, f"{start} e2e4", "e7e5", 1700, 0.0, 1),
        (2, "8/8 b - -", "a1a2", 1700, 0.0, 0),
        (2, "8/8 b - - a1a2", "b1b2", 1600, 1.0, 1),
        (2, "8/8 b - - a1a2 b1b2", "0000", 1700, 0.0, 2),
    ]


def test_encoding(spark):
    moves = spark.createDataFrame([(m,) for m in ("e2e4", "e7e8q", "e1g1", "0000", "i2e4", "e9e4", "", None)], "m string")
    assert [r[0] for r in moves.select(g.move_index(F.col("m"))).collect()] == [796, 3388, 262, None, None, None, None, None]
    flat, two, bad = (spark.range(1).select(g.onehot_planes(F.lit(s))).first()[0] for s in (g.START, "8/8/8/8/8/8/8/K6k w - -", "9/8 w"))
    assert len(flat) == 768 and sum(flat) == 32 and flat[380] == 1 and flat[708] == 1 and sum(two) == 2 and bad is None
    cube = spark.range(1).select(g.reshape_planes(g.onehot_planes(F.lit(g.START)))).first()[0]
    assert [x for p in cube for r in p for x in r] == flat and len(cube) == 12 and len(cube[0]) == 8


def test_masked_policy(spark):
    rows = [("k", 0, "a", 1.0), ("k", 1, "b", 1.0), ("k", 2, "c", 0.0), ("p", 0, "q", 2.0), ("p", 1, "r", 2.0), ("p", 2, "s", 2.0), ("p", 3, "t", 2.0)]
    got = {r._id: r for r in policy.masked_policy(spark.createDataFrame(rows, "_id string, ordinal int, choice string, logit double")).collect()}
    assert got["k"].move == "a" and got["k"].confidence == pytest.approx(math.e / (2 * math.e + 1))
    assert got["p"].move == "q" and got["p"].confidence == pytest.approx(0.25)


def test_answers(spark):
    df = rows_of(spark, (20, ("a b c d", "x", 2100, 1.0)))
    documents = profile.profile(stats.move_stats(df))
    requests = spark.createDataFrame([(" a b c d 0 1",), ("z z z z",), ("n n n n",)], "fen string")
    ai = spark.createDataFrame([("z z z z", "m", 0.1225)], "_id string, move string, confidence double")
    answered, unknown = profile.answers(requests, documents, ai)
    got = {r.fen: r for r in answered.collect()}
    assert got["a b c d"].deep_learning_ai is None and got["a b c d"].total_historical_samples == 20
    assert got["z z z z"].big_data_stats is None and got["z z z z"].total_historical_samples == 0
    assert "12.2%" in got["z z z z"].deep_learning_ai.explanation
    assert [r.fen for r in unknown.collect()] == ["n n n n"]
    assert profile.answers(requests, documents)[1].count() == 2


def test_upsert_last_wins(spark):
    base = spark.createDataFrame([("a", 1), ("b", 2)], "_id string, v int")
    delta = spark.createDataFrame([("b", 3, 1), ("b", 4, 2), ("c", 5, 1)], "_id string, v int, at int")
    assert sorted(map(tuple, profile.upsert(base, delta, "at").collect())) == [("a", 1), ("b", 4), ("c", 5)]


def test_boards_are_dealt_by_rows_whatever_their_files(spark, tmp_path, monkeypatch):
    from statewise import queries

    orders = spark.range(3000).selectExpr("id o_orderkey", "if(id % 9 = 0, null, id % 40) o_custkey", "id * 10D o_totalprice")
    orders.repartition(20).write.parquet(str(tmp_path / "orders.parquet"))
    monkeypatch.setattr(queries, "ROWS_A_TASK", 50)
    planes = queries._planes(spark, str(tmp_path))
    assert planes.rdd.getNumPartitions() == 60
    bits = planes.select("planes", g.planes_text(F.col("planes")).alias("bits")).collect()
    assert len(bits) == 3000 and all(r.bits is r.planes is None or r.bits == "".join(str(int(x)) for x in r.planes) for r in bits)
    assert sum(r.bits is None for r in bits) == 334


def test_cubes_are_dealt_by_rows(spark, tmp_path, monkeypatch):
    from statewise import queries

    flat = spark.range(1).select(F.transform(F.sequence(F.lit(0), F.lit(767)), lambda i: i.cast("float")).alias("f"))
    assert flat.select(g.reshape_planes(F.col("f"))).first()[0] == [[[float(p * 64 + r * 8 + i) for i in range(8)] for r in range(8)] for p in range(12)]
    spark.range(900).selectExpr("id o_orderkey", "id % 40 o_custkey", "id * 10D o_totalprice").repartition(20).write.parquet(str(tmp_path / "orders.parquet"))
    monkeypatch.setattr(queries, "ROWS_A_TASK", 30)
    cubes = queries.planes_reshape(spark, str(tmp_path))
    assert cubes.rdd.getNumPartitions() == 30 and cubes.filter("length(last_plane) = 64").count() == 900

"""Packed boards, tensors written, read and fitted, saved models and answers from them."""

import math
import random

import pytest
from pyspark.sql import functions as F

from statewise.functions import games as g
from statewise.operators import policy, profile, sequences, stats
from statewise.sources import games as sources

BOARDS = [g.START, "8/8/8/8/8/8/8/K6k w - -", "8/8/8/8/8/8/8/8 w", "qqqqqqqq/PPPPPPPP/8/8/1r6/8/8/7K b - - 0 1"]
BAD = ["9/8 w", "", None, "rnbqkbnr/pppppppp/8/8/8/8/PPPPPPPP/RNBQKBNX w"]


def test_packed_boards(spark):
    df = spark.createDataFrame([(b,) for b in BOARDS + BAD], "b string")
    packed = g.packed_board(F.col("b"))
    rows = df.select("b", g.onehot_planes(F.col("b")).alias("planes"), packed.alias("packed"), g.unpacked_planes(packed).alias("back"), g.set_squares(packed).alias("set")).collect()
    for r in rows:
        if r.b in BAD:
            assert r.planes is r.packed is r.back is r.set is None
        else:
            assert len(r.packed) == 32 and r.back == r.planes and [i for i, x in enumerate(r.planes) if x] == sorted(r.set)


def learnable(spark, n=1500):
    """Positions whose move follows from the board: the square of the white king, and noise."""
    rng = random.Random(5)
    rows = []
    for _ in range(n):
        king = rng.randrange(6)
        rank = "".join(rng.choice(["p", "1", "n"]) for _ in range(8))
        board = f"{rank}/8/8/8/8/8/8/{king or ''}K{7 - king or ''} w - - 0 1"
        rows.append((board, f"a1{'abcdefgh'[king]}{1 + king}", rng.choice([2100, 2500])))
    rows += [("bad", "a1a2", 2400), (BOARDS[0], "0000", 2400), (BOARDS[0], "e2e4", 1500)]
    return spark.createDataFrame(rows, "Position_FEN string, Move_Played string, Player_Elo int")


@pytest.mark.parametrize("kind", ["softmax", "bayes"])
def test_tensors_are_written_read_and_fitted(spark, tmp_path, kind):
    sources.write_balanced(sequences.packed_tensors(learnable(spark)), str(tmp_path / "tensors"))
    rows = spark.read.parquet(str(tmp_path / "tensors"))
    assert rows.count() == 1500
    fitted = policy.fit_boards(rows, kind, 30)
    assert sorted(r.label for r in fitted.labels.collect()) == list(range(6))
    out = policy.accuracy(policy.predict_boards(fitted, rows)).first()
    largest = rows.groupBy("target_move").count().agg({"count": "max"}).first()[0]
    assert out.n == 1500 and out.accuracy_percent > 90 > 100 * largest / 1500 and out.mean_loss < 1.5
    targets = {r.target_move for r in rows.select("target_move").distinct().collect()}
    assert {r.predicted_move for r in policy.predict_boards(fitted, rows).collect()} <= targets


def test_tensors_are_small_and_encoded_once(spark, tmp_path):
    positions = learnable(spark)
    assert sequences.tensors(positions).columns == ["board_tensor", "target_move"]
    joined = positions.join(spark.range(3).selectExpr("cast(2100 + 400 * id as int) Player_Elo", "id"), "Player_Elo")
    df = sequences.tensors(joined)
    df.write.format("noop").mode("overwrite").save()
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("flatten") == 1 and "flatten" not in "".join(line for line in plan.splitlines() if "Filter" in line)
    sources.write_balanced(sequences.packed_tensors(positions), str(tmp_path / "packed"))
    size = sum(f.stat().st_size for f in (tmp_path / "packed").glob("*.parquet"))
    assert size < 100 * 1500


def test_answers_from_a_saved_model(spark, tmp_path):
    fitted = policy.fit_boards(sequences.packed_tensors(learnable(spark)), "softmax", 30)
    path = str(tmp_path / "model")
    policy.save_model(fitted.table, path)
    model = policy.load_model(spark, path)
    assert sorted(map(str, model.collect())) == sorted(map(str, fitted.table.collect()))
    boards = [("k2", "8/8/8/8/8/8/8/2K5 w - -"), ("k4", "8/8/8/8/8/8/8/4K3 w - -"), ("again", "8/8/8/8/8/8/8/4K3 w - -"), ("none", "8/8/8/8/8/8/8/4K3 w - -")]
    moves = ["a1a1", "a1c3", "a1e5", "h8h7"]
    rows = [(k, i, m, b) for k, b in boards for i, m in enumerate(moves if k != "none" else moves[3:])]
    candidates = spark.createDataFrame(rows, "_id string, ordinal int, choice string, board string").select(
        "_id", "ordinal", "choice", g.packed_board(F.col("board")).alias("packed_board"), g.move_index(F.col("choice")).alias("target_move")
    )
    chosen = {r._id: r for r in policy.board_policy(model, candidates).collect()}
    assert {k: r.move for k, r in chosen.items()} == {"k2": "a1c3", "k4": "a1e5", "again": "a1e5"}  # no move of "none" was ever seen
    assert all(0.5 < r.confidence <= 1 for r in chosen.values()) and chosen["k4"].confidence == chosen["again"].confidence
    # Scores are those of the fitted classifier.
    whole = fitted.model.transform(fitted.vectors.transform(policy._named_squares(candidates.filter("_id = 'k2'").limit(1)))).first().rawPrediction
    one = fitted.table.filter("target_move = 18").first()  # a1c3
    squares = candidates.filter("_id = 'k2'").select(g.set_squares(F.col("packed_board")).alias("s")).first().s
    label = fitted.labels.filter("target_move = 18").first().label
    centred = one.bias + sum(one.weights[i] for i in squares)
    assert centred == pytest.approx(whole[int(label)])


def test_absent_model_gives_statistics_alone(spark, tmp_path):
    assert policy.load_model(spark, str(tmp_path / "nothing")) is None
    assert policy.board_policy(None, spark.range(1)) is None
    rows = spark.createDataFrame([("a b c d", "x", 2100, 1.0)] * 20, "Position_FEN string, Move_Played string, Player_Elo int, Player_Result double")
    requests = spark.createDataFrame([("a b c d 0 1",), ("z z z z",)], "fen string")
    answered, unknown = profile.answers(requests, profile.profile(stats.move_stats(rows)), policy.board_policy(None, requests))
    assert answered.first().deep_learning_ai is None and unknown.count() == 1
    shown = profile.answer_view(answered).orderBy("place").collect()
    assert [(r.place, r.title, r.percent, r.label) for r in shown] == [
        (1, "The Standard Path", "83%", "SUCCESS"), (2, "The Statistical Edge", "83%", "SUCCESS"), (3, "The Master's Secret", "83%", "SUCCESS"),
    ]


def test_view_of_a_classifiers_answer(spark):
    rows = spark.createDataFrame([("a b c d", "x", 2100, 1.0)] * 20, "Position_FEN string, Move_Played string, Player_Elo int, Player_Result double")
    ai = spark.createDataFrame([("z z z z", "m", 0.1225), ("a b c d", "x", 0.5)], "_id string, move string, confidence double")
    requests = spark.createDataFrame([("a b c d",), ("z z z z",)], "fen string")
    answered, _ = profile.answers(requests, profile.profile(stats.move_stats(rows)), ai)
    shown = {(r.fen, r.place): (r.title, r.move, r.percent, r.label) for r in profile.answer_view(answered).collect()}
    assert shown["z z z z", 0] == ("Deep Learning AI", "m", "12.3%", "CONFIDENCE") and ("z z z z", 1) not in shown
    assert shown["a b c d", 0][2] == "50.0%" and len(shown) == 5


def test_squares_are_counted_by_target_before_the_shuffle(spark):
    texts = spark.createDataFrame([(b, t) for t in (5, 700, None) for b in BOARDS[:3] * t_times(t) + [None]], "b string, target_move int")
    rows = texts.select(g.packed_board(F.col("b")).alias("packed_board"), "target_move")
    got = {r.target_move: r for r in policy.square_counts(rows.repartition(3)).collect()}
    assert {k: r.n for k, r in got.items()} == {5: 6, 700: 9}
    want = [sum(x) for x in zip(*(r.p for r in texts.filter("target_move = 5 AND b IS NOT NULL").select(g.onehot_planes(F.col("b")).alias("p")).collect()), strict=True)]
    assert got[5].squares == want and sum(got[700].squares) == 3 * (32 + 2)
    # Rows without a board have no prediction, rows of an unseen target no loss.
    fitted = policy.fit_boards(rows, "bayes")
    seen = policy.predict_boards(fitted, rows.unionByName(rows.limit(1).withColumn("target_move", F.lit(9))), most=2).collect()
    assert all((r.packed_board is None) == (r.predicted_move is None) for r in seen)
    whole = {bytes(r.packed_board): r.probability for r in fitted.model.transform(fitted.vectors.transform(policy._named_squares(rows.filter("packed_board IS NOT NULL")))).collect()}
    for r in seen:
        known = r.packed_board is not None and r.target_move in (5, 700)
        assert (r.loss is not None) == known
        if known:
            assert r.loss == pytest.approx(-math.log(whole[bytes(r.packed_board)][(5, 700).index(r.target_move)]))


def t_times(target):
    return {5: 2, 700: 3}.get(target, 1)


def test_candidates_are_scored_where_they_stand(spark):
    fitted = policy.fit_boards(sequences.packed_tensors(learnable(spark, 200)), "bayes")
    rows = spark.createDataFrame([(k, i, m, b) for k in ("a", "b") for b in BOARDS[:2] + BAD[:1] for i, m in enumerate(["a1a1", "h8h7", "a1c3"])], "_id string, ordinal int, choice string, board string")
    candidates = rows.select("_id", "ordinal", "choice", g.packed_board(F.col("board")).alias("packed_board"), g.move_index(F.col("choice")).alias("target_move"))
    chosen = policy.board_policy(fitted.table, candidates)
    plan = chosen._jdf.queryExecution().executedPlan().toString()
    assert not any("packed_board" in line for line in plan.splitlines() if "hashpartitioning" in line)
    assert sorted(r._id for r in chosen.collect()) == ["a", "b"] and {r.move for r in chosen.collect()} <= {"a1a1", "a1c3"}

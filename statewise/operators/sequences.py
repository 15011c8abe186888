"""One row for every step of a game or any ordered sequence, as the one who moves sees it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statewise.functions import games as g


def explode_moves(games: DataFrame, *keep: str, history: int = 2) -> DataFrame:
    """A row for each move of Move_List: Position_FEN, Move_Played, Player_Elo, Player_Result, ply.

    The state of a step is the key of the start state with the ``history`` moves before the step, so it has a fixed
    size however long the game is. Empty tokens are skipped; the first move that isn't one ends the game and is its
    last row. Each row's own array is exploded: nothing is shuffled.
    """
    moves = F.filter(F.split(F.coalesce("Move_List", F.lit("")), " "), lambda m: m != "")
    bad = F.array_position(F.transform("moves", lambda m: m.rlike(f"{g.MOVE}[qrbn]?$")), False)
    start = F.coalesce(F.nullif(F.col("Position_FEN"), F.lit("")), F.lit(g.START))
    first_side = F.coalesce(F.get(F.split("start", " "), F.lit(1)), F.lit("w"))
    return (
        games.select(*keep, start.alias("start"), "White_Elo", "Black_Elo", "Result_Num", moves.alias("moves"))
        .withColumn("moves", F.when(bad > 0, F.slice("moves", F.lit(1), bad.cast("int"))).otherwise(F.col("moves")))
        .select("*", F.posexplode("moves").alias("ply", "move"))
        .withColumn("white", (F.col("ply") % 2 == 0) == (first_side != "b"))
        .withColumn("from", F.greatest(F.lit(1), F.col("ply") - (history - 1)))
        .select(
            *keep,
            F.array_join(
                F.concat(F.array(g.state_key(F.col("start"))), F.slice("moves", F.col("from"), F.col("ply") + 1 - F.col("from"))),
                " ",
            ).alias("Position_FEN"),
            F.col("move").alias("Move_Played"),
            g.mover_rating(F.col("white"), F.col("White_Elo"), F.col("Black_Elo")).alias("Player_Elo"),
            g.mover_outcome(F.col("white"), F.col("Result_Num")).alias("Player_Result"),
            "ply",
        )
    )


def explode_rows(rows: DataFrame, key: str, order: str | list[str], item: str, history: int = 2, bucket: Column | None = None) -> DataFrame:
    """The same for sequences of one row per step: state is the ``history`` items before, joined; null for the first.

    ``order`` must tell apart the rows of a key. With ``bucket``, an expression that never falls along ``order`` (a
    day, a range of numbers), rows are dealt by key and bucket, so a key of any length fills many tasks. A bucket's
    last items are carried to the buckets after it: one row for each bucket is all that is dealt by key alone.

    Null items are no part of a state; a null key is a key; rows of a null bucket stand first.
    """
    order = [order] if isinstance(order, str) else list(order)
    columns = [key, *order]
    if bucket is None:
        w = Window.partitionBy(key).orderBy(*order)
        before = F.array(*(F.lag(item, n).over(w) for n in range(history, 0, -1)))
        return _stepped(rows.select(*columns, F.array_compact(before).alias("b"), F.col(item).alias("Move_Played")), columns)
    dealt = rows.select(*columns, F.col(item).alias("Move_Played"), bucket.alias("__bucket"))
    inside = Window.partitionBy(key, "__bucket")
    up, down = inside.orderBy(*order), inside.orderBy(*(F.desc(c) for c in order))
    lags = F.array(*(F.struct((F.col("__n") > n).alias("there"), F.lag("Move_Played", n).over(up).alias("item")) for n in range(history, 0, -1)))
    seen = dealt.withColumn("__n", F.row_number().over(up)).withColumn("__lags", lags)
    # The last items of each bucket, at most ``history``, and from them those before each bucket. A bucket has at
    # least one item, so the ``history`` buckets before it are enough.
    tails = (
        dealt.withColumn("__n", F.row_number().over(down))
        .filter(F.col("__n") <= history)
        .groupBy(key, "__bucket")
        .agg(F.transform(F.sort_array(F.collect_list(F.struct((-F.col("__n")).alias("n"), F.col("Move_Played").alias("item")))), lambda r: r.item).alias("tail"))
    )
    over = Window.partitionBy(key).orderBy("__bucket")
    parts = [F.coalesce(F.lag("tail", n).over(over), F.array().cast("array<string>")) for n in range(history, 0, -1)]
    carried = tails.select(F.col(key).alias("__key"), F.col("__bucket").alias("__b"), F.concat(*parts).alias("__carried"))
    joined = seen.join(carried, F.col(key).eqNullSafe(F.col("__key")) & F.col("__bucket").eqNullSafe(F.col("__b")), "left")
    own = F.transform(F.filter("__lags", lambda x: x.there), lambda x: x.item)
    # The last ``history`` of what came before the bucket and within it.
    every = F.concat(F.coalesce("__carried", F.array().cast("array<string>")), own)
    last = F.slice(every, F.greatest(F.lit(1), F.size(every) - (history - 1)), history)
    return _stepped(joined.select(*columns, F.array_compact(last).alias("b"), "Move_Played"), columns)


def _stepped(rows: DataFrame, columns: list[str]) -> DataFrame:
    return rows.select(*columns, F.nullif(F.array_join("b", " "), F.lit("")).alias("Position_FEN"), "Move_Played")


def mover_view(rows: DataFrame, first_moves: str, first_rating: str, second_rating: str, outcome: str) -> DataFrame:
    """``rows`` with Player_Elo and Player_Result of the one who moves; ``first_moves`` is a boolean column."""
    side = F.col(first_moves)
    return rows.withColumn("Player_Elo", g.mover_rating(side, F.col(first_rating), F.col(second_rating))).withColumn(
        "Player_Result", g.mover_outcome(side, F.col(outcome))
    )


def expert_rows(positions: DataFrame, least_rating: int = 2000) -> DataFrame:
    return positions.filter(F.col("Player_Elo") >= least_rating)


def packed_tensors(positions: DataFrame, least_rating: int = 2000) -> DataFrame:
    """packed_board (32 bytes) and target_move of expert rows; rows that can't be encoded are left out."""
    return (
        expert_rows(positions, least_rating)
        .filter(F.col("Move_Played").rlike(g.MOVE))
        .select(g.packed_board(F.col("Position_FEN")).alias("packed_board"), g.move_index(F.col("Move_Played")).alias("target_move"))
        .filter("packed_board IS NOT NULL")
    )


def tensors(positions: DataFrame, least_rating: int = 2000) -> DataFrame:
    """board_tensor and target_move of expert rows; rows that can't be encoded are left out."""
    return packed_tensors(positions, least_rating).select(g.unpacked_planes(F.col("packed_board")).alias("board_tensor"), "target_move")

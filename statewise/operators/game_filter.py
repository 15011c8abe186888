"""Game texts to clean rated games, and the rest with the reason why each was left out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statewise.functions import games as g

#: Reasons in the order in which they are tested.
CLEAN = "clean"
REASONS = ("empty", "variant", "rating", "low_rating", "short", "undecided")


def parsed_games(texts: DataFrame, text_col: str = "value") -> DataFrame:
    """Headers and moves of each game text; other columns are kept."""
    t = F.col(text_col)
    return texts.select(
        *[c for c in texts.columns if c != text_col],
        g.header(t, "Variant", "Standard").alias("Variant"),
        g.header(t, "WhiteElo", "?").alias("White_Text"),
        g.header(t, "BlackElo", "?").alias("Black_Text"),
        g.header(t, "Result", "*").alias("Result_Str"),
        g.header(t, "ECO", "???").alias("ECO"),
        g.header(t, "FEN", "").alias("Start"),
        g.movetext_tokens(t).alias("Moves"),
        (F.trim(F.coalesce(t, F.lit(""))) == "").alias("Empty"),
    )


def judged_games(parsed: DataFrame, least_rating: int = 1500, least_moves: int = 10) -> DataFrame:
    """Parsed games with ratings, score and the first reason against each; null for a clean game."""
    rated = (
        parsed.withColumn("White_Elo", g.whole_number(F.col("White_Text")))
        .withColumn("Black_Elo", g.whole_number(F.col("Black_Text")))
        .withColumn("Result_Num", g.result_score(F.col("Result_Str")))
    )
    tests = (
        F.col("Empty"),
        F.col("Variant") != "Standard",
        F.col("White_Elo").isNull() | F.col("Black_Elo").isNull(),
        F.least("White_Elo", "Black_Elo") < least_rating,
        F.size("Moves") < least_moves,
        F.col("Result_Num").isNull(),
    )
    return rated.withColumn("Reason", F.coalesce(*(F.when(t, F.lit(r)) for t, r in zip(tests, REASONS, strict=True))))


def _game_columns(*keep: str) -> list:
    return [
        *keep,
        F.coalesce(F.nullif(F.col("Start"), F.lit("")), F.lit(g.START)).alias("Position_FEN"),
        "White_Elo",
        "Black_Elo",
        "Result_Num",
        "Result_Str",
        "ECO",
        F.array_join("Moves", " ").alias("Move_List"),
    ]


def clean_games(judged: DataFrame, *keep: str) -> DataFrame:
    """The games table, with further columns ``keep``."""
    return judged.filter("Reason IS NULL").select(*_game_columns(*keep))


def rejected_games(judged: DataFrame, *keep: str) -> DataFrame:
    return judged.filter("Reason IS NOT NULL").select(*keep, "Reason")


def sorted_games(judged: DataFrame, *keep: str) -> DataFrame:
    """All games with the columns of the games table and Reason, "clean" for those without one against them."""
    return judged.select(*_game_columns(*keep), F.coalesce("Reason", F.lit(CLEAN)).alias("Reason"))

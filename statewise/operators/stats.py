"""Choice statistics: how often each choice was made in a state, by whom, and how it turned out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statewise.functions import games as g

STATE, CHOICE, RATING, OUTCOME = "Position_FEN", "Move_Played", "Player_Elo", "Player_Result"


def choice_cells(rows: DataFrame, state=STATE, choice=CHOICE, rating=RATING, outcome=OUTCOME) -> DataFrame:
    """Sums and counts for each (state, choice); rows without a state are left out."""
    expert = g.rating_bucket(F.col(rating)) == g.TOP_BUCKET
    return (
        rows.filter(F.col(state).isNotNull())
        .groupBy(F.col(state).alias(STATE), F.col(choice).alias(CHOICE))
        .agg(
            F.count(outcome).alias("Frequency"),
            F.count("*").alias("Samples"),
            F.sum(rating).alias("Elo_Sum"),
            F.count(rating).alias("Elo_Games"),
            F.sum(outcome).alias("Total_Wins"),
            F.sum(F.when(expert, F.col(outcome))).alias("Expert_Wins"),
            F.count(F.when(expert, F.lit(1))).alias("Expert_Games"),
        )
    )


def choice_share(cells: DataFrame) -> DataFrame:
    """Cells with their state's totals. The roll-up reads every column that the cells have, so both sides of the join
    share one aggregate of the raw rows, and a state with many cells can be split."""
    sums = ("Samples", "Frequency", "Elo_Sum", "Elo_Games", "Total_Wins", "Expert_Wins", "Expert_Games")
    names = ("Total_Samples", "State_Games", "State_Elo_Sum", "State_Elo_Games", "State_Wins", "State_Expert_Wins", "State_Expert_Games")
    totals = cells.groupBy(STATE).agg(*(F.sum(c).alias(n) for c, n in zip(sums, names, strict=True)))
    return cells.join(totals, STATE).withColumn("Popularity_Dec", F.col("Frequency") / F.col("Total_Samples"))


def choice_scores(shared: DataFrame, least_expert_games: int = 10) -> DataFrame:
    """Smoothed rates, the average rating and the blended score of each cell."""
    return (
        shared.withColumn("Avg_Elo", F.col("Elo_Sum") / F.nullif(F.col("Elo_Games"), F.lit(0)))
        .withColumn("Win_Probability", g.smoothed(F.col("Total_Wins"), F.col("Frequency")))
        .withColumn(
            "Expert_WP",
            F.when(F.col("Expert_Games") >= least_expert_games, g.smoothed(F.col("Expert_Wins"), F.col("Expert_Games"))),
        )
        .withColumn("Weighted_Confidence", g.blended(F.col("Win_Probability"), F.col("Avg_Elo"), F.col("Popularity_Dec")))
    )


def stats_floor(scored: DataFrame, least_share: float = 0.005) -> DataFrame:
    return scored.filter(F.col("Popularity_Dec") >= least_share)


def explained(stats: DataFrame) -> DataFrame:
    """With the sentence and the percent text that a reader sees."""
    return stats.withColumn(
        "Explanation", g.explanation(F.col("Frequency"), F.col("Win_Probability"), F.col("Expert_WP"))
    ).withColumn("Popularity_Str", F.concat(g.percent_number(F.col("Popularity_Dec")), F.lit("%")))


def move_stats(rows: DataFrame, least_share: float = 0.005, **columns: str) -> DataFrame:
    """The whole table of statistics from rows of (state, choice, rating, outcome)."""
    return explained(stats_floor(choice_scores(choice_share(choice_cells(rows, **columns))), least_share))


def stats_sample(stats: DataFrame, part_of_state: str, n: int = 10) -> DataFrame:
    """The n best choices by blended score of states that contain a text."""
    return (
        stats.filter(F.col(STATE).contains(part_of_state))
        .orderBy(F.desc("Weighted_Confidence"), STATE, CHOICE)
        .limit(n)
        .select(STATE, CHOICE, "Popularity_Str", "Win_Probability", "Weighted_Confidence")
    )

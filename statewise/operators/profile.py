"""One document for each state with its most popular, most successful and expert choice; keyed upserts and lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statewise.functions import games as g

from .stats import CHOICE, STATE

CATEGORIES = ("most_popular", "highest_success", "pro_choice")
# The titles that readers know, in order.
TITLES = dict(zip(CATEGORIES, ("The Standard Path", "The Statistical Edge", "The Master's Secret"), strict=True))


def recommendation() -> Column:
    """A cell as the entry of a document; null without a choice."""
    return F.when(
        F.col(CHOICE).isNotNull(),
        F.struct(
            F.col(CHOICE).alias("move"),
            F.col("Win_Probability").alias("win_rate"),
            F.col("Popularity_Str").alias("popularity"),
            F.col("Avg_Elo").cast("int").alias("avg_elo"),
            F.col("Weighted_Confidence").alias("confidence_score"),
            F.col("Explanation").alias("explanation"),
        ),
    )


def _order(score: str, eligible: Column | None = None) -> Column:
    """What the best cell has least of: the score downwards, then the choice; null for cells that may not win."""
    key = F.struct((-F.col(score)).alias("score"), F.col(CHOICE).alias("choice"))
    return key if eligible is None else F.when(eligible, key)


def orders(least_share: float = 0.01) -> dict[str, Column]:
    return {
        "most_popular": _order("Popularity_Dec"),
        "highest_success": _order("Win_Probability", F.col("Popularity_Dec") >= least_share),
        "pro_choice": _order("Expert_WP", F.col("Expert_WP").isNotNull()),
    }


def top_choice(stats: DataFrame, category: str) -> DataFrame:
    """The best row of ``stats`` of each state in one category."""
    order = orders()[category]
    row = F.struct(*stats.columns)
    best = stats.filter(order.isNotNull()).groupBy(STATE).agg(F.min_by(row, order).alias("best"))
    return best.select("best.*")


def profile(stats: DataFrame, least_share: float = 0.01) -> DataFrame:
    """_id, total_samples, recommendations: all three choices in one aggregate, which combines before the shuffle."""
    best = [F.min_by(recommendation(), order).alias(name) for name, order in orders(least_share).items()]
    return (
        stats.groupBy(F.col(STATE).alias("_id"))
        .agg(F.max("Total_Samples").alias("total_samples"), *best)
        .select("_id", "total_samples", F.struct(*CATEGORIES).alias("recommendations"))
    )


def flat_profile(documents: DataFrame) -> DataFrame:
    """A profile with a column for every value."""
    fields = ("move", "win_rate", "popularity", "avg_elo", "confidence_score", "explanation")
    return documents.select(
        "_id", "total_samples", *(F.col(f"recommendations.{c}.{f}").alias(f"{c}_{f}") for c in CATEGORIES for f in fields)
    )


def display_view(documents: DataFrame) -> DataFrame:
    """A row for each recommendation that a document has, in fixed order, with its title and rounded numbers."""
    entries = F.array(
        *(
            F.struct(
                F.lit(i).alias("place"), F.lit(TITLES[c]).alias("title"), F.col(f"recommendations.{c}").alias("r")
            )
            for i, c in enumerate(CATEGORIES)
        )
    )
    return (
        documents.select("_id", F.explode(entries).alias("e"))
        .filter("e.r IS NOT NULL")
        .select(
            "_id",
            "e.place",
            "e.title",
            F.col("e.r.move").alias("move"),
            F.floor(F.col("e.r.win_rate") * 100 + 0.5).cast("int").alias("success_percent"),
        )
    )


#: The classifier's title, and what its and the others' numbers are called.
AI_TITLE, AI_LABEL, LABEL = "Deep Learning AI", "CONFIDENCE", "SUCCESS"


def answer_view(answered: DataFrame) -> DataFrame:
    """The rows that a reader of an answer sees: the classifier first, its confidence with one decimal, then the
    recommendations with whole percents; parts that an answer lacks have no row."""
    entry = lambda place, title, label, part, percent: F.when(
        F.col(part).isNotNull(),
        F.struct(F.lit(place).alias("place"), F.lit(title).alias("title"), F.col(f"{part}.move").alias("move"), percent.alias("percent"), F.lit(label).alias("label"),
                 F.col(f"{part}.explanation").alias("explanation")),
    )
    ai = F.format_string("%.1f%%", F.col("deep_learning_ai.confidence") * 100)
    entries = [entry(0, AI_TITLE, AI_LABEL, "deep_learning_ai", ai)]
    for i, c in enumerate(CATEGORIES):
        part = f"big_data_stats.{c}"
        whole = F.concat(F.floor(F.col(f"{part}.win_rate") * 100 + 0.5).cast("string"), F.lit("%"))
        entries.append(entry(i + 1, TITLES[c], LABEL, part, whole))
    rows = answered.select("fen", F.explode(F.filter(F.array(*entries), lambda e: e.isNotNull())).alias("e"))
    return rows.select("fen", "e.*")


def upsert(base: DataFrame, delta: DataFrame, order_by: str, key: str = "_id") -> DataFrame:
    """``base`` with the last row of each key of ``delta`` in the place of its own; keys only in base stay.

    Rows of both sides are compared by one aggregate on the key: a delta's row beats the base's, a later one an earlier.
    """
    columns = [c for c in base.columns if c != key]
    every = base.select(key, *columns, F.lit(0).alias("__new"), F.lit(None).cast(delta.schema[order_by].dataType).alias("__at")).unionByName(
        delta.select(key, *columns, F.lit(1).alias("__new"), F.col(order_by).alias("__at"))
    )
    last = F.max_by(F.struct(*columns), F.struct("__new", "__at")).alias("r")
    return every.groupBy(key).agg(last).select(key, *(F.col(f"r.{c}").alias(c) for c in columns))


def lookup(requests: DataFrame, documents: DataFrame, key: str = "_id") -> DataFrame:
    """Each request with what the profile has of its key. Hits are joined first, so that a small set of requests can be
    broadcast against the profile; then all requests are joined to the hits."""
    hits = documents.join(requests.select(key).distinct(), key)
    return requests.join(hits, key, "left").withColumn("found", F.col("total_samples").isNotNull())


def answers(requests: DataFrame, documents: DataFrame, policy: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Answers to requests (fen), and the requests that nothing is known of.

    ``policy`` has _id, move and confidence; without it the classifier's part is null.
    """
    keyed = requests.withColumn("_id", g.state_key(F.col("fen")))
    found = lookup(keyed, documents)
    if policy is None:
        found = found.withColumn("deep_learning_ai", F.lit(None).cast("struct<move:string,confidence:double,explanation:string>"))
    else:
        ai = policy.select(
            "_id",
            F.struct("move", "confidence", g.ai_sentence(F.col("confidence")).alias("explanation")).alias("deep_learning_ai"),
        )
        found = found.join(ai, "_id", "left")
    known = F.col("found") | F.col("deep_learning_ai").isNotNull()
    answered = found.filter(known).select(
        F.col("_id").alias("fen"),
        "deep_learning_ai",
        F.col("recommendations").alias("big_data_stats"),
        F.coalesce("total_samples", F.lit(0).cast("long")).alias("total_historical_samples"),
    )
    return answered, found.filter(~known).select("fen")

"""The queries of the engine and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import games as g
from .operators import game_filter, policy, profile, sequences, stats
from .plans import inputs
from .sources import games as sources
from .sources.scratch import scratch_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None):
    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = inputs.for_duckdb(sql)
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- statistics ---------------------------------------------------------------------------------------------------

CELLS = f"""
cells AS (
  SELECT Position_FEN, Move_Played, count(Player_Result) AS Frequency, count(*) AS Samples,
    CAST(sum(Player_Elo) AS BIGINT) AS Elo_Sum, count(Player_Elo) AS Elo_Games, sum(Player_Result) AS Total_Wins,
    sum(Player_Result) FILTER (WHERE Player_Elo >= 2000 OR Player_Elo IS NULL) AS Expert_Wins,
    count(*) FILTER (WHERE Player_Elo >= 2000 OR Player_Elo IS NULL) AS Expert_Games
  FROM ({inputs.CHOICES}) c WHERE Position_FEN IS NOT NULL GROUP BY Position_FEN, Move_Played
)"""
SCORED = f"""
WITH {CELLS}, shared AS (
  SELECT *, CAST(sum(Samples) OVER s AS BIGINT) AS Total_Samples, CAST(sum(Frequency) OVER s AS BIGINT) AS State_Games,
    sum(Total_Wins) OVER s AS State_Wins, Frequency / CAST(sum(Samples) OVER s AS DOUBLE) AS Popularity_Dec
  FROM cells WINDOW s AS (PARTITION BY Position_FEN)
), rates AS (
  SELECT *, Elo_Sum / CAST(Elo_Games AS DOUBLE) AS Avg_Elo, (Total_Wins + 5.0) / (Frequency + 10.0) AS Win_Probability,
    CASE WHEN Expert_Games >= 10 THEN (Expert_Wins + 5.0) / (Expert_Games + 10.0) END AS Expert_WP
  FROM shared
), scored AS (
  SELECT *, Win_Probability * 0.5::DOUBLE + (Avg_Elo / 3000.0) * 0.3::DOUBLE + Popularity_Dec * 0.2::DOUBLE AS Weighted_Confidence FROM rates
), floored AS (
  SELECT * FROM scored WHERE Popularity_Dec >= 0.005
), explained AS (
  SELECT *, 'Based on ' || Frequency || ' games, this move has a ' || round(Win_Probability * 100, 1) || '% global success rate. '
    || coalesce('Experts win with this ' || round(Expert_WP * 100, 1) || '% of the time.', 'Limited data at expert levels.') AS Explanation,
    round(Popularity_Dec * 100, 1) || '%' AS Popularity_Str
  FROM floored
)"""


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.load(spark, sf_dir, inputs.CHOICES)
    return stats.choice_scores(stats.choice_share(stats.choice_cells(rows)))


def _stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.explained(stats.stats_floor(_scored(spark, sf_dir)))


@query(f"WITH {CELLS} SELECT * FROM cells")
def choice_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.choice_cells(inputs.load(spark, sf_dir, inputs.CHOICES))


@query(SCORED + "SELECT Position_FEN, Move_Played, Frequency, Total_Samples, State_Games, State_Wins, Popularity_Dec FROM shared")
def choice_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    shared = stats.choice_share(stats.choice_cells(inputs.load(spark, sf_dir, inputs.CHOICES)))
    return shared.select("Position_FEN", "Move_Played", "Frequency", "Total_Samples", "State_Games", "State_Wins", "Popularity_Dec")


@query(SCORED + "SELECT Position_FEN, Move_Played, Win_Probability, Expert_WP FROM rates")
def smoothed_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(spark, sf_dir).select("Position_FEN", "Move_Played", "Win_Probability", "Expert_WP")


@query(SCORED + "SELECT Position_FEN, Move_Played, Avg_Elo, Weighted_Confidence FROM scored")
def blended_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(spark, sf_dir).select("Position_FEN", "Move_Played", "Avg_Elo", "Weighted_Confidence")


@query(SCORED + "SELECT Position_FEN, Move_Played, Frequency, Popularity_Dec FROM floored")
def stats_floor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.stats_floor(_scored(spark, sf_dir)).select("Position_FEN", "Move_Played", "Frequency", "Popularity_Dec")


@query(SCORED + "SELECT Position_FEN, Move_Played, Explanation, Popularity_Str FROM explained")
def explanation_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stats(spark, sf_dir).select("Position_FEN", "Move_Played", "Explanation", "Popularity_Str")


@query(
    SCORED
    + """SELECT Position_FEN, Move_Played, Popularity_Str, Win_Probability, Weighted_Confidence FROM explained
    WHERE contains(Position_FEN, '7') ORDER BY Weighted_Confidence DESC, Position_FEN, Move_Played LIMIT 10"""
)
def stats_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.stats_sample(_stats(spark, sf_dir), "7")


@query(
    f"""SELECT o_orderkey, rating, CASE WHEN rating < 1200 THEN 'Novice' WHEN rating < 1600 THEN 'Intermediate'
    WHEN rating < 2000 THEN 'Advanced' ELSE 'Expert' END AS bucket FROM ({inputs.BOARDS}) b"""
)
def rating_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.load(spark, sf_dir, inputs.BOARDS).select("o_orderkey", "rating", g.rating_bucket(F.col("rating")).alias("bucket"))


# --- profile ------------------------------------------------------------------------------------------------------


def _top_sql(score: str, where: str) -> str:
    return (
        SCORED
        + f""" SELECT Position_FEN, Move_Played, Frequency, {score} AS score FROM (
        SELECT *, row_number() OVER (PARTITION BY Position_FEN ORDER BY {score} DESC, Move_Played) AS n FROM explained WHERE {where}
        ) t WHERE n = 1"""
    )


def _top(spark: SparkSession, sf_dir: str, category: str, score: str) -> DataFrame:
    top = profile.top_choice(_stats(spark, sf_dir), category)
    return top.select("Position_FEN", "Move_Played", "Frequency", F.col(score).alias("score"))


@query(_top_sql("Popularity_Dec", "true"))
def top_popular(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _top(spark, sf_dir, "most_popular", "Popularity_Dec")


@query(_top_sql("Win_Probability", "Popularity_Dec >= 0.01"))
def top_success(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _top(spark, sf_dir, "highest_success", "Win_Probability")


@query(_top_sql("Expert_WP", "Expert_WP IS NOT NULL"))
def top_expert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _top(spark, sf_dir, "pro_choice", "Expert_WP")


def _best_sql(name: str, score: str, where: str) -> str:
    return f"""{name} AS (
  SELECT Position_FEN AS {name}_id, Move_Played AS {name}_move, Win_Probability AS {name}_win_rate, Popularity_Str AS {name}_popularity,
    CAST(trunc(Avg_Elo) AS INTEGER) AS {name}_avg_elo, Weighted_Confidence AS {name}_confidence_score, Explanation AS {name}_explanation
  FROM (SELECT *, row_number() OVER (PARTITION BY Position_FEN ORDER BY {score} DESC, Move_Played) AS n FROM explained WHERE {where}) t
  WHERE n = 1)"""


DOCS = f"""{SCORED}, {_best_sql("most_popular", "Popularity_Dec", "true")},
{_best_sql("highest_success", "Win_Probability", "Popularity_Dec >= 0.01")}, {_best_sql("pro_choice", "Expert_WP", "Expert_WP IS NOT NULL")},
docs AS (
  SELECT * EXCLUDE (most_popular_id, highest_success_id, pro_choice_id)
  FROM (SELECT DISTINCT Position_FEN AS _id, Total_Samples AS total_samples FROM explained) t
  LEFT JOIN most_popular ON _id = most_popular_id LEFT JOIN highest_success ON _id = highest_success_id
  LEFT JOIN pro_choice ON _id = pro_choice_id
)"""


def _profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.profile(_stats(spark, sf_dir))


@query(DOCS + " SELECT * FROM docs")
def profile_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.flat_profile(_profile(spark, sf_dir))


@query(
    DOCS
    + """ SELECT _id, place, title, move, CAST(floor(win_rate * 100 + 0.5) AS INTEGER) AS success_percent FROM (
    SELECT _id, 0 AS place, 'The Standard Path' AS title, most_popular_move AS move, most_popular_win_rate AS win_rate FROM docs
    UNION ALL SELECT _id, 1, 'The Statistical Edge', highest_success_move, highest_success_win_rate FROM docs
    UNION ALL SELECT _id, 2, 'The Master''s Secret', pro_choice_move, pro_choice_win_rate FROM docs) v WHERE move IS NOT NULL"""
)
def display_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.display_view(_profile(spark, sf_dir))


@query(
    """WITH d AS (SELECT o_custkey, count(*) AS orders, sum(o_orderkey) AS keys, max(o_orderkey) AS last_key FROM orders
      WHERE o_orderdate >= DATE '1996-01-01' GROUP BY o_custkey, extract(year FROM o_orderdate)),
    b AS (SELECT o_custkey, count(*) AS orders, sum(o_orderkey) AS keys FROM orders WHERE o_orderdate < DATE '1996-01-01' GROUP BY o_custkey)
    SELECT o_custkey AS _id, CAST(orders AS BIGINT) AS orders, CAST(keys AS BIGINT) AS keys FROM (
      SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY fresh DESC, last_key DESC) AS n FROM (
        SELECT o_custkey, orders, keys, 0 AS fresh, NULL AS last_key FROM b UNION ALL SELECT o_custkey, orders, keys, 1, last_key FROM d) u) t WHERE n = 1"""
)
def profile_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    old = F.col("o_orderdate") < F.lit("1996-01-01").cast("date")
    sums = (F.count("*").alias("orders"), F.sum("o_orderkey").alias("keys"))
    base = orders.filter(old).groupBy(F.col("o_custkey").alias("_id")).agg(*sums)
    delta = orders.filter(~old).groupBy(F.col("o_custkey").alias("_id"), F.year("o_orderdate").alias("y")).agg(*sums, F.max("o_orderkey").alias("at"))
    return profile.upsert(base, delta.drop("y"), "at")


@query(
    DOCS
    + f""" SELECT fen, array_to_string(string_split(trim(fen), ' ')[1:4], ' ') AS _id, total_samples, most_popular_move, total_samples IS NOT NULL AS found
    FROM ({inputs.REQUESTS}) r LEFT JOIN docs ON _id = array_to_string(string_split(trim(fen), ' ')[1:4], ' ')"""
)
def answer_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    requests = inputs.load(spark, sf_dir, inputs.REQUESTS).withColumn("_id", g.state_key(F.col("fen")))
    found = profile.lookup(requests, _profile(spark, sf_dir))
    return found.select("fen", "_id", "total_samples", F.col("recommendations.most_popular.move").alias("most_popular_move"), "found")


MASKED = f"""scored AS (
  SELECT _id, ordinal, choice, CAST(embedding[index + 1] AS DOUBLE) AS logit
  FROM ({inputs.CANDIDATES}) c JOIN embeddings ON _id = vec_id
), masked AS (
  SELECT s._id, arg_min(choice, ordinal) FILTER (WHERE logit = top) AS move, 1 / sum(exp(logit - top) ORDER BY ordinal) AS confidence
  FROM scored s JOIN (SELECT _id, max(logit) AS top FROM scored GROUP BY _id) t ON s._id = t._id GROUP BY s._id
)"""


def _masked(spark: SparkSession, sf_dir: str) -> DataFrame:
    candidates = inputs.load(spark, sf_dir, inputs.CANDIDATES)
    scores = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("_id"), F.col("embedding").cast("array<double>").alias("scores"))
    return policy.masked_policy(policy.candidate_scores(candidates, scores))


@query(f"WITH {MASKED} SELECT _id, move, round(confidence, 9) AS confidence FROM masked")
def masked_policy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _masked(spark, sf_dir).withColumn("confidence", F.round("confidence", 9))


@query(
    DOCS
    + f""", {MASKED.replace("scored", "options")}, keyed AS (
      SELECT DISTINCT array_to_string(string_split(trim(fen), ' ')[1:4], ' ') AS id FROM ({inputs.REQUESTS}) r
    ), best AS (SELECT CAST(_id AS VARCHAR) AS ai_id, move, confidence FROM masked)
    SELECT id AS fen, move AS ai_move, round(confidence, 9) AS ai_confidence,
      'The classifier selected this move with ' || printf('%.1f', confidence * 100)
        || '% confidence based on strategic pattern recognition of Expert play.' AS ai_explanation,
      pro_choice_move, coalesce(total_samples, 0) AS total_historical_samples, total_samples IS NOT NULL OR move IS NOT NULL AS answered
    FROM keyed LEFT JOIN docs ON _id = id LEFT JOIN best ON ai_id = id"""
)
def answer_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    answered, unknown = _answers(spark, sf_dir)
    known = answered.select(
        "fen",
        F.col("deep_learning_ai.move").alias("ai_move"),
        F.round("deep_learning_ai.confidence", 9).alias("ai_confidence"),
        F.col("deep_learning_ai.explanation").alias("ai_explanation"),
        F.col("big_data_stats.pro_choice.move").alias("pro_choice_move"),
        "total_historical_samples",
        F.lit(True).alias("answered"),
    )
    rest = unknown.select("fen").withColumns(
        {"total_historical_samples": F.lit(0).cast("long"), "answered": F.lit(False)}
    )
    return known.unionByName(rest, allowMissingColumns=True)


def _answers(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    requests = inputs.load(spark, sf_dir, inputs.REQUESTS).select(g.state_key(F.col("fen")).alias("fen")).distinct()
    ai = _masked(spark, sf_dir).withColumn("_id", F.col("_id").cast("string"))
    return profile.answers(requests, _profile(spark, sf_dir), ai)


@query(
    DOCS
    + f""", {MASKED.replace("scored", "options")}, keyed AS (
      SELECT DISTINCT array_to_string(string_split(trim(fen), ' ')[1:4], ' ') AS id FROM ({inputs.REQUESTS}) r
    )
    SELECT fen, place, title, move, percent, label FROM (
      SELECT id AS fen, 0 AS place, 'Deep Learning AI' AS title, move, printf('%.1f%%', confidence * 100) AS percent, 'CONFIDENCE' AS label
      FROM keyed JOIN masked ON CAST(masked._id AS VARCHAR) = id
      UNION ALL SELECT _id, 1, 'The Standard Path', most_popular_move, CAST(CAST(floor(most_popular_win_rate * 100 + 0.5) AS INTEGER) AS VARCHAR) || '%', 'SUCCESS' FROM docs JOIN keyed ON _id = id
      UNION ALL SELECT _id, 2, 'The Statistical Edge', highest_success_move, CAST(CAST(floor(highest_success_win_rate * 100 + 0.5) AS INTEGER) AS VARCHAR) || '%', 'SUCCESS' FROM docs JOIN keyed ON _id = id
      UNION ALL SELECT _id, 3, 'The Master''s Secret', pro_choice_move, CAST(CAST(floor(pro_choice_win_rate * 100 + 0.5) AS INTEGER) AS VARCHAR) || '%', 'SUCCESS' FROM docs JOIN keyed ON _id = id
    ) v WHERE move IS NOT NULL"""
)
def answer_display(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.answer_view(_answers(spark, sf_dir)[0]).drop("explanation")


# --- games --------------------------------------------------------------------------------------------------------

TEXTS = f"texts AS ({inputs.GAME_TEXTS})"
JUDGED = f"""{TEXTS}, headed AS (
  SELECT *, CASE WHEN variant = '' THEN 'Standard' ELSE variant END AS v, CASE WHEN c_custkey % 17 = 0 THEN '?' ELSE black END AS b,
    CASE WHEN eco = '' THEN '???' ELSE eco END AS e FROM texts
), judged AS (
  SELECT *, TRY_CAST(trim(white) AS INTEGER) AS w_elo, TRY_CAST(trim(b) AS INTEGER) AS b_elo,
    CASE result WHEN '1-0' THEN 1.0 WHEN '0-1' THEN 0.0 WHEN '1/2-1/2' THEN 0.5 END::DOUBLE AS score FROM headed
), reasons AS (
  SELECT *, CASE WHEN v <> 'Standard' THEN 'variant' WHEN w_elo IS NULL OR b_elo IS NULL THEN 'rating'
    WHEN least(w_elo, b_elo) < 1500 THEN 'low_rating' WHEN plies < 10 THEN 'short' WHEN score IS NULL THEN 'undecided' END AS reason FROM judged
)"""


def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.load(spark, sf_dir, inputs.GAME_TEXTS).select("c_custkey", "c_nationkey", "value")


def _judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return game_filter.judged_games(game_filter.parsed_games(_texts(spark, sf_dir)))


#: Customers whose games stand in one text.
IN_A_TEXT = 64
CORPUS = f"""{TEXTS}, numbered AS (
  SELECT c_nationkey, c_custkey, concat(c_nationkey, '/', c_custkey // {IN_A_TEXT}) AS path, value,
    row_number() OVER (PARTITION BY c_nationkey, c_custkey // {IN_A_TEXT} ORDER BY c_custkey) - 1 AS record FROM texts
)"""


def _corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Game texts joined to texts of several games, as files hold them; each has at most IN_A_TEXT games."""
    path = F.concat(F.col("c_nationkey").cast("string"), F.lit("/"), _file().cast("string"))
    return _texts(spark, sf_dir).groupBy(path.alias("path")).agg(_joined_texts().alias("value"))


def _file() -> F.Column:
    return F.floor(F.col("c_custkey") / IN_A_TEXT)


def _joined_texts() -> F.Column:
    return F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("c_custkey", "value"))), lambda r: r.value), "")


@query(f"WITH {CORPUS} SELECT path, CAST(record AS INTEGER) AS record, md5(value) AS digest FROM numbered")
def src_game_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sources.split_records(_corpus(spark, sf_dir), "path").select("path", "record", F.md5("value").alias("digest"))


def _compressed(batches):
    import pyarrow as pa
    import zstandard

    for batch in batches:
        # Junk before the first game and a byte that isn't UTF-8 after it, in two frames.
        texts = [f"junk\n{t}".encode() for t in batch.column(1).to_pylist()]
        halves = [(t[: len(t) // 2], b"\xff" + t[len(t) // 2 :]) for t in texts]
        content = [b"".join(map(zstandard.ZstdCompressor().compress, h)) for h in halves]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(content, pa.binary())], ["path", "content"])


@query(f"WITH {CORPUS} SELECT path, record, md5(value) AS digest FROM numbered")
def src_archive_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The games of zstandard archives, which Spark makes of the game texts first."""
    archives = _corpus(spark, sf_dir).mapInArrow(_compressed, "path string, content binary")
    return sources.archive_records(archives).select("path", "record", F.md5("value").alias("digest"))


@query(
    f"""WITH {TEXTS}, numbered AS (
      SELECT c_nationkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1 AS record, value FROM texts
    ) SELECT c_nationkey, CAST(record AS INTEGER) AS record, CAST(floor(coalesce(sum(strlen(value)) OVER (
      PARTITION BY c_nationkey ORDER BY record ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) / 10000) AS INTEGER) AS piece FROM numbered"""
)
def src_compact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The games of each nation's files, which are cut into records and numbered over the files, with their pieces."""
    files = _texts(spark, sf_dir).groupBy("c_nationkey", _file().alias("file")).agg(_joined_texts().alias("value"))
    # Files are cut once; what is kept of a record is slim.
    path = scratch_path(spark, "records")
    cut = sources.split_records(files.select(F.struct("c_nationkey", "file").alias("at"), "value"), "at")
    cut.select("at.*", F.col("record").alias("own"), F.octet_length("value").alias("bytes")).write.parquet(path)
    records = sources.numbered_records(spark.read.parquet(path), "c_nationkey", "file", "own")
    return sources.compact_plan(records, "c_nationkey", "record", "bytes", 10_000, rows=500).select("c_nationkey", F.col("record").cast("int").alias("record"), "piece")


@query(f"WITH {JUDGED} SELECT c_custkey, v AS Variant, white AS White_Text, b AS Black_Text, result AS Result_Str, e AS ECO FROM headed")
def pgn_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return game_filter.parsed_games(_texts(spark, sf_dir)).select("c_custkey", "Variant", "White_Text", "Black_Text", "Result_Str", "ECO")


@query(f"WITH {JUDGED} SELECT c_custkey, result AS Result_Str, score AS Result_Num FROM judged")
def result_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _judged(spark, sf_dir).select("c_custkey", "Result_Str", "Result_Num")


@query(f"WITH {TEXTS} SELECT c_custkey, plies AS n_moves, tokens AS Move_List FROM texts")
def movetext_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = game_filter.parsed_games(_texts(spark, sf_dir))
    return parsed.select("c_custkey", F.size("Moves").cast("long").alias("n_moves"), F.array_join("Moves", " ").alias("Move_List"))


CLEAN = f"""WITH {JUDGED} SELECT c_custkey, '{g.START}' AS Position_FEN, w_elo AS White_Elo, b_elo AS Black_Elo, score AS Result_Num,
  result AS Result_Str, e AS ECO, tokens AS Move_List FROM reasons WHERE reason IS NULL"""


@query(CLEAN)
def games_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return game_filter.clean_games(_judged(spark, sf_dir), "c_custkey")


@query(f"WITH {JUDGED} SELECT c_custkey, reason AS Reason FROM reasons WHERE reason IS NOT NULL")
def games_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return game_filter.rejected_games(_judged(spark, sf_dir), "c_custkey")


@query(f"WITH {JUDGED} SELECT coalesce(reason, 'clean') AS Reason, count(*) AS n FROM reasons GROUP BY 1")
def games_by_reason(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts that write_judged observes; the files are tested."""
    return game_filter.sorted_games(_judged(spark, sf_dir)).groupBy("Reason").agg(F.count("*").alias("n"))


@query(CLEAN.replace("SELECT c_custkey, '", "SELECT '"))
def sink_games(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows that write_balanced writes; the files are tested."""
    return game_filter.clean_games(_judged(spark, sf_dir))


@query(
    f"""SELECT 'games' AS what, count(*) AS n FROM ({CLEAN}) c UNION ALL SELECT 'choices', count(*) FROM ({inputs.CHOICES}) d
    UNION ALL SELECT 'experts', count(*) FROM ({inputs.CHOICES}) e WHERE Player_Elo >= 2000"""
)
def row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    choices = inputs.load(spark, sf_dir, inputs.CHOICES)
    counted = choices.agg(F.count("*").alias("choices"), F.count_if(F.col("Player_Elo") >= 2000).alias("experts"))
    games = game_filter.clean_games(_judged(spark, sf_dir)).agg(F.count("*").alias("n")).select(F.lit("games").alias("what"), "n")
    return games.union(counted.select(F.expr("stack(2, 'choices', choices, 'experts', experts) AS (what, n)")))


# --- steps --------------------------------------------------------------------------------------------------------

STEPS = f"""WITH games AS ({inputs.GAMES}), started AS (
  SELECT *, CASE WHEN coalesce(Position_FEN, '') = '' THEN '{g.START}' ELSE Position_FEN END AS start, string_split(Move_List, ' ') AS moves FROM games
), steps AS (
  SELECT *, unnest(moves) AS move, generate_subscripts(moves, 1) - 1 AS ply FROM started
), bad AS (
  SELECT o_orderkey, min(ply) AS stop FROM steps WHERE NOT regexp_matches(move, '^[a-h][1-8][a-h][1-8][qrbn]?$') GROUP BY o_orderkey
)
SELECT o_orderkey, concat_ws(' ', array_to_string(string_split(trim(start), ' ')[1:4], ' '),
    CASE WHEN ply > 1 THEN moves[ply - 1] END, CASE WHEN ply > 0 THEN moves[ply] END) AS Position_FEN, move AS Move_Played,
  CASE WHEN (ply % 2 = 0) = (string_split(start, ' ')[2] <> 'b') THEN White_Elo ELSE Black_Elo END AS Player_Elo,
  CASE WHEN (ply % 2 = 0) = (string_split(start, ' ')[2] <> 'b') THEN Result_Num ELSE 1.0 - Result_Num END AS Player_Result,
  CAST(ply AS INTEGER) AS ply
FROM steps LEFT JOIN bad USING (o_orderkey) WHERE stop IS NULL OR ply <= stop"""


def _steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequences.explode_moves(inputs.load(spark, sf_dir, inputs.GAMES), "o_orderkey")


@query(STEPS)
def sequence_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _steps(spark, sf_dir)


@query(
    """SELECT conv_id, turn, nullif(concat_ws(' ', lag(role, 2) OVER w, lag(role, 1) OVER w), '') AS Position_FEN, role AS Move_Played
    FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)"""
)
def sequence_explode_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequences.explode_rows(table(spark, sf_dir, "conversations"), "conv_id", "turn", "role")


@query(
    """SELECT user_id, ts, event_id, nullif(concat_ws(' ', lag(event_type, 3) OVER w, lag(event_type, 2) OVER w, lag(event_type, 1) OVER w), '') AS Position_FEN,
    event_type AS Move_Played FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)"""
)
def event_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Steps of users' event sequences, dealt by user and day."""
    return sequences.explode_rows(table(spark, sf_dir, "events"), "user_id", ["ts", "event_id"], "event_type", 3, F.date_trunc("day", "ts"))


@query(
    """SELECT conv_id, turn, CASE WHEN turn % 2 = 0 THEN 1000 + conv_id % 1500 ELSE 1200 + conv_id % 1300 END AS Player_Elo,
    CASE WHEN turn % 2 = 0 THEN conv_id % 3 / 2.0::DOUBLE ELSE 1.0 - conv_id % 3 / 2.0::DOUBLE END AS Player_Result FROM conversations"""
)
def mover_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select(
        "conv_id",
        "turn",
        (F.col("turn") % 2 == 0).alias("white"),
        (F.col("conv_id") % 1500 + 1000).alias("White_Elo"),
        (F.col("conv_id") % 1300 + 1200).alias("Black_Elo"),
        (F.col("conv_id") % 3 / 2).alias("Result_Num"),
    )
    seen = sequences.mover_view(rows, "white", "White_Elo", "Black_Elo", "Result_Num")
    return seen.select("conv_id", "turn", "Player_Elo", "Player_Result")


@query(f"SELECT * FROM ({STEPS}) s WHERE Player_Elo >= 2000")
def expert_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequences.expert_rows(_steps(spark, sf_dir))


# --- encodings ----------------------------------------------------------------------------------------------------


def _square_sql(at: int) -> str:
    return f"(CAST(substr(move, {at + 1}, 1) AS INTEGER) - 1) * 8 + ascii(substr(move, {at}, 1)) - 97"


MOVE_SQL = f"CASE WHEN regexp_matches(move, '{g.MOVE}') THEN ({_square_sql(1)}) * 64 + {_square_sql(3)} END"
EMPTIED = "replace(split_part(trim(board), ' ', 1), '/', '')"
for _n in range(8, 0, -1):
    EMPTIED = f"replace({EMPTIED}, '{_n}', '{'.' * _n}')"
PLANES = " || ".join(f"translate(regexp_replace(squares, '[^{p}]', '0', 'g'), '{p}', '1')" for p in g.PIECES)
BITS = f"(SELECT *, {PLANES} AS bits FROM (SELECT *, {EMPTIED} AS squares FROM ({inputs.BOARDS}) b) s) t"


@query(f"SELECT l_orderkey, l_linenumber, move, CAST({MOVE_SQL} AS INTEGER) AS index FROM ({inputs.MOVES}) m WHERE regexp_matches(move, '{g.MOVE}')")
def move_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    moves = inputs.load(spark, sf_dir, inputs.MOVES).withColumn("index", g.move_index(F.col("move")))
    return moves.filter("index IS NOT NULL")


@query(f"SELECT o_orderkey, array_to_string(string_split(trim(board), ' ')[1:4], ' ') AS state FROM ({inputs.BOARDS}) b")
def state_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.load(spark, sf_dir, inputs.BOARDS).select("o_orderkey", g.state_key(F.col("board")).alias("state"))


def _positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    boards = inputs.load(spark, sf_dir, inputs.BOARDS)
    return boards.join(inputs.load(spark, sf_dir, inputs.MOVES), F.col("o_orderkey") == F.col("l_orderkey")).select(
        F.trim("board").alias("Position_FEN"), F.col("move").alias("Move_Played"), F.col("rating").alias("Player_Elo")
    )


#: Rows of boards or moves that a task encodes.
ROWS_A_TASK = 100_000


def _spread(df: DataFrame, scan: DataFrame) -> DataFrame:
    """``df`` in parts of ROWS_A_TASK rows of its input, a plain ``scan``, and over all cores: rows are slim, what follows
    is not. A file's parts tell nothing of its rows, which are read by row groups; the count is read from its footers."""
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, -(-scan.count() // ROWS_A_TASK)))


def _planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    boards = inputs.load(spark, sf_dir, inputs.BOARDS)
    return _spread(boards, table(spark, sf_dir, "orders")).withColumn("planes", g.onehot_planes(F.trim("board")))


def _bits(numbers) -> F.Column:
    return F.array_join(numbers.cast("array<int>").cast("array<string>"), "")


@query(f"SELECT o_orderkey, length(replace(bits, '0', '')) AS pieces, md5(bits) AS digest FROM {BITS}")
def onehot_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    bits = _planes(spark, sf_dir).select("o_orderkey", g.planes_text(F.col("planes")).alias("bits"))
    return bits.select("o_orderkey", F.length(F.replace("bits", F.lit("0"))).cast("long").alias("pieces"), F.md5("bits").alias("digest"))


@query(f"SELECT o_orderkey, translate(squares, '{g.SQUARES}', '{g.DIGITS}') AS packed, length(replace(squares, '.', '')) AS pieces FROM {BITS}")
def packed_boards(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = inputs.load(spark, sf_dir, inputs.BOARDS).select("o_orderkey", g.packed_board(F.trim("board")).alias("packed"))
    return packed.select("o_orderkey", F.hex("packed").alias("packed"), F.size(g.set_squares(F.col("packed"))).cast("long").alias("pieces"))


@query(f"SELECT o_orderkey, substr(bits, 5 * 64 + 1, 8) AS top_rank, substr(bits, 5 * 64 + 57, 8) AS bottom_rank, substr(bits, 705, 64) AS last_plane FROM {BITS}")
def planes_reshape(spark: SparkSession, sf_dir: str) -> DataFrame:
    cube = _planes(spark, sf_dir).select("o_orderkey", g.reshape_planes(F.col("planes")).alias("cube"))
    return cube.select(
        "o_orderkey",
        _bits(F.col("cube")[5][0]).alias("top_rank"),
        _bits(F.col("cube")[5][7]).alias("bottom_rank"),
        _bits(F.flatten(F.col("cube")[11])).alias("last_plane"),
    )


@query(
    f"""SELECT md5(bits) AS board, CAST({MOVE_SQL} AS INTEGER) AS target_move FROM {BITS}
    JOIN ({inputs.MOVES}) m ON o_orderkey = l_orderkey WHERE rating >= 2000 AND regexp_matches(move, '{g.MOVE}')"""
)
def sink_tensors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows that write_tensors writes, tensors as digests; the files are tested."""
    packed = _spread(sequences.packed_tensors(_positions(spark, sf_dir)), table(spark, sf_dir, "lineitem"))
    return packed.select(g.unpacked_planes(F.col("packed_board")).alias("board_tensor"), "target_move").select(F.md5(g.planes_text(F.col("board_tensor"))).alias("board"), "target_move")


# --- written and read again ---------------------------------------------------------------------------------------


@query(f"WITH {CELLS.replace(inputs.CHOICES, STEPS)} SELECT * FROM cells")
def positions_laid_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells of positions that lie bucketed by state, so they aren't shuffled."""
    path = scratch_path(spark, "positions")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    sources.write_positions(_steps(spark, sf_dir), name, 16, path=path)
    return stats.choice_cells(spark.table(name))


@query(SCORED + "SELECT Position_FEN, Move_Played, Frequency, Total_Samples, Win_Probability, Popularity_Str, Explanation FROM explained")
def stats_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "stats")
    sources.write_balanced(_stats(spark, sf_dir), path)
    return spark.read.parquet(path).select(
        "Position_FEN", "Move_Played", "Frequency", "Total_Samples", "Win_Probability", "Popularity_Str", "Explanation"
    )


@query(
    f"""SELECT CAST({MOVE_SQL} AS INTEGER) AS target_move, count(*) AS n, CAST(sum(length(replace(squares, '.', ''))) AS BIGINT) AS pieces FROM {BITS}
    JOIN ({inputs.MOVES}) m ON o_orderkey = l_orderkey WHERE rating >= 2000 AND regexp_matches(move, '{g.MOVE}') GROUP BY 1"""
)
def tensors_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packed tensors by target."""
    path = scratch_path(spark, "tensors")
    sources.write_balanced(sequences.packed_tensors(_positions(spark, sf_dir)), path)
    squares = F.size(g.set_squares(F.col("packed_board")))
    return spark.read.parquet(path).groupBy("target_move").agg(F.count("*").alias("n"), F.sum(squares).alias("pieces"))


@query(CLEAN)
def games_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clean games out of the folders that one pass writes."""
    path = scratch_path(spark, "games")
    sources.write_judged(_judged(spark, sf_dir), path, "c_custkey")
    return spark.read.parquet(path).filter(F.col("Reason") == game_filter.CLEAN).drop("Reason")


@query(
    f"""WITH {TEXTS}, placed AS (SELECT c_nationkey, c_custkey, value, CAST(floor(coalesce(sum(strlen(value)) OVER (
      PARTITION BY c_nationkey ORDER BY c_custkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) / 10000) AS INTEGER) AS piece FROM texts)
    SELECT CAST(c_nationkey AS INTEGER) AS c_nationkey, piece, md5(string_agg(value, '' ORDER BY c_custkey)) AS digest FROM placed GROUP BY 1, 2"""
)
def pieces_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each piece's text, from its file."""
    path = scratch_path(spark, "pieces")
    records = _texts(spark, sf_dir).withColumn("bytes", F.octet_length("value"))
    sources.write_pieces(sources.compact_plan(records, "c_nationkey", "c_custkey", "bytes", 10_000, rows=500), path, "c_nationkey", "c_custkey")
    return spark.read.text(path, wholetext=True).select("c_nationkey", "piece", F.md5("value").alias("digest"))


@query(SQL["answer_lookup"])
def folder_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """answer_lookup in a profile of which only the folders that requests touch are read."""
    path = scratch_path(spark, "profile")
    sources.write_profile(_profile(spark, sf_dir), path, 16)
    requests = inputs.load(spark, sf_dir, inputs.REQUESTS).withColumn("_id", g.state_key(F.col("fen")))
    found = sources.lookup_in_folders(spark, path, requests, 16)
    return found.select("fen", "_id", "total_samples", F.col("recommendations.most_popular.move").alias("most_popular_move"), "found")


# --- policy -------------------------------------------------------------------------------------------------------


@query(
    """WITH x AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) - 1 AS i FROM embeddings),
    t AS (SELECT vec_id, any_value(label) AS label, max(v) AS top, max(v) FILTER (WHERE i = label) AS own, min(i) FILTER (WHERE v = m) AS first
      FROM (SELECT *, max(v) OVER (PARTITION BY vec_id) AS m FROM x) y GROUP BY vec_id),
    l AS (SELECT x.vec_id, ln(sum(exp(v - top) ORDER BY i)) + any_value(top) - any_value(own) AS loss FROM x JOIN t USING (vec_id) GROUP BY x.vec_id)
    SELECT count(*) AS n, round(avg(loss), 9) AS mean_loss, round(avg(CASE WHEN first = label THEN 1 ELSE 0 END) * 100, 9) AS accuracy_percent
    FROM l JOIN t USING (vec_id)"""
)
def eval_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = table(spark, sf_dir, "embeddings").select(
        F.col("embedding").cast("array<double>").alias("scores"), F.col("label").cast("int").alias("target")
    )
    out = policy.eval_metrics(scored)
    return out.select("n", F.round("mean_loss", 9).alias("mean_loss"), F.round("accuracy_percent", 9).alias("accuracy_percent"))


#: At most about so many labelled rows are fitted to; all rows are scored.
MOST_FITTED = 50_000


def _fitted(spark: SparkSession, sf_dir: str):
    rows = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("features"), F.col("label").alias("target"))
    n = rows.count()
    some = rows.filter(F.pmod(F.xxhash64("vec_id"), F.lit(1_000_000)) < int(1_000_000 * min(1.0, MOST_FITTED / max(n, 1))))
    return policy.fit_policy(some), rows


@query(None)
def policy_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loss and accuracy over all rows of a classifier fitted to at most about MOST_FITTED of them."""
    model, rows = _fitted(spark, sf_dir)
    return policy.eval_metrics(policy.score_policy(model, rows))


@query(None)
def policy_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    model, rows = _fitted(spark, sf_dir)
    return policy.score_policy(model, rows).select("vec_id", "target", "scores")


@query(None)
def policy_tensors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loss and accuracy over all tensors of a one-pass classifier fitted to all of them."""
    rows = sequences.packed_tensors(_positions(spark, sf_dir))
    return policy.accuracy(policy.predict_boards(policy.fit_boards(rows, "bayes"), rows))


BAYES = f"""boards AS (
  SELECT o_orderkey, rating, squares FROM {BITS}
), moves AS (
  SELECT row_number() OVER () AS id, l_orderkey, l_linenumber, move, CAST({MOVE_SQL} AS INTEGER) AS target FROM ({inputs.MOVES}) m WHERE regexp_matches(move, '{g.MOVE}')
), squares AS (
  SELECT o_orderkey, unnest(range(64)) AS i, unnest(string_split(squares, '')) AS p FROM boards
), stones AS (
  SELECT o_orderkey, (instr('{g.PIECES}', p) - 1) * 64 + i AS f FROM squares WHERE p <> '.'
), taught AS (
  SELECT target, o_orderkey FROM boards JOIN moves ON o_orderkey = l_orderkey WHERE rating >= 2000
), classes AS (
  SELECT target, ln(count(*) + 1.0) - ln(sum(count(*)) OVER () + count(*) OVER ()) AS bias FROM taught GROUP BY target
), seen AS (
  SELECT target, f, count(*) AS n FROM taught JOIN stones USING (o_orderkey) GROUP BY target, f
), totals AS (
  SELECT target, sum(n) AS n FROM seen GROUP BY target
), asked AS (
  SELECT id, o_orderkey, l_linenumber, move, target, bias, coalesce(t.n, 0) AS total
  FROM moves JOIN boards ON o_orderkey = l_orderkey JOIN classes USING (target) LEFT JOIN totals t USING (target)
), scored AS (
  SELECT a.o_orderkey, any_value(l_linenumber * 4096 + a.target) AS ordinal, any_value(move) AS move,
    any_value(bias) + coalesce(sum(ln(coalesce(s.n, 0) + 1.0) - ln(total + 768.0)) FILTER (WHERE x.f IS NOT NULL), 0) AS logit
  FROM asked a LEFT JOIN stones x ON x.o_orderkey = a.o_orderkey LEFT JOIN seen s ON s.target = a.target AND s.f = x.f
  GROUP BY a.o_orderkey, id
), tops AS (
  SELECT o_orderkey, max(logit) AS top FROM scored GROUP BY o_orderkey
)"""


@query(
    f"""WITH {BAYES} SELECT o_orderkey AS _id, arg_min(move, ordinal) FILTER (WHERE logit > top - 1e-9) AS move,
    round(1 / sum(exp(logit - top)), 6) AS confidence FROM scored JOIN tops USING (o_orderkey) GROUP BY o_orderkey"""
)
def answer_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The choice for every order's board among the moves of its lines, by a classifier that is fitted to the tensors
    of the expert rows, saved, and loaded again."""
    positions = _positions(spark, sf_dir)
    path = scratch_path(spark, "model")
    policy.save_model(policy.fit_boards(sequences.packed_tensors(positions), "bayes").table, path)
    moves = inputs.load(spark, sf_dir, inputs.MOVES)
    boards = inputs.load(spark, sf_dir, inputs.BOARDS).select("o_orderkey", g.packed_board(F.trim("board")).alias("packed_board"))
    candidates = boards.join(moves, F.col("o_orderkey") == F.col("l_orderkey")).select(
        F.col("o_orderkey").alias("_id"), (F.col("l_linenumber") * 4096 + g.move_index(F.col("move"))).alias("ordinal"), F.col("move").alias("choice"),
        "packed_board", g.move_index(F.col("move")).alias("target_move"),
    )
    chosen = policy.board_policy(policy.load_model(spark, path), candidates)
    return chosen.withColumn("confidence", F.round("confidence", 6))


def entry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship: the profile of every state."""
    return profile_docs(spark, sf_dir)

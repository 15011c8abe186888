"""Inputs of the queries, made of the given tables by Spark: choices, game texts, games, boards, moves, candidates.

Each is SQL that Spark and DuckDB both run, so that a query and its oracle start from the same rows.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

#: A choice for every line: the supplier as state, a digest of the quantity as choice.
CHOICES = """
SELECT CAST(l_suppkey AS VARCHAR(20)) AS Position_FEN,
  concat(CAST(CAST(floor(l_quantity * l_quantity / 100) AS BIGINT) AS VARCHAR(20)), '-', l_linestatus) AS Move_Played,
  CAST(floor(o_totalprice / 200) AS INT) AS Player_Elo,
  CAST(CASE l_returnflag WHEN 'A' THEN 1.0 WHEN 'N' THEN 0.5 WHEN 'R' THEN 0.0 END AS DOUBLE) AS Player_Result
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
"""

#: A move for every line, some with a promotion and some with a bad square.
MOVES = """
SELECT l_orderkey, l_linenumber, CASE WHEN l_partkey % 50 = 0 THEN '0000' ELSE concat(
  chr(CAST(97 + l_suppkey % 8 AS INT)), CAST(1 + l_linenumber % 8 AS VARCHAR(1)), chr(CAST(97 + l_partkey % 8 AS INT)),
  CAST(1 + (l_partkey + l_suppkey) % 8 AS VARCHAR(1)), CASE WHEN l_linenumber % 7 = 0 THEN 'q' ELSE '' END) END AS move
FROM lineitem
"""

# Ranks of a board, from which boards are put together.
RANKS = ("rnbqkbnr", "pppppppp", "8", "4P3", "2n2N2", "PPPP1PPP", "R3K2R", "1b4q1")


def _rank(i: int) -> str:
    cases = " ".join(f"WHEN {k} THEN '{r}'" for k, r in enumerate(RANKS))
    return f"CASE (o_orderkey * {2 * i + 1} + o_custkey * {i + 3} + {i}) % 8 {cases} END"


#: A board text for every order: six fields, blanks around some.
BOARDS = f"""
SELECT o_orderkey, concat(CASE WHEN o_orderkey % 5 = 0 THEN ' ' ELSE '' END, {", '/', ".join(_rank(i) for i in range(8))},
  CASE WHEN o_orderkey % 2 = 0 THEN ' w' ELSE ' b' END, ' KQkq - ', CAST(o_custkey % 50 AS VARCHAR(9)), ' ',
  CAST(o_orderkey % 90 AS VARCHAR(9)), CASE WHEN o_orderkey % 7 = 0 THEN '  ' ELSE '' END) AS board,
  CAST(floor(o_totalprice / 100) AS INT) AS rating
FROM orders
"""

#: A game for every order: its lines' moves in order, two blanks between some.
GAMES = f"""
SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN NULL WHEN 1 THEN '8/8/8/8/8/8/8/K6k b - - 0 1' ELSE '' END AS Position_FEN,
  CAST(floor(o_totalprice / 200) AS INT) AS White_Elo, CAST(1400 + o_custkey % 900 AS INT) AS Black_Elo,
  CAST((o_orderkey % 4) % 3 AS DOUBLE) / 2 AS Result_Num, Move_List
FROM orders JOIN (SELECT l_orderkey, @agg(move; ' '; concat(CAST(l_linenumber AS VARCHAR(9)), move))@ AS Move_List FROM ({MOVES}) m GROUP BY l_orderkey) l
  ON o_orderkey = l_orderkey
"""

#: The move tokens of a game for every customer, from the customer's orders by date.
_TOKENS = """
SELECT o_custkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS ply, o_orderkey,
  concat(CASE WHEN o_orderkey % 6 = 0 THEN 'N' ELSE '' END, chr(CAST(97 + o_orderkey % 8 AS INT)),
    CAST(1 + (o_orderkey + o_custkey) % 8 AS VARCHAR(1))) AS token
FROM orders
"""

_MOVETEXT = f"""
SELECT o_custkey, count(*) AS plies, @agg(token; ' '; ply)@ AS tokens, @agg(shown; ' '; ply)@ AS movetext FROM (
  SELECT o_custkey, ply, token, concat(
    CASE WHEN ply % 2 = 1 THEN concat(CAST(CAST(floor((ply + 1) / 2) AS INT) AS VARCHAR(9)), '. ') ELSE '' END, token,
    CASE WHEN o_orderkey % 9 = 0 THEN '!?' ELSE '' END, CASE WHEN o_orderkey % 5 = 0 THEN concat(' ', chr(123), 'see [%clk 0:01:00] e4 (a5) ', chr(125)) ELSE '' END,
    CASE WHEN o_orderkey % 7 = 0 THEN ' $14' ELSE '' END, CASE WHEN o_orderkey % 11 = 0 THEN ' (1. a3 (1... a6 (2. b4 (2... c5 (3. d4 (3... e5) f4) g5) h4) a6) c5)' ELSE '' END,
    CASE WHEN o_orderkey % 23 = 0 THEN ' )' ELSE '' END) AS shown
  FROM ({_TOKENS}) t) s GROUP BY o_custkey
"""

#: A game text for every customer with orders; headers vary by the customer's key.
GAME_TEXTS = f"""
SELECT c_custkey, c_nationkey, plies, tokens, variant, white, black, result, eco, replace(concat(
  '[Event "Game ', CAST(c_custkey AS VARCHAR(20)), '"]', chr(10), CASE WHEN variant = '' THEN '' ELSE concat('[Variant "', variant, '"]', chr(10)) END,
  '[WhiteElo "', white, '"]', chr(10), CASE WHEN c_custkey % 17 = 0 THEN '' ELSE concat('[BlackElo "', black, '"]', chr(10)) END,
  CASE WHEN c_custkey % 3 = 1 THEN concat('[ECO "A00"]', chr(10)) ELSE '' END, CASE WHEN eco = '' THEN '' ELSE concat('[ECO "', eco, '"]', chr(10)) END,
  '[Result "', result, '"]', chr(10), chr(10), movetext, ' ', result, chr(10)), chr(10), CASE WHEN c_custkey % 9 = 0 THEN concat(chr(13), chr(10)) ELSE chr(10) END) AS value
FROM (
  SELECT c_custkey, c_nationkey, plies, tokens, movetext,
    CASE c_custkey % 10 WHEN 0 THEN 'Crazyhouse' WHEN 1 THEN '' ELSE 'Standard' END AS variant,
    CASE c_custkey % 13 WHEN 0 THEN '?' WHEN 1 THEN ' 1500 ' WHEN 2 THEN '1500?' ELSE CAST(1400 + c_custkey % 900 AS VARCHAR(9)) END AS white,
    CAST(1400 + c_custkey * 7 % 900 AS VARCHAR(9)) AS black,
    CASE c_custkey % 4 WHEN 0 THEN '1-0' WHEN 1 THEN '0-1' WHEN 2 THEN '1/2-1/2' ELSE '*' END AS result,
    CASE WHEN c_custkey % 3 = 0 THEN '' ELSE concat('B', CAST(10 + c_custkey % 80 AS VARCHAR(9))) END AS eco
  FROM customer JOIN ({_MOVETEXT}) m ON c_custkey = o_custkey) h
"""

#: A score vector for every embedding and candidates for each: some indexes twice, none for some.
CANDIDATES = """
SELECT vec_id AS _id, k AS ordinal, concat('m', CAST(k AS VARCHAR(9))) AS choice, CAST((vec_id * 7 + k * k * 5) % 64 AS INT) AS index
FROM (SELECT vec_id, @each(8)@ AS k FROM embeddings) e WHERE k < vec_id % 9
"""

#: Requests for answers: every order's board, and every supplier and part as a state.
REQUESTS = """
SELECT concat(CAST(s_suppkey AS VARCHAR(20)), ' ') AS fen FROM supplier UNION SELECT CAST(p_partkey AS VARCHAR(20)) FROM part
"""

TABLES = ("customer", "orders", "lineitem", "supplier", "part", "embeddings", "conversations", "events")


def for_duckdb(sql: str) -> str:
    return re.sub(r"@each\((\d+)\)@", r"unnest(range(\1))", _with_agg(sql, "string_agg({0}, {1} ORDER BY {2})"))


def for_spark(sql: str) -> str:
    sql = _with_agg(sql, "listagg({0}, {1}) WITHIN GROUP (ORDER BY {2})")
    return re.sub(r"@each\((\d+)\)@", r"explode(sequence(0, \1 - 1))", sql)


def _with_agg(sql: str, form: str) -> str:
    while "@agg(" in sql:
        head, rest = sql.split("@agg(", 1)
        inner, tail = rest.split(")@", 1)
        item, separator, order = inner.split(";")
        sql = head + form.format(item.strip(), separator.strip(), order.strip()) + tail
    return sql


def load(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """One of the inputs over the tables in ``sf_dir``."""
    tables = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TABLES if re.search(rf"\b(FROM|JOIN) {t}\b", sql)}
    return spark.sql(_braced(for_spark(sql), tables), **tables)


def _braced(sql: str, tables) -> str:
    sql = sql.replace("{", "{{").replace("}", "}}")
    return re.sub(rf"\b(FROM|JOIN) ({'|'.join(tables)})\b", r"\1 {\2}", sql)

"""Fixture views over the driver tables.

The four views (games, positions, catalog, messages) map the TPC-H-like
driver tables onto the data model of the repertoire engine. They are plain
projections (positions adds one window per game), so they stream through the
scans without extra shuffles except the per-game ply numbering.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import read_table

# The twelve opening names of the fixture, in code order 0..11.
OPENING_NAMES = [
    "Sicilian Defense", "French Defense", "Caro-Kann Defense", "Italian Game", "Ruy Lopez",
    "London System", "Slav Defense", "English Opening", "Dutch Defense",
    "Queen's Gambit Declined", "Pirc Defense", "King's Indian Defense",
]


def opening_case(expr: str) -> str:
    """SQL text mapping an integer expression 0..11 to an opening name.

    The text runs unchanged in Spark SQL and DuckDB (apostrophes via chr(39)).
    """
    parts = []
    for i, name in enumerate(OPENING_NAMES[:-1]):
        parts.append(f"WHEN {i} THEN {_sql_str(name)}")
    return f"CASE {expr} {' '.join(parts)} ELSE {_sql_str(OPENING_NAMES[-1])} END"


def _sql_str(s: str) -> str:
    if "'" not in s:
        return f"'{s}'"
    pieces = s.split("'")
    return "concat(" + ", chr(39), ".join(f"'{p}'" for p in pieces) + ")"


GAMES_EXPRS = [
    "event_id AS game_id",
    "user_id AS player",
    "CAST(900 + (user_id * 37) % 1500 AS INT) AS rating",
    f"{opening_case('k % 12')} AS opening",
    "CASE WHEN event_id % 2 = 0 THEN 'white' ELSE 'black' END AS color",
    "CAST(floor(k / 12.0) AS INT) + CAST(event_id % 11 AS INT) AS theory_depth",
    "CASE WHEN event_type = 'error' AND event_id % 5 = 0 THEN NULL ELSE round(value * 1.6, 1) END AS acl",
    "CASE WHEN event_type IN ('purchase', 'signup') THEN 1.0e0 WHEN event_type = 'view' THEN 0.5e0 ELSE 0.0e0 END AS score",
    "ts AS played_at",
    "event_id AS ingest_seq",
]

POSITIONS_EXPRS = [
    "game_id", "ply",
    "concat(CAST(ply AS STRING), ':', CAST(CAST(l_quantity AS INT) AS STRING)) AS pos_key",
    "CASE WHEN ply % 2 = 1 THEN 'white' ELSE 'black' END AS mover",
    "CASE WHEN l_returnflag = 'R' AND l_tax >= 0.08 THEN 'mate' ELSE 'cp' END AS eval_type",
    "CAST(CAST(round(l_extendedprice * 100) AS BIGINT) % 2401 - 1200 AS INT) AS eval_value",
]

CATALOG_EXPRS = [
    "concat('r__', CAST(p_partkey AS STRING)) AS resource_id",
    "CASE p_partkey % 5 WHEN 0 THEN 'modern_chess' WHEN 1 THEN 'youtube' WHEN 2 THEN 'manual' "
    "WHEN 3 THEN 'chessable' ELSE 'telegram_file' END AS source",
    f"concat({opening_case('(p_partkey * 7) % 12')}, CASE p_partkey % 4 WHEN 0 THEN ': complete beginner basics ' "
    "WHEN 1 THEN ': GM repertoire, prophylaxis in-depth ' WHEN 2 THEN ' for club player 1400-1800 ' "
    "ELSE ' easy guide part 1 ' END, p_name) AS title",
    f"CASE WHEN p_partkey % 6 = 5 THEN NULL WHEN p_partkey % 3 = 0 THEN concat({opening_case('p_partkey % 12')}, '|', "
    f"{opening_case('(p_partkey + 5) % 12')}) ELSE {opening_case('p_partkey % 12')} END AS openings",
    "CASE p_partkey % 4 WHEN 0 THEN 'White' WHEN 1 THEN 'Black' WHEN 2 THEN 'Both' ELSE NULL END AS color",
    "CASE p_type WHEN 'STANDARD' THEN 'opening' WHEN 'ECONOMY' THEN 'tactics' WHEN 'MEDIUM' THEN 'middlegame' "
    "WHEN 'SMALL' THEN 'endgame' WHEN 'LARGE' THEN 'general' ELSE 'video' END AS course_type",
    "CASE WHEN p_size % 10 = 0 THEN NULL WHEN p_size % 10 = 9 THEN 1200 ELSE (p_size % 10) * 250 END AS level_min",
    "CASE WHEN p_size % 10 = 0 THEN NULL WHEN p_size % 10 = 9 THEN 3000 "
    "ELSE (p_size % 10) * 250 + 200 + (p_partkey % 7) * 200 END AS level_max",
    "CASE p_partkey % 4 WHEN 0 THEN 'beginner' WHEN 1 THEN 'expert' WHEN 2 THEN 'intermediate' ELSE 'advanced' END AS level_tier",
    "round(p_retailprice - 900, 2) AS price_eur",
    "CASE WHEN p_retailprice < 930 THEN 1 ELSE 0 END AS is_free",
    "CASE WHEN p_partkey % 8 = 0 THEN NULL ELSE (p_partkey % 51) / 10.0e0 END AS rating_score",
    "CASE WHEN p_partkey % 2 = 0 THEN 1 ELSE 0 END AS has_video",
    "CASE WHEN p_partkey % 3 = 0 THEN 1 ELSE 0 END AS has_pgn",
    "CASE WHEN p_partkey % 5 = 0 THEN NULL WHEN p_partkey % 5 < 3 THEN 1 ELSE 0 END AS has_exercises",
    "CASE WHEN p_partkey % 7 = 0 THEN 1 ELSE 0 END AS has_spaced_rep",
    "p_size * 7 AS duration_min",
    "CASE WHEN p_partkey % 5 = 1 THEN p_partkey * 131 % 100003 ELSE NULL END AS views_yt",
]


def _message_exprs(date_expr: str) -> list[str]:
    return [
        "conv_id * 100 + turn AS msg_id",
        f"{date_expr} AS sent_on",
        "concat(CASE (conv_id * 3 + turn) % 9 WHEN 0 THEN 'please send pgn ' WHEN 1 THEN 'Complete beginner basics ' "
        f"WHEN 2 THEN concat('GM repertoire in-depth, ', {opening_case('conv_id % 12')}, ' for white ') "
        "WHEN 3 THEN 'Endgame mastery 1900-2200 ' WHEN 4 THEN 'club player tactics 1400 ' WHEN 5 THEN 'thanks ' "
        f"WHEN 6 THEN concat({opening_case('turn % 12')}, ' against 1.e4 ') WHEN 7 THEN '*Fundamentals* of strategy ' ELSE '' END, "
        "CASE (conv_id + turn) % 7 WHEN 0 THEN 'https://www.chessable.com/course/x-1' "
        "WHEN 1 THEN 'http://youtu.be/abc (https://unknown.example/y)' "
        "WHEN 2 THEN 'https://www.modernchess.com/course/z' ELSE '' END, chr(10), text) AS text",
        "CASE (conv_id * 5 + turn) % 8 WHEN 0 THEN 'Najdorf_Guide.pdf' WHEN 1 THEN 'games-2200.PGN' "
        "WHEN 2 THEN 'photo.jpg' ELSE NULL END AS file_name",
    ]


MESSAGES_EXPRS = _message_exprs("CAST(date_add(DATE '2021-11-01', CAST(conv_id AS INT)) AS DATE)")


def games(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type", "value", "props"])
    ev = ev.withColumn("k", F.regexp_extract("props", "([0-9]+)", 1).cast("int"))
    return ev.selectExpr(*GAMES_EXPRS)


def positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                                                "l_extendedprice", "l_tax", "l_returnflag", "l_shipdate"])
    li = li.withColumn("game_id", F.col("l_suppkey") * 32 + F.col("l_partkey") % 32)
    li = li.selectExpr("*", "row_number() OVER (PARTITION BY game_id ORDER BY l_shipdate, l_orderkey, "
                            "l_linenumber, l_partkey, l_extendedprice) AS ply")
    return li.selectExpr(*POSITIONS_EXPRS)


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "part").selectExpr(*CATALOG_EXPRS)


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "conversations", ["conv_id", "turn", "text"]).selectExpr(*MESSAGES_EXPRS)


def theory_book(pos: DataFrame) -> DataFrame:
    """Fixture theory book over all games: the keys of the first 15 plies that are
    reached at least as often as the mean key of their ply."""
    keys = pos.filter(F.col("ply") <= 15).groupBy("ply", "pos_key").agg(F.count(F.lit(1)).alias("n"))
    mean = keys.groupBy("ply").agg(F.avg("n").alias("mean"))
    return keys.join(mean, "ply").filter(F.col("n") >= F.col("mean")).select("pos_key").distinct()

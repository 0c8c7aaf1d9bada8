"""Registered queries of the file sources and sinks (PGN, NDJSON, snapshots)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalar as S
from ..sources import fixtures as fx
from ..sources import io
from ..streaming.incremental import new_run_dir
from .registry import register


@register("p15_base_opening", """
SELECT DISTINCT name, trim(split_part(split_part(coalesce(name, 'Desconocida'), ':', 1), ',', 1)) AS base FROM
 (SELECT title AS name FROM catalog UNION ALL SELECT opening || ': Main Line, Exchange' FROM games)""")
def p15(spark, sf):
    a = fx.catalog(spark, sf).select(F.col("title").alias("name"))
    b = fx.games(spark, sf).select(F.concat("opening", F.lit(": Main Line, Exchange")).alias("name"))
    return a.unionByName(b).select("name", S.base_opening("name").alias("base")).distinct()


def _pgn_text(g):
    res = (F.when(F.col("score") == 1.0, F.when(F.col("color") == "white", "1-0").otherwise("0-1"))
           .when(F.col("score") == 0.5, "1/2-1/2").otherwise(F.when(F.col("color") == "white", "0-1").otherwise("1-0")))
    white = F.when(F.col("color") == "white", F.concat(F.lit("u"), F.col("player").cast("string"))).otherwise("opp")
    black = F.when(F.col("color") == "black", F.concat(F.lit("u"), F.col("player").cast("string"))).otherwise("opp")
    def pair(i):
        n, k = i.cast("string"), (i + F.col("game_id")) % 6
        return (F.when(k == 0, F.concat(n, F.lit(". e4 e5")))
                .when(k == 1, F.concat(n, F.lit(". e4 {a comment with ( and 1. d4\nover two lines} e5")))
                .when(k == 2, F.concat(n, F.lit(". e4! $1 "), n, F.lit("... e5")))
                .when(k == 3, F.concat(n, F.lit(". e4 ("), n, F.lit(". d4 d5 ("), n, F.lit("... Nf6 {deep}) 9. c4) e5?!")))
                .when(k == 4, F.concat(n, F.lit(".e4 e5 ; 1. h4 to the end of the line\n")))
                .otherwise(F.concat(n, F.lit(". e4\ne5"))))
    moves = F.concat_ws(" ", F.transform(F.sequence(F.lit(1), F.greatest(F.col("theory_depth"), F.lit(1))), pair))
    return F.concat(F.lit('[Event "Rated game"]\n[Site "https://example.org/'), F.col("game_id").cast("string"),
                    F.lit('"]\n[White "'), white, F.lit('"]\n[Black "'), black, F.lit('"]\n[Result "'), res,
                    F.lit('"]\n[Opening "'), F.col("opening"), F.lit(': Main Line, Exchange"]\n\n'), moves, F.lit(" "), res)


@register("s04_p16_pgn_ingest", """
SELECT CAST(game_id AS VARCHAR) AS game_id, CASE WHEN color = 'white' THEN 'u' || CAST(player AS VARCHAR) ELSE 'opp' END AS white,
  opening AS opening_base, greatest(theory_depth, 1) * 2 AS n_moves, rtrim(repeat('e4 e5 ', greatest(theory_depth, 1)::BIGINT)) AS main_line,
  CAST(CASE WHEN score = 1.0 THEN 1.0 WHEN score = 0.5 THEN 0.5 ELSE 0.0 END AS DOUBLE) AS player_score FROM games""")
def s04(spark, sf):
    g = fx.games(spark, sf)
    path = new_run_dir(spark, "pgn")
    # one text file per partition; records separated by a blank line, every other game in files with CRLF line ends
    text = _pgn_text(g)
    g.filter(F.col("game_id") % 2 == 0).select(text.alias("value")).write.option("lineSep", "\n\n").text(f"{path}/lf")
    g.filter(F.col("game_id") % 2 != 0).select(F.regexp_replace(text, "\n", "\r\n").alias("value")).write.option("lineSep", "\r\n\r\n").text(f"{path}/crlf")
    d = io.read_pgn(spark, [f"{path}/lf", f"{path}/crlf"])
    target = F.when(F.col("white") != "opp", F.col("white")).otherwise(F.col("black"))
    return d.select("game_id", "white", S.base_opening("opening").alias("opening_base"), F.size("moves").alias("n_moves"),
                    F.concat_ws(" ", "moves").alias("main_line"), S.result_score("result", "white", target).alias("player_score"))


@register("s06_study_feed", """
SELECT resource_id AS id, title AS name FROM catalog
WHERE source <> 'manual' AND (""" + " OR ".join(f"instr(lower(title), '{s}') > 0" for s in __import__(
    "tabiya.functions.text", fromlist=["x"]).FEED_BEGINNER_SIGNALS) + ")")
def s06(spark, sf):
    cat = fx.catalog(spark, sf)
    path = new_run_dir(spark, "feed")
    good = cat.select(F.to_json(F.struct(F.col("resource_id").alias("id"), F.col("title").alias("name"),
                                         F.lit(None).cast("string").alias("url"), F.lit(0).alias("likes"))).alias("value"))
    bad = cat.filter(F.col("is_free") == 1).select(F.concat(F.lit('{"id": "broken'), F.col("resource_id")).alias("value"))
    good.unionByName(bad).unionByName(good.limit(0)).write.text(path)
    known = cat.filter(F.col("source") == "manual").select("resource_id")
    return io.read_study_feed(spark, path, known).select("id", "name")


@register("s10_snapshots", """
SELECT 'after' AS label, count(*) AS n FROM games UNION ALL SELECT 'before', count(*) FROM games
UNION ALL SELECT 'every_10_users', count(*) FROM games WHERE player % 10 = 0""")
def s10(spark, sf):
    g = fx.games(spark, sf).select("game_id", "player")
    base = new_run_dir(spark, "snap")
    io.write_snapshot(g, base, "before")
    io.write_snapshot(g.filter(F.col("player") % 10 == 0), base, "every_10_users")
    io.write_snapshot(g, base, "after")
    label = F.regexp_extract("snapshot_ts", "^(.*)_[^_]*$", 1)
    return spark.read.parquet(base).groupBy(label.alias("label")).agg(F.count(F.lit(1)).alias("n"))


@register("s15_long_tables", "SELECT game_id, player, opening, color FROM games")
def s15(spark, sf):
    path = new_run_dir(spark, "features")
    io.write_table(fx.games(spark, sf).select("game_id", "player", "opening", "color"), path, ["color"])
    return spark.read.parquet(path).select("game_id", "player", "opening", "color")


@register("s09_versioned_table", "SELECT game_id, player, rating + 1 AS rating FROM games")
def s09(spark, sf):
    base = new_run_dir(spark, "versions")
    g = fx.games(spark, sf).select("game_id", "player", "rating")
    io.write_versioned(g, base)
    # the second version is made from the first one, which its readers keep until the new one is complete
    io.write_versioned(io.read_newest(spark, base).withColumn("rating", F.col("rating") + 1), base)
    return io.read_newest(spark, base)

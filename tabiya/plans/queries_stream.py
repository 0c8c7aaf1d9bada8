"""Registered queries of the incremental / streaming operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import positions as PO
from ..sources import fixtures as fx
from ..streaming import incremental as I
from .queries_positions import _EXIT_SQL, _loss_sql
from .queries_text import _MSGRES_COLS, _msg_resources_sql
from .registry import register


@register("i01_pending_work", """
SELECT DISTINCT player FROM games WHERE player NOT IN (SELECT player FROM games WHERE played_at < TIMESTAMP '2024-01-01 06:00:00')""")
def i01(spark, sf):
    g = fx.games(spark, sf)
    done = g.filter(F.col("played_at") < F.lit("2024-01-01 06:00:00").cast("timestamp")).select("player")
    return I.pending_work(g, done)


@register("i02_exactly_once_stream_append", """SELECT game_id, player, opening FROM games""")
def i02(spark, sf):
    g = fx.games(spark, sf).select("game_id", "player", "opening", "ingest_seq")
    base = I.new_run_dir(spark, "i02")
    src, target, ckpt = f"{base}/in", f"{base}/out", f"{base}/ckpt"
    # the stream input: the table split into 4 files plus a re-delivery of part of it
    g.withColumn("__f", F.col("game_id") % 4).write.partitionBy("__f").parquet(src)
    g.filter(F.col("game_id") % 5 == 0).withColumn("__f", F.lit(9)).write.mode("append").partitionBy("__f").parquet(src)
    schema = "game_id long, player long, opening string, ingest_seq long, __f int"
    I.exactly_once_append(spark, src, schema, target, ckpt)
    I.exactly_once_append(spark, src, schema, target, ckpt)  # restart: nothing new
    return spark.read.parquet(target).select("game_id", "player", "opening")


_I03_SQL = f"""WITH {_EXIT_SQL}, {_loss_sql()},
obs AS (SELECT game_id, CAST(game_id % 150 AS BIGINT) AS player, 'op' || CAST(game_id % 12 AS VARCHAR) AS opening, pos_before AS fen,
        loss, CAST(ply AS BIGINT) AS ts, 'observe' AS kind FROM ls2 WHERE is_own AND loss > 100),
evl AS (SELECT * FROM obs
   UNION ALL SELECT DISTINCT game_id, NULL, NULL, NULL, NULL, CAST(20 AS BIGINT), 'upload' FROM obs WHERE game_id % 3 = 0
   UNION ALL SELECT DISTINCT game_id, NULL, NULL, NULL, NULL, CAST(25 AS BIGINT), 'reset' FROM obs WHERE game_id % 6 = 0),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY game_id ORDER BY loss DESC, ts) AS rn FROM obs) WHERE rn = 1),
lastk AS (SELECT game_id, arg_max(kind, ts * 10 + CASE kind WHEN 'observe' THEN 0 WHEN 'reset' THEN 1 ELSE 2 END) AS last_kind,
          max(CASE WHEN kind = 'observe' THEN ts END) AS last_seen FROM evl GROUP BY game_id)
SELECT b.game_id, b.player, b.opening, b.fen, b.loss, l.last_seen, l.last_kind = 'upload' AS uploaded FROM best b JOIN lastk l USING (game_id)"""


@register("i04_pending_blunders", f"SELECT game_id, player, loss FROM ({_I03_SQL}) s WHERE NOT uploaded")
def i04_pending(spark, sf):
    return I.pending_blunders(I.blunder_state(_blunder_events(spark, sf))).select("game_id", "player", "loss")


@register("i04_reset_player", f"SELECT game_id, player, loss, uploaded AND player <> 3 AS uploaded FROM ({_I03_SQL}) s")
def i04_reset(spark, sf):
    ev = _blunder_events(spark, sf)
    # player 3 asks to see the uploaded ones again: a reset event for each of the player's blunders
    reset = I.reset_events(I.blunder_state(ev), 30, 3).withColumn("ts", F.col("ts").cast("long"))
    return I.blunder_state(ev.unionByName(reset)).select("game_id", "player", "loss", "uploaded")


@register("i03_blunder_state", _I03_SQL)
def i03(spark, sf):
    return I.blunder_state(_blunder_events(spark, sf))


def _blunder_events(spark, sf):
    obs = _observations(spark, sf)
    return obs.unionByName(_flags(obs))


def _observations(spark, sf):
    l = PO.move_losses(fx.positions(spark, sf))
    return l.filter(F.col("is_own") & (F.col("loss") > 100)).select(
        "game_id", (F.col("game_id") % 150).cast("long").alias("player"),
        F.concat(F.lit("op"), (F.col("game_id") % 12).cast("string")).alias("opening"), F.col("pos_before").alias("fen"),
        "loss", F.col("ply").cast("long").alias("ts"), F.lit("observe").alias("kind"))


def _flags(obs):
    ids = obs.select("game_id").distinct()
    nulls = [F.lit(None).cast(t).alias(c) for c, t in [("player", "long"), ("opening", "string"), ("fen", "string"),
                                                         ("loss", "double")]]
    up = ids.filter(F.col("game_id") % 3 == 0).select("game_id", *nulls, F.lit(20).cast("long").alias("ts"),
                                                       F.lit("upload").alias("kind"))
    rs = ids.filter(F.col("game_id") % 6 == 0).select("game_id", *nulls, F.lit(25).cast("long").alias("ts"),
                                                       F.lit("reset").alias("kind"))
    return up.unionByName(rs)


@register("i05_streaming_message_resources", f"WITH {_msg_resources_sql()} SELECT {_MSGRES_COLS} FROM res")
def i05(spark, sf):
    m = fx.messages(spark, sf)
    base = I.new_run_dir(spark, "i05")
    src, target, ckpt = f"{base}/in", f"{base}/out", f"{base}/ckpt"
    m.withColumn("__f", F.col("msg_id") % 4).write.partitionBy("__f").parquet(src)
    schema = "msg_id long, sent_on date, text string, file_name string, __f int"
    I.stream_message_resources(spark, src, schema, target, ckpt)
    return spark.read.parquet(target).select(*[c.strip() for c in _MSGRES_COLS.split(",")])


@register("i03_streaming_blunder_upsert", _I03_SQL)
def i03s(spark, sf):
    base = I.new_run_dir(spark, "i03")
    # the event log arrives in 3 parts ordered by time: observations of early plies, late plies, then flags,
    # which are made from the written observations, so the losses are computed once
    schema = ("game_id long, player long, opening string, fen string, loss double, ts long, kind string, __f int")
    obs = _observations(spark, sf).withColumn("__f", F.when(F.col("ts") <= 10, 0).otherwise(1))
    obs.write.partitionBy("__f").parquet(f"{base}/in")
    flags = _flags(spark.read.schema(schema).parquet(f"{base}/in")).withColumn("__f", F.lit(2))
    flags.write.mode("append").partitionBy("__f").parquet(f"{base}/in")
    path = I.stream_blunder_state(spark, f"{base}/in", schema, f"{base}/state", f"{base}/ckpt", files_per_batch=I.files_of_parts(spark, f"{base}/in", 2, 3))
    return spark.read.parquet(path)

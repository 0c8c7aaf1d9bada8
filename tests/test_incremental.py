"""Incremental properties: append idempotence, stream result = batch result."""

from pyspark.sql import functions as F

from tabiya.sources import fixtures as fx
from tabiya.sources import io
from tabiya.streaming import incremental as I
from tabiya.plans import queries_stream as QS

from .conftest import SF001


def _rows(df, cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_append_is_idempotent(spark):
    g = fx.games(spark, SF001).select("game_id", "player", "ingest_seq")
    old = g.filter(F.col("game_id") % 2 == 0)
    batch = g.filter(F.col("game_id") % 3 == 0).unionByName(g.filter(F.col("game_id") % 3 == 0))
    once = io.incremental_append(batch, old)
    twice = io.incremental_append(batch, once)
    assert _rows(once, ["game_id"]) == _rows(twice, ["game_id"])
    assert once.count() == once.select("game_id").distinct().count()


def test_streamed_blunder_state_equals_batch(spark):
    ev = QS._blunder_events(spark, SF001)
    batch = I.blunder_state(ev)
    base = I.new_run_dir(spark, "t-i03")
    ev.withColumn("__f", (F.col("ts") % 4).cast("int")).write.partitionBy("__f").parquet(f"{base}/in")
    schema = "game_id long, player long, opening string, fen string, loss double, ts long, kind string, __f int"
    path = I.stream_blunder_state(spark, f"{base}/in", schema, f"{base}/state", f"{base}/ckpt", files_per_batch=1)
    cols = ["game_id", "loss", "fen", "uploaded", "last_seen"]
    assert _rows(spark.read.parquet(path), cols) == _rows(batch, cols)


def test_appends_over_three_restarts_read_nothing_of_the_target(spark):
    base = I.new_run_dir(spark, "t-i02")
    src, target, ckpt = f"{base}/in", f"{base}/out", f"{base}/ckpt"
    schema = "game_id long, ingest_seq long, v string"

    def deliver(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
        I.exactly_once_append(spark, src, schema, target, ckpt)

    deliver([(1, 5, "a"), (1, 3, "b"), (2, 1, "c"), (None, 1, "n")])
    # a later delivery of a known id changes nothing, not even with a smaller order value
    deliver([(1, 0, "late"), (3, 1, "d"), (3, 1, "d"), (None, 0, "late")])
    deliver([(2, 1, "c"), (4, 9, "e")])
    wanted = sorted([(1, 3, "b"), (2, 1, "c"), (3, 1, "d"), (4, 9, "e")])
    rows = [tuple(r) for r in spark.read.parquet(target).select("game_id", "ingest_seq", "v").collect()]
    assert sorted(r for r in rows if r[0] is not None) == wanted and [r for r in rows if r[0] is None] == [(None, 1, "n")]
    # a new checkpoint over the same source and target appends nothing
    I.exactly_once_append(spark, src, schema, target, f"{base}/ckpt2")
    assert spark.read.parquet(target).count() == 5


def test_batch_run_again_replaces_its_folder(spark):
    import pathlib
    import shutil

    base = I.new_run_dir(spark, "t-again")
    src, target, ckpt = f"{base}/in", f"{base}/out", f"{base}/ckpt"
    schema = "game_id long, ingest_seq long"
    for k in range(3):
        spark.range(k * 5, k * 5 + 10).selectExpr("id AS game_id", f"{k}L AS ingest_seq").coalesce(1).write.mode("append").parquet(src)
        I.exactly_once_append(spark, src, schema, target, ckpt)
    before = _rows(spark.read.parquet(target), ["game_id", "ingest_seq"])
    # as if the job had died after writing the last batch and before its commit
    for f in pathlib.Path(ckpt, "commits").iterdir():
        if f.name.strip(".").startswith("2"):
            shutil.move(f, pathlib.Path(base, f.name))
    I.exactly_once_append(spark, src, schema, target, ckpt)
    assert _rows(spark.read.parquet(target), ["game_id", "ingest_seq"]) == before
    assert [g for g, _ in before] == list(range(20))


def test_blunder_state_over_three_restarts(spark):
    ev = QS._blunder_events(spark, SF001)
    base = I.new_run_dir(spark, "t-i03r")
    schema = "game_id long, player long, opening string, fen string, loss double, ts long, kind string"
    path = None
    for k in range(3):
        ev.filter(F.col("ts") % 3 == k).select(*[c.split()[0] for c in schema.split(", ")]).coalesce(2).write.mode("append").parquet(f"{base}/in")
        path = I.stream_blunder_state(spark, f"{base}/in", schema, f"{base}/state", f"{base}/ckpt", files_per_batch=1)
    assert path == I.stream_blunder_state(spark, f"{base}/in", schema, f"{base}/state", f"{base}/ckpt")
    cols = ["game_id", "loss", "fen", "uploaded", "last_seen"]
    assert _rows(spark.read.parquet(path), cols) == _rows(I.blunder_state(ev), cols)

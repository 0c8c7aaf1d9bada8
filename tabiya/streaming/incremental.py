"""Incremental and streaming operators.

Streams are file sources processed with ``trigger(availableNow=True)`` and a
checkpoint location, so a restarted job resumes after the last committed
micro-batch. Sinks are idempotent: every micro-batch has a folder of its own,
which a batch replayed after a failure replaces. No batch reads or rewrites
what earlier batches wrote; known keys are the stream's state.
"""

from __future__ import annotations

import contextlib
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.catalog import message_order, message_rows
from ..session import scratch_path


def pending_work(all_keys: DataFrame, done_log: DataFrame, key: str = "player") -> DataFrame:
    """Work items not yet marked done (a user marked with 0 added games is done)."""
    return all_keys.select(key).distinct().join(done_log.select(key), key, "left_anti")


def _children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder through Spark's file systems; none where the folder does not exist."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return [f.getPath().getName() for f in store.listStatus(p)] if store.exists(p) else []


def files_of_parts(spark: SparkSession, path: str, parts: int, of: int) -> int:
    """How many files make up ``parts`` of the ``of`` parts of a log written by ``partitionBy``, two at least.

    A batch costs every state partition a load and a commit, so batches must not
    grow in number with the files that a part is written in.
    """
    files = sum(n.startswith("part-") for d in _children(spark, path) if "=" in d for n in _children(spark, f"{path}/{d}"))
    return max(2, -(-parts * files // of))


def _query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that a stream's checkpoint keeps over restarts."""
    return spark.read.json(f"{checkpoint}/metadata").first()["id"]


def _append_first(rows: DataFrame, key: str, order: list, target: str, checkpoint: str) -> None:
    """Append the first row of every key of a stream to ``target``, one folder a batch.

    Keys are state: a streaming aggregation keeps, for each key, its first row and the times of the first
    and the last batch that held it. A key is new if the two are equal, so a batch reads nothing of the
    target. A batch that runs again has its old time and replaces its own folder. Folders of another
    checkpoint and data files beside the folders, whose keys are not in this one's state, are read and anti-joined;
    there are none unless a checkpoint was lost, and an error while reading them ends the batch. The state is kept on disk, and a batch's commit writes what changed.
    """
    spark = rows.sparkSession
    others = [c for c in rows.columns if c != key]
    firsts = rows.withColumn("__at", F.current_timestamp()).groupBy(key).agg(
        F.min_by(F.struct(*others), F.struct(F.col("__at"), *order)).alias("row"), F.min("__at").alias("first_at"), F.max("__at").alias("last_at"))

    def write(df: DataFrame, epoch: int) -> None:
        own = f"batch={_query_id(spark, checkpoint)}-"
        new = df.filter("first_at = last_at").select(key, "row.*")
        foreign = [f"{target}/{n}" for n in _children(spark, target) if n.startswith(("batch=", "part-")) and not n.startswith(own)]
        if foreign:
            known = spark.read.parquet(*foreign).select(F.col(key).alias("__known"))
            new = new.join(known, F.col(key).eqNullSafe(F.col("__known")), "left_anti")
        new.write.mode("overwrite").parquet(f"{target}/{own}{epoch}")

    with _state_on_disk(spark):
        q = (firsts.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
             .foreachBatch(write).trigger(availableNow=True).start())
        q.awaitTermination()


@contextlib.contextmanager
def _state_on_disk(spark: SparkSession):
    """State of the streams started inside is kept by RocksDB with change logs."""
    wanted = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
              "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true"}
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def exactly_once_append(spark: SparkSession, source_dir: str, schema, target: str, checkpoint: str,
                        key: str = "game_id", order_col: str = "ingest_seq", files_per_batch: int | None = None) -> None:
    """Stream new files of ``source_dir`` into ``target`` keeping the first
    row per key across all batches, in a batch the first by ``order_col``."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    _append_first(reader.parquet(source_dir), key, [F.col(order_col)], target, checkpoint)


def blunder_state(events: DataFrame) -> DataFrame:
    """Current blunder state per game from an append-only event log.

    events: (game_id, player, opening, fen, loss, ts, kind) with kind in
    {'observe', 'upload', 'reset'}. Observation: keep the largest loss and its
    position (strictly greater wins, so the earliest of equal maxima), refresh
    the date, reset ``uploaded`` to false. Upload marks uploaded; reset marks
    not uploaded. The flag is the last event by time (observation counts as a
    reset). Two aggregates (max-wins and last-wins) in one grouped pass.
    """
    obs = F.col("kind") == "observe"
    agg = events.groupBy("game_id").agg(
        F.max_by(F.when(obs, F.struct("loss", "fen", "player", "opening")),
                 F.when(obs, F.struct(F.col("loss"), -F.col("ts")))).alias("best"),
        F.max(F.when(obs, F.col("ts"))).alias("last_seen"),
        F.max_by(F.col("kind"), F.struct(F.col("ts"), F.when(F.col("kind") == "observe", 0)
                                          .when(F.col("kind") == "reset", 1).otherwise(2))).alias("last_kind"))
    return agg.filter(F.col("best").isNotNull()).select(
        "game_id", F.col("best.player").alias("player"), F.col("best.opening").alias("opening"),
        F.col("best.fen").alias("fen"), F.col("best.loss").alias("loss"), "last_seen",
        (F.col("last_kind") == "upload").alias("uploaded"))


def pending_blunders(state: DataFrame, player: str | None = None) -> DataFrame:
    """Blunders not uploaded yet (optionally of one player), by loss desc."""
    p = state.filter(~F.col("uploaded"))
    if player is not None:
        p = p.filter(F.col("player") == player)
    return p.orderBy(F.desc("loss"), "game_id")


def reset_events(state: DataFrame, ts, player: str | None = None) -> DataFrame:
    """I04: 'reset' events for all (or one player's) blunders, to append to the log."""
    s = state if player is None else state.filter(F.col("player") == player)
    return s.select("game_id", "player", "opening", "fen", "loss", F.lit(ts).alias("ts"), F.lit("reset").alias("kind"))


def stream_message_resources(spark: SparkSession, source_dir: str, schema, target: str, checkpoint: str,
                             min_date: str = "2022-01-01") -> None:
    """T18 on a streaming DataFrame of messages; resources deduplicated by id
    across batches: the first batch that brings an id decides, in it the newest message."""
    rows = message_rows(spark.readStream.schema(schema).parquet(source_dir), min_date)
    _append_first(rows, "resource_id", message_order(), target, checkpoint)


def new_run_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint location for one run."""
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")


def stream_blunder_state(spark: SparkSession, source_dir: str, schema, target_base: str, checkpoint: str,
                         files_per_batch: int | None = None) -> str:
    """I03 as a stream: the blunder event log is aggregated per game by a
    streaming aggregation (update mode: only games touched in the batch are
    emitted). A batch writes the games it touched to a log folder of its own and
    reads nothing; the end of a run merges the log since the last version into a
    new version of the state table (S09), so readers never see a half-written table.

    The newest complete version (one with Spark's ``_SUCCESS`` mark) of
    ``target_base`` is where a run's merge starts and, without new events, its
    result; None if there never was an event."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    stream = reader.parquet(source_dir)
    obs = F.col("kind") == "observe"
    agg = stream.groupBy("game_id").agg(
        F.max_by(F.when(obs, F.struct("loss", "fen", "player", "opening")),
                 F.when(obs, F.struct(F.col("loss"), -F.col("ts")))).alias("best"),
        F.max(F.when(obs, F.col("ts"))).alias("last_seen"),
        F.max_by(F.col("kind"), F.struct(F.col("ts"), F.when(F.col("kind") == "observe", 0)
                                          .when(F.col("kind") == "reset", 1).otherwise(2))).alias("last_kind"))

    def epochs(folder: str, prefix: str) -> list[int]:
        """Numbers of the folder's complete versions or batches, in order."""
        return sorted(int(n[1:]) for n in _children(spark, folder) if n.startswith(prefix) and "_SUCCESS" in _children(spark, f"{folder}/{n}"))

    def log(df: DataFrame, epoch: int) -> None:
        df.filter(F.col("best").isNotNull()).select(
            "game_id", F.col("best.player").alias("player"), F.col("best.opening").alias("opening"),
            F.col("best.fen").alias("fen"), F.col("best.loss").alias("loss"), "last_seen",
            (F.col("last_kind") == "upload").alias("uploaded"), F.lit(epoch).cast("long").alias("epoch")
        ).write.mode("overwrite").parquet(f"{target_base}/log/e{epoch:09d}")

    with _state_on_disk(spark):
        q = (agg.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(log)
             .trigger(availableNow=True).start())
        q.awaitTermination()
    versions = epochs(target_base, "v")
    last = f"{target_base}/v{versions[-1]:09d}" if versions else None
    since = [e for e in epochs(f"{target_base}/log", "e") if not versions or e > versions[-1]]
    if not since:
        return last
    logged = spark.read.parquet(*[f"{target_base}/log/e{e:09d}" for e in since])
    rest = [c for c in logged.columns if c not in ("game_id", "epoch")]
    state = logged.groupBy("game_id").agg(F.max_by(F.struct(*rest), "epoch").alias("row")).select("game_id", "row.*")
    if last is not None:
        state = spark.read.parquet(last).join(state.select("game_id"), "game_id", "left_anti").unionByName(state)
    path = f"{target_base}/v{since[-1]:09d}"
    state.write.mode("overwrite").parquet(path)
    return path

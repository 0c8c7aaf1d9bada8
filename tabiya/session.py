"""Session construction and cluster-safe scratch locations."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job of the library relies on: AQE re-plans joins and
# coalesces partitions at run time, skew-join splits hot keys, UTC keeps
# timestamps comparable with other engines, and no UI server is started.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # checkpoints whose DataFrames are gone are deleted
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # a broadcast side must stay small: anything above 32 MB is shuffled
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    # deep CASE chains (keyword rules) make inferred-constraint propagation
    # explode the optimised plan; the inferred IS NOT NULL filters it adds are
    # not needed by these plans
    "spark.sql.constraintPropagation.enabled": "false",
}


RUNTIME_SQL_CONF = {k: v for k, v in DEFAULT_CONF.items()
                    if k.startswith("spark.sql.") and not k.startswith("spark.sql.execution.arrow")}


def apply_sql_conf(spark: SparkSession) -> None:
    """Set the runtime SQL settings the plans rely on in a session built elsewhere."""
    for k, v in RUNTIME_SQL_CONF.items():
        try:
            if spark.conf.get(k, None) != v:
                spark.conf.set(k, v)
        except Exception:  # noqa: BLE001 - a locked setting keeps its value
            pass


def get_session(app: str = "tabiya", cpus: int | str = "*", shuffle_partitions: int = 8,
                extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = os.environ.get("TABIYA_DRIVER_MEMORY", "8g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the setting points at shared storage and is used as is. Where it
    is unset, a local session (tests) gets a private folder; on a cluster that
    folder would be out of the executors' sight, so it is an error.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        path = spark.sparkContext.getCheckpointDir()
    if not path:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        path = tempfile.mkdtemp(prefix="tabiya-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A location under the shared checkpoint folder for written tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"

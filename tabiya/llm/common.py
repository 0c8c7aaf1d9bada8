"""Shared-folder tables, code shipping and Arrow limits used by the operators."""

from __future__ import annotations

import ctypes
import os
import tempfile
import uuid
import zipfile

import pyarrow as pa
import tabiya
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

#: Arrow batches stay small so that a run of very long texts does not meet in one worker.
ARROW_RECORDS = "1000"
ARROW_BYTES = str(16 << 20)


def ship(spark: SparkSession) -> SparkSession:
    """Send the package to the executors once per Spark context and bound Arrow batches.

    Python workers need the operators' modules; on a cluster they are not on
    the workers' path, so the package travels as a zip file.
    """
    sc = spark.sparkContext
    if not getattr(sc, "_tabiya_shipped", False):
        root = os.path.dirname(os.path.abspath(tabiya.__file__))
        target = os.path.join(tempfile.mkdtemp(prefix="tabiya-zip-"), "tabiya.zip")
        with zipfile.ZipFile(target, "w") as z:
            for folder, _, names in os.walk(root):
                for name in sorted(names):
                    if name.endswith(".py"):
                        full = os.path.join(folder, name)
                        z.write(full, os.path.join("tabiya", os.path.relpath(full, root)))
        sc.addPyFile(target)
        sc._tabiya_shipped = True
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_RECORDS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)
    return spark


def give_back() -> None:
    """Hand the process's free memory back to the system, where the C library can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def lean(run):
    """``run`` for ``mapInArrow``, with the free memory handed back at a task's end.

    Workers live on between tasks and stages; what they held at most would stand beside the executor's heap
    all the while.
    """
    def task(batches):
        yield from run(batches)
        give_back()

    return task


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder name under the shared folder of ``spark.checkpoint.dir``."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Cuts the lineage: later stages and retries after a lost executor read the
    files, and a value that depends on the partitioning stays what it was.
    """
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.option("compression", "zstd").partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path) if not partition_by else spark.read.parquet(path)


def hashed_sample(df: DataFrame, key: str, limit: int) -> DataFrame:
    """The ``limit`` rows with the smallest hashes of ``key`` (ties by hash stay together, then cut).

    The border is found among hashes alone: a plain sort with a limit would send ``limit`` whole rows of
    every task to the driver.
    """
    hashed = df.withColumn("_h", F.xxhash64(F.col(key).cast("string")))
    border = hashed.select("_h").orderBy("_h").limit(limit).agg(F.max("_h")).first()[0]
    if border is None:
        return df.limit(0)
    return hashed.filter(F.col("_h") <= border).orderBy("_h").limit(limit).drop("_h")


def drop_stored(df: DataFrame) -> None:
    """Delete the files behind a table made by :func:`stored` (they are no longer needed)."""
    spark = df.sparkSession
    jvm = spark._jvm
    base = ensure_checkpoint_dir(spark).rstrip("/")
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if base.split(":", 1)[-1].lstrip("/") in folder:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)

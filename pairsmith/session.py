"""What the jobs need from a Spark session."""

from __future__ import annotations

import gc
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def prepare(spark: SparkSession) -> SparkSession:
    """Set the one SQL option the reply jobs rely on.

    A JSON object with a repeated key keeps the last value, as most JSON readers do; Spark's
    VARIANT parser otherwise calls such an object malformed.
    """
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder that every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local-mode session may fall back to a folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="pairsmith-")
    spark.sparkContext.setCheckpointDir(folder)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


_written: ContextVar[list[str] | None] = ContextVar("written", default=None)


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and continue from that table.

    Used where a result feeds several jobs, or is too dear to compute again after an executor
    is lost (model replies, embeddings). Columns stay prunable, unlike with an RDD checkpoint.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.mode("error").parquet(path)
    if _written.get() is not None:
        _written.get().append(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, key: str = "id") -> DataFrame:
    """Use all cores for a table that comes in fewer splits than there are cores.

    A large table has enough splits and is left alone, so no shuffle is added at scale. Hashing by
    a key, unlike dealing rows out in turn, sends a row to the same task when a stage is retried.
    """
    execution = df._jdf.queryExecution()
    if key not in df.columns or re.search(r"(?<!Broadcast)Exchange", execution.executedPlan().toString()):
        return df  # the last shuffle has set the number of partitions; asking for it would run it
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if execution.toRdd().getNumPartitions() < cores else df


BATCH_BYTES = "4m"


def bounded_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches that go to Python workers by bytes, unless the session has a bound of its own: ten
    thousand long texts are too many at once."""
    if spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None) is None:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark's cleaner drop the shuffle files of finished jobs, whose plans nothing refers to any more."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def exists(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete, at the end, the tables that ``materialise`` writes inside this block, and no others.

    What is to outlive the block has to be stored in it.
    """
    paths: list[str] = []
    outer = _written.set(paths)
    try:
        yield
    finally:
        _written.reset(outer)
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        for path in paths:
            target = hadoop(path)
            target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
        free_shuffles(spark)

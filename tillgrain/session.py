"""Session settings and the two ways a job may write intermediate data.

A cluster names its shared folder in ``spark.checkpoint.dir``. Only where that is unset, and only on
a local master, does the library fall back to a temporary folder of its own, which it removes at
exit. In a named folder each application writes below its own id, and ``clear_scratch`` empties that.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    # Columns are built by the hundred; recording the call site of each one costs more than it tells.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}

# Tables are written in this codec, a third smaller than in the default one.
CODEC = "zstd"
DROPPED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(name: str = "tillgrain", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the session names it."""
    sc = spark.sparkContext
    named = (spark.conf.get("spark.checkpoint.dir", None)
             or sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir())
    if named:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(named)
        return named
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="tillgrain-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


def _application_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark).rstrip('/')}/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; nothing else writes there."""
    return f"{_application_folder(spark)}/{label}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete what this application has written through ``scratch_path``. Frames that were built on
    it can no longer be read."""
    drop_folder(spark, _application_folder(spark))


def drop_folder(spark: SparkSession, folder: str) -> None:
    """Delete a folder below a scratch path that no later step reads."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def pin(df: DataFrame) -> DataFrame:
    """Compute once into a table below the shared folder, so that later passes see the very same
    rows, read only the columns they need, and survive the loss of an executor."""
    spark = df.sparkSession
    path = scratch_path(spark, "pinned")
    df.write.option("compression", CODEC).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Within, every execution deletes its shuffle files when it ends, so that a job of many steps takes
    the disk of its largest step. Otherwise they stay until the driver collects its garbage. A frame
    that is executed again shuffles again."""
    before = spark.conf.get(DROPPED, None)
    spark.conf.set(DROPPED, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(DROPPED)
        else:
            spark.conf.set(DROPPED, before)

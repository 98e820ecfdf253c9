"""The shared folder of the cluster, tables written there to cut lineage, and the package on workers."""

from __future__ import annotations

import os
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """Folder for stored steps: ``spark.checkpoint.dir``, else a folder of the session's warehouse.

    Both are places that all executors reach; the caller's settings are read and never changed.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return folder or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_steps"


def session_folder(spark: SparkSession) -> str:
    """Where the steps of this session lie, apart from those of others."""
    return f"{shared_folder(spark).rstrip('/')}/answerloom-{spark.sparkContext.applicationId}"


def fresh_path(spark: SparkSession, name: str) -> str:
    path = f"{session_folder(spark)}/{name}-{uuid4().hex}"
    for scope in _scopes.get():
        scope.paths.append(path)
    return path


class StepScope:
    """The steps stored while it is open; see :func:`temporary_steps`."""

    def __init__(self):
        self.paths: list[str] = []

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """Store ``df`` as a step that outlives the scope."""
        stored = write_through(df, name)
        self.paths.pop()
        return stored


_scopes: ContextVar[tuple[StepScope, ...]] = ContextVar("scopes", default=())


@contextmanager
def temporary_steps(spark: SparkSession) -> Iterator[StepScope]:
    """Delete the steps stored inside at the end, but for those kept.

    For work whose result is stored, or is no frame: what it left on the way is of no use.
    """
    scope = StepScope()
    token = _scopes.set((*_scopes.get(), scope))
    try:
        yield scope
    finally:
        _scopes.reset(token)
        for path in scope.paths:
            drop_path(spark, path)


def write_through(df: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """Write ``df`` to the shared folder and return the table read back.

    Later stages then restart from files instead of recomputing what came before,
    and frames used more than once are computed once.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    store_rows(df, path, *partition_by)
    return spark.read.schema(df.schema).parquet(path)


def store_rows(df: DataFrame, path: str, *partition_by: str) -> None:
    """Write ``df`` to the files of a step, beside what they hold already."""
    with freed_shuffles(df.sparkSession):
        df.write.mode("append").partitionBy(*partition_by).option("compression", "zstd").parquet(path)


FREE_SETTING = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Delete the shuffle files of each write when it ends, while it is open.

    What is stored is read from its own files. Left to the collector, shuffles stay on disk until
    the driver's memory happens to be cleaned.
    """
    before = spark.conf.get(FREE_SETTING, "false")
    spark.conf.set(FREE_SETTING, "true")
    try:
        yield
    finally:
        spark.conf.set(FREE_SETTING, before)


BATCH_SETTING, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "4m"


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Hand texts and sets to Python in batches of a few megabytes, while it is open.

    Each task holds a batch several times over, in the JVM and in Python.
    """
    before = spark.conf.get(BATCH_SETTING)
    spark.conf.set(BATCH_SETTING, BATCH_BYTES)
    try:
        yield
    finally:
        spark.conf.set(BATCH_SETTING, before)


def drop_path(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def drop_steps(spark: SparkSession) -> None:
    """Delete all stored steps of this session; frames that still read them end with it."""
    drop_path(spark, session_folder(spark))


def ship_package(spark: SparkSession) -> None:
    """Give this package to the workers, once a session, so that its functions load anywhere.

    Functions of a module reach a worker by name; a worker started in another folder finds
    the module only in what was shipped.
    """
    context = spark.sparkContext
    if getattr(context, "_answerloom_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(context._temp_dir, "answerloom.zip")  # the driver's own folder of this session
    with zipfile.ZipFile(target, "w") as archive:
        for folder, _, names in os.walk(root):
            for name in sorted(n for n in names if n.endswith(".py")):
                path = os.path.join(folder, name)
                archive.write(path, os.path.relpath(path, os.path.dirname(root)))
    context.addPyFile(target)  # the driver serves this file to the executors
    context._answerloom_shipped = True


def spread(scan: DataFrame) -> DataFrame:
    """Deal rows out to all cores when a table comes in fewer splits than there are cores.

    One large file with one row group is one split, and all work on its rows would run in
    one task. Tables of many splits are left as they are.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan

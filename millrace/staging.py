"""Written tables in the shared folder of the cluster.

A written table cuts lineage: a lost executor costs the tasks it was running and
not the steps before them. The folder is the one the session names in
``spark.checkpoint.dir``.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_LOCAL_DIRS: dict[str, str] = {}
_RUN_DIR: ContextVar[str | None] = ContextVar("run_dir", default=None)


def shared_dir(spark: SparkSession) -> str:
    """Folder for written tables. A temporary folder is used in local mode only."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if context.applicationId not in _LOCAL_DIRS:
        _LOCAL_DIRS[context.applicationId] = tempfile.mkdtemp(prefix="millrace-stage-")
    return _LOCAL_DIRS[context.applicationId]


def qualified(spark: SparkSession, path: str) -> str:
    """A path with its file system; a plain one lies on the default file system of the session.

    For paths that tasks open by themselves: Spark's readers and writers qualify theirs.
    """
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    uri = system.makeQualified(place).toString()
    return f"file://{uri.removeprefix('file:')}" if uri.startswith("file:/") else uri


def new_path(spark: SparkSession, name: str) -> str:
    """Unused path in the folder of the current run, or below the shared folder."""
    folder = _RUN_DIR.get() or f"{shared_dir(spark)}/{spark.sparkContext.applicationId}"
    return f"{folder}/{name}-{uuid.uuid4().hex}"


@contextmanager
def run_folder(spark: SparkSession) -> Iterator[str]:
    """Keep the tables written inside in one new folder, and delete that folder at the end.

    For jobs whose results are written elsewhere before they leave the block.
    """
    folder = new_path(spark, "run")
    token = _RUN_DIR.set(folder)
    try:
        yield folder
    finally:
        _RUN_DIR.reset(token)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def bound_batches(spark: SparkSession, rows: int = 256) -> None:
    """Let Python tasks of a session hold few rows at once, since texts and files may be very long."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= rows:
        spark.conf.set(key, str(rows))


def stage(df: DataFrame, name: str, *, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write a table once and return a reader of it."""
    spark = df.sparkSession
    path = new_path(spark, name)
    writer = df.write.option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)

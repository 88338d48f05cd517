"""Files that tasks write and read by URI: a mounted path, or any store that pyarrow reaches."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

import millrace

_SHIPPED: set[str] = set()


def store(uri: str):
    """File system and path of a URI. A plain path is one of a mounted file system; writers qualify
    their folder by the session's default file system first."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if ":/" in uri else f"file://{uri}")


def open_output(uri: str):
    """A new file; folders above it are made. The caller closes it."""
    system, path = store(uri)
    system.create_dir(path.rpartition("/")[0], recursive=True)
    return system.open_output_stream(path, compression=None)


def open_input(uri: str):
    """A file for reading from any place in it."""
    system, path = store(uri)
    return system.open_input_file(path)


def attempt_name(folder: str, kind: str, partition: int, number: int, suffix: str) -> str:
    """A name that no other attempt of the same task uses.

    Which files count is said by the table of files that the same job writes: Spark commits the
    rows of one attempt per task, so files of lost attempts are never read.
    """
    return f"{folder}/{kind}-{partition:06d}-{number:04d}-{uuid.uuid4().hex[:12]}{suffix}"


def prepare_tasks(spark: SparkSession, rows: int = 256) -> None:
    """Make a session ready for Python tasks of this package.

    Arrow batches are to hold few rows, since texts may be very long. The package travels with the
    session's files, once per application, so that executors need no copy of it.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) > rows:
        spark.conf.set(key, str(rows))
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        root = Path(millrace.__file__).parent
        archive = Path(tempfile.mkdtemp(prefix="millrace-")) / "millrace-package.zip"
        with zipfile.ZipFile(archive, "w") as file:
            for path in sorted(root.rglob("*.py")):
                file.write(path, path.relative_to(root.parent))
        context.addPyFile(str(archive))
        _SHIPPED.add(context.applicationId)

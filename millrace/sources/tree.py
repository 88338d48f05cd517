"""Source trees on a file system that all executors see.

Listing and reading are separate Spark jobs. The listing walks directories in rounds:
a task lists a bounded number of entries and hands the directories it has not reached
to the next round, where they are spread over all tasks. The rules on paths and sizes
then run on the listing, and only the files that are left are read, spread by bytes.
"""

from __future__ import annotations

import os
import sys
from collections import deque
from collections.abc import Iterator, Sequence
from functools import reduce

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.staging import bound_batches, stage

_PENDING = "source_ord int, root string, directory binary, trail array<binary>"
_LISTED = (
    "source_ord int, root string, relative_path string, file binary, is_dir boolean, "
    "pending boolean, size bigint, trail array<binary>"
)
_FIRST_BUDGET, _BUDGET_GROWTH, _LAST_BUDGET = 2_000, 10, 200_000
_LISTING_ROWS = 5_000
_BATCH_BYTES = 4 << 20
_BATCH_FILES = 1_000
_TASK_BYTES = 128 << 20
_TASK_FILES = 20_000


def _shown(path: bytes) -> str:
    """Path as text; bytes that are not UTF-8 are written as escapes."""
    return path.decode("utf-8", "backslashreplace")


def list_tree(
    spark: SparkSession,
    roots: Sequence[tuple[int, str]],
    *,
    exclude_dirs: Sequence[str] = (),
    exclude_paths: Sequence[str] = (),
    follow_symlinks: bool = False,
    only_below: Sequence[str] | None = None,
) -> DataFrame:
    """Entries below the roots: ``source_ord, root, relative_path, file, is_dir, size``.

    ``exclude_dirs`` prunes directories by name and ``exclude_paths`` by full path, both
    below the root only. ``only_below`` restricts the walk to these relative folders and
    the way to them. Links to directories are entered on request; a directory that
    is already on the way to the link is not entered again.
    """
    expand = _expander(
        frozenset(os.fsencode(d) for d in exclude_dirs),
        frozenset(os.fsencode(p) for p in exclude_paths),
        follow_symlinks,
        None if only_below is None else [os.fsencode(p) for p in only_below],
    )
    pending = spark.createDataFrame(
        [(o, r, os.fsencode(r), [os.fsencode(os.path.realpath(r))]) for o, r in roots], _PENDING
    )
    bound_batches(spark)
    waiting, budget, rounds = len(roots), _FIRST_BUDGET, []
    while waiting:
        tasks = min(waiting, 4 * spark.sparkContext.defaultParallelism)
        spread = pending.repartition(tasks, "source_ord", "directory")
        listed = stage(spread.mapInPandas(expand(budget), _LISTED), "listing")
        rounds.append(listed.filter(~F.col("pending")).drop("pending", "trail"))
        pending = listed.filter("pending").select(
            "source_ord", "root", F.col("file").alias("directory"), "trail"
        )
        waiting = pending.count()
        budget = min(budget * _BUDGET_GROWTH, _LAST_BUDGET)
    if not rounds:
        return spark.createDataFrame([], _LISTED).drop("pending", "trail")
    return reduce(DataFrame.unionByName, rounds)


def _expander(excluded_names, excluded_paths, follow, only_below):
    """Build the task function of one listing round."""

    def wanted(relative: bytes) -> bool:
        if only_below is None:
            return True
        return any(
            relative == p or relative.startswith(p + b"/") or p.startswith(relative + b"/")
            for p in only_below
        )

    def enterable(entry: os.DirEntry, relative: bytes, trail: list[bytes]) -> list[bytes] | None:
        """Trail of real directories below an entry, or None to stay out of it."""
        if entry.name in excluded_names or entry.path in excluded_paths or not wanted(relative):
            return None
        if not follow:
            return None if entry.is_symlink() else trail
        real = os.path.realpath(entry.path)
        return None if real in trail else [*trail, real]

    def entries(directory: bytes) -> Iterator[os.DirEntry]:
        try:
            with os.scandir(directory) as found:
                yield from found
        except OSError:
            return

    def for_budget(budget: int):
        def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            rows: list[tuple] = []
            queue = deque(
                (o, root, bytes(d), [bytes(t) for t in trail])
                for batch in batches
                for o, root, d, trail in batch.itertuples(index=False)
            )
            seen = 0
            while queue:
                source_ord, root, directory, trail = queue.popleft()
                if seen >= budget:
                    rows.append((source_ord, root, "", directory, True, True, None, trail))
                    continue
                base = os.fsencode(root).rstrip(b"/")
                for entry in entries(directory):
                    seen += 1
                    relative = entry.path[len(base) + 1 :]
                    try:
                        is_dir = entry.is_dir()
                        if not is_dir and not entry.is_file():
                            continue
                        size = None if is_dir else entry.stat().st_size
                        below = enterable(entry, relative, trail) if is_dir else None
                    except OSError:
                        continue
                    rows.append(
                        (source_ord, root, _shown(relative), entry.path, is_dir, False, size, None)
                    )
                    if below is not None:
                        queue.append((source_ord, root, entry.path, below))
                    if len(rows) >= _LISTING_ROWS:
                        yield _frame(rows)
                        rows = []
            if rows:
                yield _frame(rows)

        return walk

    return for_budget


def _frame(rows: list[tuple]) -> pd.DataFrame:
    names = [part.split()[0] for part in _LISTED.split(", ")]
    return pd.DataFrame(rows, columns=names).astype({"size": "Int64"})


def spread(files: DataFrame, columns: Sequence[str], key: Sequence[str]) -> DataFrame:
    """Spread files or ranges of files by a hash of their unique key, over as many tasks as
    their ``size`` needs."""
    load = files.agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("files")).first()
    tasks = max(
        min(files.sparkSession.sparkContext.defaultParallelism, load["files"] or 1),
        -(-(load["bytes"] or 0) // _TASK_BYTES),
        -(-load["files"] // _TASK_FILES),
    )
    return files.select(*columns).repartition(tasks, *key)


def read_files(files: DataFrame) -> DataFrame:
    """Bytes of each listed file as ``raw``; null when it could not be read.

    A task passes on batches of bounded size.
    """
    columns = ["source_ord", "relative_path", "size", "file"]
    bound_batches(files.sparkSession)

    def load_bytes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows, held = [], 0
        for batch in batches:
            for source_ord, relative_path, size, file in batch.itertuples(index=False):
                try:
                    with open(bytes(file), "rb") as handle:
                        raw = handle.read()
                except OSError:
                    raw = None
                rows.append((source_ord, relative_path, size, raw))
                held += len(raw or b"")
                if held >= _BATCH_BYTES or len(rows) >= _BATCH_FILES:
                    yield pd.DataFrame(rows, columns=[*columns[:3], "raw"])
                    rows, held = [], 0
        if rows:
            yield pd.DataFrame(rows, columns=[*columns[:3], "raw"])

    return spread(files, columns, ["source_ord", "relative_path"]).mapInPandas(
        load_bytes, "source_ord int, relative_path string, size bigint, raw binary"
    )


# Task functions travel with the job, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

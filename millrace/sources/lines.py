"""Lines of listed files, read by byte ranges.

A file over one range is read twice by as many tasks as it has ranges. The first pass counts the
lines that begin in each range and finds whether the bytes are UTF-8; sums over the earlier
ranges of a file give the first line number of a range. The second pass reads the lines.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator
from typing import BinaryIO

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from millrace.operators.joins import sized_join
from millrace.operators.positions import with_totals_before
from millrace.sources.tree import spread
from millrace.staging import stage

# A range of a file. A smaller file is decoded whole.
RANGE_BYTES = 32 << 20
_BLOCK_BYTES = 1 << 20
_BATCH_BYTES = 32 << 20
_FILE = ["source_ord", "relative_path", "file"]
_KEY = ["source_ord", "file"]
_LINES = "source_ord int, path string, line_no bigint, line string"
_COUNTS = (
    "source_ord int, relative_path string, file binary, begin bigint, size bigint, "
    "is_utf8 boolean, utf8_lines bigint, latin_lines bigint"
)
# Line ends of one byte in UTF-8 and Latin-1 alike; no byte of a longer character equals one.
_ENDS = tuple(bytes([b]) for b in b"\n\r\v\f\x1c\x1d\x1e")
_END = re.compile(rb"\r\n|[\n\r\v\f\x1c\x1d\x1e]")


def read_lines(files: DataFrame, *, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Lines of listed files as ``source_ord, path, line_no, line``; ``line_no`` from 0.

    A file is read as UTF-8 when all of it is valid UTF-8, else as Latin-1. A file that cannot be
    read, in any of its ranges, has no lines; neither has an empty one. A task holds one
    range at most, or one line that is longer. Of a file over one range that grows after the
    listing, the lines that begin within the listed size are read.
    """
    whole = spread(files.filter(F.col("size") <= range_bytes), _FILE, ["source_ord", "relative_path"])
    read = whole.mapInPandas(_whole_files, _LINES)
    large = files.filter(F.col("size") > range_bytes)
    if large.isEmpty():
        return read
    ranges = large.select(*_FILE, "size", F.explode(F.sequence(
        F.lit(0).cast("bigint"), F.col("size") - 1, F.lit(range_bytes).cast("bigint"))).alias("begin")
    ).withColumn("size", F.least(F.col("size") - F.col("begin"), F.lit(range_bytes).cast("bigint")))
    parts = [*_FILE, "begin", "size"]
    counted = stage(
        spread(ranges, parts, [*_KEY, "begin"]).mapInPandas(_counts, _COUNTS), "line-counts")
    encodings = counted.groupBy(*_KEY).agg(
        F.bool_and("is_utf8").alias("utf8"), F.bool_or(F.col("is_utf8").isNull()).alias("_failed")
    ).filter(~F.col("_failed")).drop("_failed")
    lines = sized_join(counted, encodings, _KEY).select(
        *parts, "utf8", F.when(F.col("utf8"), F.col("utf8_lines")).otherwise(F.col("latin_lines")).alias("lines"))
    placed = with_totals_before(lines, _KEY, ["begin"], "lines", name="first_line")
    return read.unionByName(
        spread(placed, [*parts, "utf8", "first_line"], [*_KEY, "begin"]).mapInPandas(_ranges, _LINES))


def _whole_files(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    def found() -> Iterator[tuple]:
        for batch in batches:
            for source_ord, path, file in batch.itertuples(index=False):
                try:
                    with open(bytes(file), "rb") as handle:
                        raw = handle.read()
                except OSError:
                    continue
                for number, line in enumerate(_decoded(raw).splitlines()):
                    yield source_ord, path, number, line

    return _batched(found())


def _counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A row per range; its three results are null when it could not be read."""
    names = [part.split()[0] for part in _COUNTS.split(", ")]
    for batch in batches:
        rows = []
        for source_ord, path, file, begin, size in batch.itertuples(index=False):
            utf8, utf8_lines, latin_lines = True, 0, 0
            try:
                for piece in pieces(bytes(file), begin, begin + size):
                    latin = len(piece.decode("latin-1").splitlines())
                    latin_lines += latin
                    try:
                        utf8_lines += (
                            latin if piece.isascii() else len(piece.decode("utf-8").splitlines()))
                    except UnicodeDecodeError:
                        utf8 = False
            except OSError:
                utf8 = utf8_lines = latin_lines = None
            rows.append((source_ord, path, file, begin, size, utf8, utf8_lines, latin_lines))
        yield pd.DataFrame(rows, columns=names).astype(
            {"is_utf8": "boolean", "utf8_lines": "Int64", "latin_lines": "Int64"})


def _ranges(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Lines of counted ranges. A range that cannot be read any more fails its task."""

    def found() -> Iterator[tuple]:
        for batch in batches:
            for source_ord, path, file, begin, size, utf8, number in batch.itertuples(index=False):
                for piece in pieces(bytes(file), begin, begin + size):
                    for line in piece.decode("utf-8" if utf8 else "latin-1").splitlines():
                        yield source_ord, path, number, line
                        number += 1

    return _batched(found())


def _batched(rows: Iterator[tuple]) -> Iterator[pd.DataFrame]:
    names = [part.split()[0] for part in _LINES.split(", ")]
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[-1]) + 32
        if size >= _BATCH_BYTES:
            yield pd.DataFrame(held, columns=names)
            held, size = [], 0
    if held:
        yield pd.DataFrame(held, columns=names)


def _decoded(raw: bytes) -> str:
    try:
        return raw.decode("utf-8")
    except UnicodeDecodeError:
        return raw.decode("latin-1")


def pieces(file: bytes, begin: int, end: int) -> Iterator[bytes]:
    """Bytes of the lines that begin in ``[begin, end)``, in pieces of whole lines.

    The last line may reach beyond ``end``. Only line ends of one byte are looked for, so a piece
    can hold further lines, and every piece can be decoded and split by itself.
    """
    with open(file, "rb") as handle:
        at = max(0, begin - 1)
        handle.seek(at)
        inside, held = begin == 0, []
        for block in _blocks(handle):
            low = 0
            if not inside:
                first = _END.search(block)
                low = first.end() if first else len(block)
                if at + low >= end:
                    return
                if first is None:
                    at += low
                    continue
                inside = True
            if at + len(block) >= end:
                last = _END.search(block, max(low, end - 1 - at))
                if last:
                    yield b"".join([*held, block[low : last.end()]])
                    return
            cut = max(block.rfind(mark, low) for mark in _ENDS) + 1
            if cut:
                yield b"".join([*held, block[low:cut]])
                held, low = [], cut
            held.append(block[low:])
            at += len(block)
    rest = b"".join(held)
    if rest:
        yield rest


def _blocks(handle: BinaryIO) -> Iterator[bytes]:
    """Blocks of a file. None but the last ends between the two bytes of a line end."""
    while block := handle.read(_BLOCK_BYTES):
        while block.endswith(b"\r") and (more := handle.read(1)):
            block += more
        yield block


# Task functions travel with the job, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

"""Overlapping windows of lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from millrace.config import ChunkOptions, PreprocessOptions
from millrace.functions import text
from millrace.operators.positions import with_positions


def preprocess_record(records: DataFrame, options: PreprocessOptions) -> DataFrame:
    """Normalise ``content``; all other columns, the hash too, stay as they are."""
    normalised = text.normalise_content(
        "content",
        whitespace=options.normalize_whitespace,
        strip_empty_lines=options.strip_empty_lines,
        max_line_length=options.max_line_length,
    )
    return records.withColumn("content", normalised)


def last_start(lines: Column, options: ChunkOptions) -> Column:
    """0-based first line of the last window that may start: a window that reaches
    the last line ends the file."""
    return F.greatest(F.lit(0), lines - options.overlap - 1)


def chunk_lines(
    records: DataFrame,
    options: ChunkOptions,
    *,
    keep_empty: bool = False,
    unix_only: bool = False,
) -> DataFrame:
    """One row per window: the columns of its record, ``start_line``, ``end_line``
    (1-based, inclusive) and the text of the window as ``content``.

    The window starts are exploded and each window is sliced from the line array in
    the same generated code, so that the windows of a file never exist at once.
    ``keep_empty`` gives records without lines one row with null chunk columns.
    """
    others = [c for c in records.columns if c != "content"]
    starts = F.when(
        F.col("_lines") > 0,
        F.sequence(F.lit(0).cast("bigint"), last_start(F.col("_lines"), options),
                   F.lit(options.step).cast("bigint")),
    )
    explode = F.explode_outer if keep_empty else F.explode
    start, size = F.col("_start"), F.lit(options.target_chunk_size)
    end = F.least(F.col("_lines"), start + size)
    return (
        records.withColumn("_pieces", text.line_pieces("content", unix_only=unix_only))
        .select(*others, "_pieces", text.piece_count("_pieces").alias("_lines"))
        .select(*others, "_pieces", "_lines", explode(starts).alias("_start"))
        .select(
            *others,
            (start + 1).alias("start_line"),
            F.when(start.isNotNull(), end).alias("end_line"),
            F.array_join(
                F.slice("_pieces", (start + 1).cast("int"), (end - start).cast("int")), "\n"
            ).alias("content"),
        )
    )


def windows_of_line(
    position: Column, lines: Column, options: ChunkOptions
) -> tuple[Column, Column]:
    """First and last window, numbered from 0, that hold the line at a 0-based position."""
    step, size = F.lit(options.step), options.target_chunk_size
    lowest = F.greatest(F.lit(0), F.ceil((position - size + 1) / step)).cast("bigint")
    highest = F.least(F.floor(position / step), F.floor(last_start(lines, options) / step))
    return lowest, highest.cast("bigint")


def long_text_windows(
    lines: DataFrame, group: Sequence[str], order: Sequence[str], options: ChunkOptions
) -> DataFrame:
    """Windows of a text given as one row per line (column ``line``).

    For texts too large for one row. Each line is sent to the windows that hold it, so
    a group of the aggregate is one window, bounded by the window length.
    """
    placed = with_positions(lines, group, order)
    step, size = options.step, options.target_chunk_size
    lowest, highest = windows_of_line(F.col("position"), F.col("group_size"), options)
    window = F.sort_array(F.collect_list(F.struct("position", "line")))
    return (
        placed.filter(lowest <= highest)
        .select(
            *group, "position", "line", "group_size",
            F.explode(F.sequence(lowest, highest)).alias("_window"),
        )
        .groupBy(*group, "_window")
        .agg(F.first("group_size").alias("group_size"), window.alias("_held"))
        .select(
            *group,
            (F.col("_window") * step + 1).alias("start_line"),
            F.least(F.col("group_size"), F.col("_window") * step + size).alias("end_line"),
            F.array_join(F.col("_held.line"), "\n").alias("content"),
        )
    )


def with_chunk_hash(chunks: DataFrame) -> DataFrame:
    """SHA-1 of the chunk text. ``file_hash`` remains the hash that is written out."""
    return chunks.withColumn("chunk_hash", text.fingerprint("content"))

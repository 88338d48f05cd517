"""Optional steps, off in the default build: further filters, wrapping, other chunk units, reports."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from millrace.config import ChunkOptions
from millrace.functions import fixed, paths, text
from millrace.operators.chunking import last_start

SHELL_LANGUAGES = ("shell", "terminal", "powershell", "cmd")


# --- filters -------------------------------------------------------------------------------------
def exclude_extensions(files: DataFrame, excluded: Sequence[str]) -> DataFrame:
    """Drop files with one of the suffixes; needs no content."""
    lowered = [e.lower() for e in excluded]
    return files.filter(~paths.extension("relative_path").isin(*lowered)) if lowered else files


def exclude_globs(files: DataFrame, patterns: Sequence[str]) -> DataFrame:
    """Drop files whose path or name matches a pattern; needs no content."""
    return files.filter(~paths.matches_globs("relative_path", patterns)) if patterns else files


def holds_forbidden(content: Column, patterns: Sequence[str]) -> Column:
    """True when any of the (Java) patterns is found in a text."""
    found = F.lit(False)
    for pattern in patterns:
        found |= content.rlike(pattern)
    return F.coalesce(found, F.lit(False))


def reject_forbidden(records: DataFrame, patterns: Sequence[str]) -> DataFrame:
    return records.filter(~holds_forbidden(F.col("content"), patterns))


# --- text ----------------------------------------------------------------------------------------
def soft_wrap(content: str | Column, width: int) -> Column:
    """Break longer lines after every ``width`` code points; no character is lost."""
    unix = text.unix_lines(content)
    return F.regexp_replace(unix, rf"([^\n]{{{int(width)}}})(?=[^\n])", "$1\n")


def canonicalize_shell(records: DataFrame) -> DataFrame:
    """Lines of shell and terminal records without prompts, words joined by single spaces."""
    lines = F.transform(
        text.split_lines("content"), lambda x: text.collapse_command(text.strip_prompt(text.strip_text(x)))
    )
    shell = F.col("language").isin(*SHELL_LANGUAGES)
    return records.withColumn(
        "content", F.when(shell, F.array_join(lines, "\n")).otherwise(F.col("content"))
    )


# --- chunks --------------------------------------------------------------------------------------
def _windows(
    records: DataFrame, units: Column, count: Column, options: ChunkOptions, keep_empty: bool
) -> DataFrame:
    """One row per window with ``_units``, its 0-based ``_start`` and the ``_count`` of units; with
    ``keep_empty`` also one without a start for a record without units."""
    others = [c for c in records.columns if c != "content"]
    step = F.lit(options.step).cast("bigint")
    starts = F.when(F.col("_count") > 0, F.sequence(
        F.lit(0).cast("bigint"), last_start(F.col("_count"), options), step))
    return (
        records.withColumn("_units", units).withColumn("_count", count.cast("bigint"))
        .select(*others, "_units", "_count",
                (F.explode_outer if keep_empty else F.explode)(starts).alias("_start"))
    )


def _end(options: ChunkOptions) -> Column:
    last = F.least("_count", F.col("_start") + options.target_chunk_size)
    return F.when(F.col("_start").isNotNull(), last)


def chunk_characters(records: DataFrame, options: ChunkOptions, *, keep_empty: bool = False) -> DataFrame:
    """Windows of ``target_chunk_size`` code points that overlap; ``start`` and ``end`` are 1-based.

    A text is cut once into blocks of one step, of which each window takes as many as it covers,
    so the work is linear in the text.
    """
    step, size = options.step, options.target_chunk_size
    blocks = F.regexp_extract_all("content", F.lit(rf"(?s).{{1,{step}}}"), F.lit(0))
    cut = _windows(records, blocks, F.char_length("content"), options, keep_empty)
    held = F.slice("_units", (F.col("_start") / step + 1).cast("int"), F.lit(-(-size // step)))
    return cut.select(
        *[c for c in records.columns if c != "content"],
        (F.col("_start") + 1).alias("start"), _end(options).alias("end"),
        F.substring(F.array_join(held, ""), 1, size).alias("content"),
    )


def chunk_tokens(records: DataFrame, options: ChunkOptions, *, keep_empty: bool = False) -> DataFrame:
    """Windows of words between white space, joined by single spaces."""
    stripped, size = text.strip_text("content"), options.target_chunk_size
    words = F.when(stripped == "", F.array().cast("array<string>")).otherwise(
        F.split(stripped, f"{fixed.WHITESPACE_CLASS}+"))
    cut = _windows(records, words, F.size("_units"), options, keep_empty)
    return cut.select(
        *[c for c in records.columns if c != "content"],
        (F.col("_start") + 1).alias("start"), _end(options).alias("end"),
        F.array_join(F.slice("_units", (F.col("_start") + 1).cast("int"), F.lit(size)), " ").alias("content"),
    )


def first_chunks(chunks: DataFrame, options: ChunkOptions, most: int) -> DataFrame:
    """Only the first ``most`` windows of each file: an explicit cut, whose losses
    :func:`chunks_cut` counts. Rows of files without a window stay."""
    start = F.col("start_line")
    return chunks.filter(start.isNull() | (start <= (most - 1) * options.step + 1))


def chunks_cut(chunks: DataFrame, options: ChunkOptions, most: int) -> DataFrame:
    """How many windows that cut leaves out, as one row."""
    return chunks.agg(
        F.count_if(F.col("start_line") > (most - 1) * options.step + 1).alias("chunks_cut")
    )


# --- reports -------------------------------------------------------------------------------------
def language_coverage(records: DataFrame, sources: DataFrame) -> DataFrame:
    """Per source: languages asked for and not found, and found beyond those asked for.

    A set per source holds at most the languages of the suffix table.
    """
    found = records.groupBy("source_ord").agg(F.collect_set("language").alias("found"))
    none = F.array().cast("array<string>")
    joined = sources.select("source_ord", "languages").join(found, "source_ord", "left").withColumn(
        "found", F.coalesce("found", none))
    return joined.select(
        "source_ord",
        F.sort_array(F.array_except("languages", "found")).alias("missing"),
        F.sort_array(F.array_except("found", "languages")).alias("beyond"),
    )


def dedup_ratios(counters: DataFrame) -> DataFrame:
    """Share of scanned files and of generated chunks that were duplicates."""
    def share(part: str, whole: str) -> Column:
        return F.when(F.col(whole) > 0, F.col(part) / F.col(whole)).otherwise(0.0)

    return counters.select(
        share("files_deduplicated", "files_scanned").alias("file_ratio"),
        share("chunks_deduplicated", "chunks_generated").alias("chunk_ratio"),
    )


def estimate_run(records: DataFrame, options: ChunkOptions, shard_records: int) -> DataFrame:
    """Files, chunks and shards of a run from line counts alone; nothing is written. Lines are those
    that chunking sees: a final line break ends a line and does not begin another."""
    lines = text.piece_count(text.line_pieces("content"))
    chunks = F.when(lines > 0, F.floor(last_start(lines, options) / options.step) + 1).otherwise(0)
    total = F.coalesce(F.sum(chunks), F.lit(0)).cast("bigint")
    return records.agg(
        F.count(F.lit(1)).alias("files"), total.alias("chunks"),
        F.ceil(total / shard_records).cast("bigint").alias("shards"),
    )

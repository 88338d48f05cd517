"""Run statistics, aggregated from written rows. Accumulators are not used: a retried
task would count twice."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

COUNTERS = (
    "files_scanned",
    "files_emitted",
    "files_deduplicated",
    "files_filtered",
    "chunks_generated",
    "chunks_emitted",
    "chunks_deduplicated",
)


def file_rows(outcome: DataFrame) -> DataFrame:
    """One row per file: its first chunk, or its only row when it gave no chunk."""
    return outcome.filter(F.coalesce(F.col("start_line"), F.lit(1)) == 1)


def run_counters(outcome: DataFrame, unique: DataFrame, emitted: DataFrame) -> DataFrame:
    """The seven counters as one row.

    ``outcome`` has a row per chunk of every file, with ``passed``, and one row with a null
    ``start_line`` for a file without chunks. ``unique`` is the part of it from files that
    are not duplicates, ``emitted`` the chunks that survive.
    """
    first_row = F.coalesce(F.col("start_line"), F.lit(1)) == 1
    files = file_rows(outcome).agg(F.count(F.lit(1)).alias("files_scanned"))
    chunks = unique.agg(
        F.count_if(F.col("passed") & first_row).alias("files_emitted"),
        F.count_if(~F.col("passed")).alias("files_filtered"),
        F.count("start_line").alias("chunks_generated"),
    )
    kept = emitted.agg(F.count(F.lit(1)).alias("chunks_emitted"))
    return (
        _one_row(files, chunks, kept)
        .withColumn(
            "files_deduplicated",
            F.col("files_scanned") - F.col("files_emitted") - F.col("files_filtered"),
        )
        .withColumn("chunks_deduplicated", F.col("chunks_generated") - F.col("chunks_emitted"))
        .select(*COUNTERS)
    )


def _one_row(*parts: DataFrame) -> DataFrame:
    """Columns of several one-row tables side by side, without a join."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return stacked.agg(*[F.first(c, ignorenulls=True).alias(c) for c in stacked.columns])


def language_distribution(emitted: DataFrame) -> DataFrame:
    return emitted.groupBy("language").agg(F.count(F.lit(1)).alias("chunks"))


def source_file_counts(files: DataFrame) -> DataFrame:
    """Scanned files per source name; sources that share a name are added up."""
    return files.groupBy("source_name").agg(F.count(F.lit(1)).alias("files"))


def _sorted_map(counts: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """Count table as one map. There is one entry per language or per source."""
    entries = F.sort_array(F.collect_list(F.struct(key, value)))
    return counts.agg(F.map_from_entries(entries).alias(name))


def stats_document(
    counters: DataFrame, languages: DataFrame, sources: DataFrame, reasons: DataFrame | None = None
) -> DataFrame:
    """Counters and both maps, sorted by key, as one row. ``reasons`` adds the rejected files per reason."""
    parts = [
        counters,
        _sorted_map(languages, "language", "chunks", "language_distribution"),
        _sorted_map(sources, "source_name", "files", "source_file_counts"),
    ]
    if reasons is not None:
        parts.append(_sorted_map(reasons, "reason", "files", "files_rejected"))
    return _one_row(*parts)


def summary_text(sources: Column) -> Column:
    """One line of text over the counters and a number of sources."""
    return F.format_string(
        "files: %d/%d emitted, deduped: %d, filtered: %d | "
        "chunks: %d/%d emitted, deduped: %d | sources: %d",
        "files_emitted",
        "files_scanned",
        "files_deduplicated",
        "files_filtered",
        "chunks_emitted",
        "chunks_generated",
        "chunks_deduplicated",
        sources,
    )


def stats_summary(document: DataFrame) -> DataFrame:
    sources = F.size("source_file_counts")
    return document.select(summary_text(sources).alias("summary"))

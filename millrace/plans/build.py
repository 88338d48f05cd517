"""The dataset build: records in, split chunks, statistics and artefacts out."""

from __future__ import annotations

import dataclasses
import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.config import JobConfig
from millrace.operators import chunking, commands, extensions, filters, ledger, metadata, stats
from millrace.operators.dedup import (
    distinct_first, find_repeats, keep_first, semi_join_survivors,
)
from millrace.operators.near_dedup import NearOptions, near_dedup
from millrace.operators.split import hash_split, sequence_split
from millrace.sinks import manifest, writers
from millrace.sources import scan
from millrace.sources.resolve import ResolvedSource, resolve_sources, sources_frame
from millrace.sources.tables import to_records, union_sources
from millrace.staging import run_folder, stage

FILE_ORDER = ("source_ord", "relative_path")
CHUNK_ORDER = (*FILE_ORDER, "start_line")


@dataclass(frozen=True)
class Built:
    """Tables of a build. ``outcome`` has the rows of all files: one per chunk, or one
    without chunk columns for a file that gives no chunk. ``unique`` is the part of it from
    files that are not duplicates. ``rejections`` is there when the records carry a ledger."""

    outcome: DataFrame
    unique: DataFrame
    emitted: DataFrame
    rejections: DataFrame | None = None

    def scanned(self) -> DataFrame:
        return stats.file_rows(self.outcome)

    def counters(self) -> DataFrame:
        return stats.run_counters(self.outcome, self.unique, self.emitted)

    def document(self) -> DataFrame:
        return stats.stats_document(
            self.counters(),
            stats.language_distribution(self.emitted),
            stats.source_file_counts(self.scanned()),
            None if self.rejections is None else ledger.reason_counts(self.rejections),
        )


def chunk_outcome(records: DataFrame, config: JobConfig) -> DataFrame:
    """Normalise, gate and chunk records. Files that fail the gates keep one row, with
    ``passed`` false, so that the statistics need no second pass over the text."""
    content, options = F.col("content"), config.preprocess
    if options.canonicalize_shell:
        records = extensions.canonicalize_shell(records)
    if options.soft_wrap and options.max_line_length:
        whole = dataclasses.replace(options, max_line_length=None)
        text = chunking.preprocess_record(records, whole).withColumn(
            "content", extensions.soft_wrap("content", options.max_line_length))
    else:
        text = chunking.preprocess_record(records, options)
    if ledger.REJECTED in records.columns:
        live = F.col(ledger.REJECTED).isNull()
        text = text.withColumn("gate", F.when(live, ledger.gate_reason(content, config.quality)))
        passed = live & F.col("gate").isNull()
    else:
        passed = filters.passes_gates(content, config.quality)
    gated = (
        text
        .withColumn("passed", passed)
        .withColumn("content", F.when(F.col("passed"), content).otherwise(""))
    )
    if config.chunk.unit == "lines":
        chunks = chunking.chunk_lines(
            gated, config.chunk, keep_empty=True, unix_only=bool(options.max_line_length)
        )
    else:
        cut = extensions.chunk_tokens if config.chunk.unit == "tokens" else extensions.chunk_characters
        chunks = cut(gated, config.chunk, keep_empty=True).withColumnsRenamed(
            {"start": "start_line", "end": "end_line"})
    if config.chunk.max_chunks_per_file is not None:
        chunks = extensions.first_chunks(chunks, config.chunk, config.chunk.max_chunks_per_file)
    return chunks.transform(chunking.with_chunk_hash).withColumn(
        "split", hash_split(config.dataset)
    )


def build_chunks(records: DataFrame, config: JobConfig, *, limit: int | None = None) -> Built:
    """Emitted chunks of file records that are already filtered by source language.

    The text is read, normalised, chunked and written in one pass without a shuffle.
    Both deduplications and all statistics then work on the narrow columns of that
    table. Chunking before the file deduplication gives the same result, because equal
    files have equal chunks; it costs the chunks of copies and saves a pass over all text.
    ``limit`` is the broadcast bound of the deduplications.
    """
    quality = config.quality
    written = stage(chunk_outcome(records, config), "chunks", partition_by=["split"])
    outcome = ledger.kept(written)
    is_chunk = F.col("start_line").isNotNull()
    unique, emitted = outcome, outcome.filter(is_chunk)
    _require_identified(stats.file_rows(outcome))
    moved = False
    if quality.deduplicate_files:
        files = stats.file_rows(outcome)
        repeats = find_repeats(files, ["file_hash"], FILE_ORDER, limit)
        unique = keep_first(outcome, ["file_hash"], FILE_ORDER, rows=files, repeats=repeats)
        emitted = unique.filter(is_chunk)
        moved = not repeats.fit_broadcast
    if quality.deduplicate_chunks and moved:
        # The surviving chunks, found on narrow columns, also leave out the copies of
        # files: one shuffle of the text instead of two. They are written once, for both
        # splits and all statistics.
        first = stage(distinct_first(emitted, ["chunk_hash"], CHUNK_ORDER), "surviving-chunks")
        emitted = semi_join_survivors(
            outcome.filter(is_chunk), first, ["chunk_hash", *CHUNK_ORDER]
        )
    elif quality.deduplicate_chunks:
        emitted = keep_first(emitted, ["chunk_hash"], CHUNK_ORDER, limit=limit)
    if config.dataset.split_method == "sequence":
        emitted = _with_sequence_split(emitted, config)
    rejected = ledger.rejections(written, unique) if ledger.REJECTED in written.columns else None
    return Built(outcome, unique, emitted, rejected)


def _require_identified(files: DataFrame) -> None:
    """Source and path must identify a file: the first of two equal ones is not defined."""
    twice = files.groupBy(*FILE_ORDER).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    for row in twice.limit(1).collect():
        raise ValueError(f"source {row.source_ord} has {row.relative_path!r} more than once")


def _with_sequence_split(emitted: DataFrame, config: JobConfig) -> DataFrame:
    """Replace the hash split by the draw per position, and write the result by split."""
    splits = sequence_split(emitted.select(*CHUNK_ORDER), CHUNK_ORDER, config.dataset)
    joined = emitted.drop("split").join(splits, list(CHUNK_ORDER))
    return stage(joined, "emitted", partition_by=["split"])


def scan_sources(
    spark: SparkSession, config: JobConfig, sources: list[ResolvedSource]
) -> tuple[DataFrame, list[ResolvedSource]]:
    """File records of all sources within their language focus, and the sources that
    exist: a command source without commands is none."""
    outputs = [config.output_dir, config.workspace_dir]
    code = [s for s in sources if s.commands is None]
    mined = [s for s in sources if s.commands is not None and os.path.isdir(s.path)]
    accounted = config.dataset.write_rejections
    raw = scan.scan_source_tree(
        spark, code, config.ingestion, exclude_paths=outputs, with_rejected=accounted)
    if mined:
        by_ord = {s.source_ord: s.commands for s in mined}
        lines = scan.scan_command_files(spark, mined, exclude_paths=outputs)
        corpus = commands.command_corpus(lines, commands.shells_by_source(by_ord))
        corpus = stage(
            commands.command_cap(corpus, {o: c.max_lines for o, c in by_ord.items()}), "corpus"
        )
        # One row per command source that has commands, of those in the configuration.
        alive = {row[0] for row in corpus.select("source_ord").distinct().collect()}
        mined = [s for s in mined if s.source_ord in alive]
        names = spark.createDataFrame(
            [(s.source_ord, s.commands.name) for s in mined], "source_ord int, name string"
        )
        # Windows of lines go on over the border of two parts, unless lines are wrapped first.
        by_lines = config.chunk.unit == "lines" and not config.preprocess.soft_wrap
        texts = commands.corpus_records(
            corpus, config.ingestion.max_bytes, config.chunk if by_lines else None)
        mined_records = commands.command_source_records(texts, names, config.ingestion, len(mined))
        if accounted:
            mined_records = mined_records.withColumn(ledger.REJECTED, F.lit(None).cast("string"))
        raw = union_sources(raw, mined_records)
    alive_sources = code + mined
    focused = ledger.reject_source_language if accounted else filters.filter_source_language
    records = focused(to_records(raw), sources_frame(spark, alive_sources), len(alive_sources))
    return records, alive_sources


def write_dataset(records: DataFrame, config: JobConfig) -> dict:
    """Build chunks of file records and write them with the statistics and the
    configuration; returns the statistics. Call it inside a run folder."""
    if config.quality.near_similarity is not None:
        near = NearOptions(similarity=config.quality.near_similarity)
        records = stage(records, "records")
        firsts = near_dedup(ledger.kept(records), FILE_ORDER, near)
        if config.dataset.write_rejections:
            records = ledger.reject_others(records, firsts, FILE_ORDER, "near_duplicate")
        else:
            records = firsts
    built = build_chunks(records, config)
    manifest.remove_manifest(records.sparkSession, config.output_uri)
    target, shard = config.output_uri, config.dataset.max_records_per_shard
    if config.dataset.output_format == "parquet":
        writers.write_parquet(built.emitted, target, shard_records=shard)
    else:
        writers.write_jsonl(
            built.emitted, target, compress=config.dataset.compress, shard_records=shard)
    if built.rejections is not None:
        writers.write_rejections(built.rejections, target)
    statistics = writers.write_stats(built.document(), target)
    writers.write_text(records.sparkSession, f"{target}/{writers.CONFIG_FILE}", config.to_json())
    if config.dataset.shard_manifest:
        manifest.write_manifest(records.sparkSession, target, config.dataset)
    return statistics


def build_dataset(spark: SparkSession, config: JobConfig) -> dict:
    """Build a dataset from the source trees of a configuration; returns the statistics.

    The intermediate tables are deleted at the end.
    """
    config.validate()
    sources = resolve_sources(config)
    with run_folder(spark):
        records, present = scan_sources(spark, config, sources)
        statistics = write_dataset(records, config)
        present = [s for s in present if os.path.exists(s.path)]
        described = metadata.repository_metadata(
            sources_frame(spark, present), scan.list_metadata_paths(spark, present)
        )
        writers.write_metadata(described, config.output_uri)
    return statistics


def build_from_records(
    raw: DataFrame, config: JobConfig, sources: DataFrame | None = None
) -> dict:
    """Build a dataset from a table of raw records instead of trees.

    All ingestion rules apply. ``sources`` (``source_ord``, ``languages``) gives the language
    focus of each source. The order of a record is its source and its path, so these
    must identify it.
    """
    config.validate()
    with run_folder(raw.sparkSession):
        focused = filters.filter_source_language
        if config.dataset.write_rejections:
            records = to_records(raw.withColumn(ledger.REJECTED, ledger.listing_reason(config.ingestion)))
            focused = ledger.reject_source_language
        else:
            records = to_records(filters.ingestible(raw, config.ingestion))
        if sources is not None:
            records = focused(records, sources)
        return write_dataset(records, config)


def run_from_paths(spark: SparkSession, root: str, output_dir: str) -> dict:
    """Build with default parameters."""
    return build_dataset(spark, JobConfig(root=root, output_dir=output_dir))

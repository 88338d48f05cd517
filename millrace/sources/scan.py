"""Scans of resolved sources."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.config import IngestionOptions
from millrace.functions import fixed
from millrace.operators import commands, filters, ledger
from millrace.sources import lines, tree
from millrace.sources.resolve import ResolvedSource

_RAW = "source_ord int, source_name string, relative_path string, size bigint, raw binary"


def _names(spark: SparkSession, sources: Sequence[ResolvedSource]) -> DataFrame:
    rows = [(s.source_ord, s.name) for s in sources]
    return spark.createDataFrame(rows, "source_ord int, source_name string")


def scan_source_tree(
    spark: SparkSession,
    sources: Sequence[ResolvedSource],
    options: IngestionOptions,
    *,
    exclude_paths: Sequence[str] = (),
    with_rejected: bool = False,
) -> DataFrame:
    """Raw records of all files that the ingestion rules keep.

    Excluded directories are not walked; suffix and size decide on the listing, before
    a file is opened. ``with_rejected`` adds the other listed files without bytes, with the reason
    in a column ``rejected``; files that could not be read are null in both.
    """
    if not sources:
        return spark.createDataFrame([], f"{_RAW}, rejected string" if with_rejected else _RAW)
    listing = tree.list_tree(
        spark,
        [(s.source_ord, s.path) for s in sources],
        exclude_dirs=options.exclude_dirs,
        exclude_paths=exclude_paths,
        follow_symlinks=options.follow_symlinks,
    )
    listed, extra = listing.filter(~F.col("is_dir")), []
    if with_rejected:
        extra = [ledger.REJECTED]
        marked = listed.withColumn(ledger.REJECTED, ledger.listing_reason(options))
        raw = tree.read_files(ledger.kept(marked)).unionByName(
            marked.filter(F.col(ledger.REJECTED).isNotNull()).select(
                "source_ord", "relative_path", "size", *extra), allowMissingColumns=True)
    else:
        raw = tree.read_files(filters.ingestible(listed, options)).filter(F.col("raw").isNotNull())
    named = filters.with_source_attributes(raw, _names(spark, sources), len(sources))
    return named.select("source_ord", "source_name", "relative_path", "size", "raw", *extra)


def scan_command_files(
    spark: SparkSession, sources: Sequence[ResolvedSource], *, exclude_paths: Sequence[str] = (),
    range_bytes: int = lines.RANGE_BYTES,
) -> DataFrame:
    """Lines of the files that match the patterns of their command source.

    No directory, suffix, size or binary rule applies. Patterns are matched against the
    full path and the name. A file over ``range_bytes`` is read by several tasks.
    """
    listing = tree.list_tree(
        spark, [(s.source_ord, s.path) for s in sources], exclude_paths=exclude_paths
    )
    by_ord = {s.source_ord: s.commands for s in sources if s.commands}
    files = (
        listing.filter(~F.col("is_dir"))
        .withColumn("full_path", F.concat_ws("/", F.rtrim("root", F.lit("/")), "relative_path"))
        .filter(commands.matches_source(by_ord, "full_path"))
    )
    return lines.read_lines(files, range_bytes=range_bytes)


def list_metadata_paths(spark: SparkSession, sources: Sequence[ResolvedSource]) -> DataFrame:
    """Top-level entries and CI folders of each source, without any ingestion rule. A linked
    CI folder counts."""
    return tree.list_tree(
        spark, [(s.source_ord, s.path) for s in sources], only_below=fixed.CI_LOCATIONS,
        follow_symlinks=True,
    ).select("source_ord", "relative_path", "is_dir")

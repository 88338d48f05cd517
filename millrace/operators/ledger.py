"""Why files do not enter a build: a narrow row for each of them.

The rules add a column ``rejected`` to the file records in place of dropping rows. A rejected row loses
its text at once and travels with the kept ones, so that one pass over the text decides, chunks and
accounts. Files listed are then files emitted, deduplicated and rejected, each in one of them.
"""

from __future__ import annotations

import dataclasses

from pyspark.sql import Column, DataFrame, functions as F

from millrace.config import IngestionOptions, QualityOptions
from millrace.functions import paths
from millrace.operators import extensions, filters
from millrace.operators.joins import null_safe_join

REJECTED = "rejected"
_ROW = ("source_ord", "source_name", "relative_path", "size")


def kept(records: DataFrame) -> DataFrame:
    """Rows that no rule has rejected; all rows of a table without a ledger."""
    return records.filter(F.col(REJECTED).isNull()) if REJECTED in records.columns else records


def _first_reason(*rules: tuple[str, Column]) -> Column:
    """Name of the first rule that holds; one that gives null does not hold."""
    return F.coalesce(*[F.when(holds, F.lit(name)) for name, holds in rules], F.lit(None).cast("string"))


def listing_reason(options: IngestionOptions) -> Column:
    """The first rule on path and size that rejects a file, or null. It is null for the rows that
    ``filters.ingestible`` keeps, and for those of unknown size, which are settled when they are read."""
    path = F.col("relative_path")
    rules = [
        ("path", path.isNull()),
        ("directory", paths.inside_directory(path, options.exclude_dirs)),
        ("extension", ~paths.allowed_extension(path, options.include_extensions)),
        ("size", F.col("size") > F.lit(options.max_bytes)),
    ]
    if options.exclude_extensions:
        lowered = [e.lower() for e in options.exclude_extensions]
        rules.insert(3, ("excluded", paths.extension(path).isin(*lowered)))
    if options.exclude_globs:
        rules.insert(3, ("excluded", paths.matches_globs(path, options.exclude_globs)))
    return _first_reason(*rules)


def gate_reason(content: Column, options: QualityOptions) -> Column:
    """``gates`` for normalised text out of bounds, ``forbidden`` for text within them that holds a
    pattern; null for text that passes."""
    bounds = filters.passes_gates(content, dataclasses.replace(options, forbidden_patterns=()))
    rules = [("gates", ~bounds)]
    if options.forbidden_patterns:
        rules.append(("forbidden", extensions.holds_forbidden(content, options.forbidden_patterns)))
    return _first_reason(*rules)


def reject_source_language(records: DataFrame, sources: DataFrame, rows: int | None = None) -> DataFrame:
    """:func:`filters.filter_source_language` with a reason in place of the drop. A record whose source
    is not listed is out of focus too."""
    reason = F.coalesce(F.col(REJECTED), F.when(~F.col("_in_focus"), F.lit("language")))
    return (
        filters.with_focus(records, sources, rows)
        .withColumn(REJECTED, reason)
        .withColumn("content", F.when(F.col(REJECTED).isNull(), F.col("content")))
        .select(*records.columns)
    )


def reject_others(records: DataFrame, survivors: DataFrame, order: tuple[str, ...], reason: str) -> DataFrame:
    """``survivors`` and a row without text for every other row of ``records``, with its earlier reason
    or else this one."""
    gone = null_safe_join(
        records.withColumn("content", F.lit(None).cast("string")), survivors.select(*order), order, "left_anti")
    return survivors.unionByName(gone.withColumn(REJECTED, F.coalesce(REJECTED, F.lit(reason))))


def rejections(outcome: DataFrame, unique: DataFrame) -> DataFrame:
    """``source_ord, source_name, relative_path, size, reason`` of each rejected file.

    ``outcome`` holds the rows that earlier rules rejected. ``unique`` is its part from files that were
    read and are not duplicates; of it those go that fail the gates (``gate``).
    """
    early = outcome.filter(F.col(REJECTED).isNotNull()).select(*_ROW, F.col(REJECTED).alias("reason"))
    late = unique.filter(F.col("gate").isNotNull()).select(*_ROW, F.col("gate").alias("reason"))
    return early.unionByName(late)


def reason_counts(rejected: DataFrame) -> DataFrame:
    """Files per reason; there are as many rows as reasons."""
    return rejected.groupBy("reason").agg(F.count(F.lit(1)).alias("files"))

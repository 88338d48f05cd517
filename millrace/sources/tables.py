"""File records from tables that already hold text or bytes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from millrace.functions import paths, text



def raw_records(
    table: DataFrame,
    *,
    source_ord: Column,
    source_name: Column,
    relative_path: Column,
    text: Column,
) -> DataFrame:
    """Project a table with one text or binary column to raw file records. A row whose text
    is null is not a file."""
    raw = text.cast("binary")
    return table.select(
        source_ord.cast("int").alias("source_ord"),
        source_name.alias("source_name"),
        relative_path.alias("relative_path"),
        F.octet_length(raw).cast("bigint").alias("size"),
        raw.alias("raw"),
    )


def to_records(raw: DataFrame) -> DataFrame:
    """File records from raw ones: binary files go, text is decoded, hashed and tagged.

    The hash is that of the bytes as they were read. Raw records with a ledger (a column
    ``rejected``) all stay; those that are rejected, binary or without bytes get a reason and no text.
    """
    if "rejected" in raw.columns:
        return _ledger_records(raw)
    return raw.filter(~text.is_binary("raw")).select(
        "source_ord",
        "source_name",
        "relative_path",
        text.decode_text("raw").alias("content"),
        paths.detect_language("relative_path").alias("language"),
        text.fingerprint("raw").alias("file_hash"),
        "size",
    )


def _ledger_records(raw: DataFrame) -> DataFrame:
    reason = (
        F.when(F.col("rejected").isNotNull(), F.col("rejected"))
        .when(F.col("raw").isNull(), "unreadable").when(text.is_binary("raw"), "binary")
    )
    kept = F.col("rejected").isNull()
    return raw.withColumn("rejected", reason).select(
        "source_ord",
        "source_name",
        "relative_path",
        F.when(kept, text.decode_text("raw")).alias("content"),
        paths.detect_language("relative_path").alias("language"),
        F.when(kept, text.fingerprint("raw")).alias("file_hash"),
        "size",
        "rejected",
    )


def scan_record_table(
    spark: SparkSession, path: str, *, format: str = "parquet", **columns: Column
) -> DataFrame:
    """Raw records from Parquet, JSON lines or any other table format Spark reads."""
    return raw_records(spark.read.format(format).load(path), **columns)


def union_sources(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Stack record tables; ``source_ord`` carries their order."""
    for other in others:
        first = first.unionByName(other)
    return first

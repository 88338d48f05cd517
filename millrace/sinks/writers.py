"""Dataset and artefact writers."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from millrace.operators.split import EVAL, TRAIN

STATS_FILE = "dataset_stats.json"
METADATA_FILE = "repository_metadata.json"
CONFIG_FILE = "pipeline_config.json"
REJECTIONS_FILE = "rejected_files.json"
ITEM = (
    "content string, language string, metadata struct<source_path:string, "
    "start_line:bigint, end_line:bigint, hash:string>"
)


def dataset_item(chunks: DataFrame, *others: str) -> DataFrame:
    """Chunks in the form that is written: content, language and nested metadata."""
    return chunks.select(
        *others,
        "content",
        "language",
        F.struct(
            F.col("relative_path").alias("source_path"),
            "start_line",
            "end_line",
            F.col("file_hash").alias("hash"),
        ).alias("metadata"),
    )


def json_line() -> Column:
    """One dataset item as a JSON object; characters outside ASCII are kept."""
    return F.to_json(F.struct("content", "language", "metadata"))


def dataset_paths(output_dir: str, compress: bool) -> dict[str, str]:
    suffix = ".jsonl.gz" if compress else ".jsonl"
    return {split: f"{output_dir}/{split}{suffix}" for split in (TRAIN, EVAL)}


def write_jsonl(
    chunks: DataFrame, output_dir: str, *, compress: bool = False, shard_records: int | None = None
) -> dict[str, str]:
    """Write one folder of JSON lines per split; both exist even when one is empty. A file holds at
    most ``shard_records`` records.

    ``chunks`` should come from a table partitioned by ``split``: each write then reads
    its own part only.
    """
    targets = dataset_paths(output_dir, compress)
    for split, path in targets.items():
        items = dataset_item(chunks.filter(F.col("split") == split))
        writer = items.write.mode("overwrite")
        if shard_records is not None:
            writer = writer.option("maxRecordsPerFile", shard_records)
        writer.json(path, compression="gzip" if compress else "none")
    return targets


def write_stats(document: DataFrame, output_dir: str) -> dict:
    """Write the one-row statistics as a JSON document with sorted keys; returns them."""
    row = document.first().asDict()
    content = json.dumps(row, indent=2, sort_keys=True)
    write_text(document.sparkSession, f"{output_dir}/{STATS_FILE}", content)
    return row


def write_metadata(metadata: DataFrame, output_dir: str) -> str:
    """One JSON object per source, written by the executors."""
    path = f"{output_dir}/{METADATA_FILE}"
    ordered = metadata.repartitionByRange("source_ord").sortWithinPartitions("source_ord")
    ordered.drop("source_ord").write.mode("overwrite").json(path)
    return path


def write_rejections(rejected: DataFrame, output_dir: str) -> str:
    """One JSON object per rejected file, written by the executors."""
    path = f"{output_dir}/{REJECTIONS_FILE}"
    rejected.write.mode("overwrite").json(path)
    return path


def write_text(spark: SparkSession, path: str, content: str) -> str:
    """Write one small driver-side document as a file, on the file system the path belongs to."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(place.getParent())
    stream = system.create(place, True)
    try:
        stream.write(bytearray(content.encode("utf-8")))
    finally:
        stream.close()
    return path


def write_parquet(chunks: DataFrame, output_dir: str, *, shard_records: int | None = None) -> str:
    """Write dataset items as Parquet, one folder per split, with at most so many rows in a file."""
    path = f"{output_dir}/dataset.parquet"
    out = dataset_item(chunks, "split").write.mode("overwrite").partitionBy("split")
    if shard_records is not None:
        out = out.option("maxRecordsPerFile", shard_records)
    out.parquet(path)
    return path


def shard_index(items: DataFrame) -> DataFrame:
    """Per written file: rows and the range of start lines. One row per file."""
    return items.groupBy(F.input_file_name().alias("shard")).agg(
        F.count(F.lit(1)).alias("records"),
        F.min("metadata.start_line").alias("first_line"),
        F.max("metadata.end_line").alias("last_line"),
    )

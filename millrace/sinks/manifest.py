"""A list of the shards of a dataset, written after them: readers trust the shards it names.

Files that a lost or speculative attempt, a stopped run or a foreign job leaves beside the shards are
not in the list. A shard is named by its split and file name, with its bytes, its records and a digest of
its records that does not depend on their order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from millrace.config import DatasetOptions
from millrace.operators.joins import sized_join
from millrace.operators.split import EVAL, TRAIN
from millrace.sinks import writers

MANIFEST_FILE = "shard_manifest.json"
KEY = ("split", "shard")
_SCHEMA = "split string, shard string, bytes bigint, records bigint, digest string"


def _place(spark: SparkSession, output_dir: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{output_dir}/{MANIFEST_FILE}")
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def remove_manifest(spark: SparkSession, output_dir: str) -> None:
    """Take the list of an earlier run away, before its shards are replaced."""
    system, place = _place(spark, output_dir)
    system.delete(place, True)


def _items(spark: SparkSession, output_dir: str, options: DatasetOptions) -> DataFrame:
    """Every record in the folders of a dataset, with its split, shard and the bytes of that."""
    shard = (F.col("_metadata.file_name").alias("shard"), F.col("_metadata.file_size").alias("bytes"))
    if options.output_format == "parquet":
        whole = spark.read.schema(f"{writers.ITEM}, split string").parquet(f"{output_dir}/dataset.parquet")
        return whole.select("split", *shard, "content", "language", "metadata")
    paths = writers.dataset_paths(output_dir, options.compress)
    train, evaluated = (
        spark.read.schema(writers.ITEM).json(paths[split], lineSep="\n").select(F.lit(split).alias("split"), *shard, "*")
        for split in (TRAIN, EVAL)
    )
    return train.unionByName(evaluated)


def _digest() -> Column:
    """Sums of two hashes of each record, hashed together with their number."""
    record = F.to_json(F.struct("content", "language", "metadata"))
    sums = [F.sum(F.xxhash64(F.lit(k), record).cast("decimal(20,0)")).cast("string") for k in (1, 2)]
    return F.sha2(F.concat_ws(":", F.count(F.lit(1)).cast("string"), *sums), 256)


def shards(spark: SparkSession, output_dir: str, options: DatasetOptions) -> DataFrame:
    """The shards that lie in the folders and hold records, as they are now. Records are aggregated where
    they are read; one row per shard and task is shuffled."""
    return _items(spark, output_dir, options).groupBy(*KEY).agg(
        F.max("bytes").alias("bytes"), F.count(F.lit(1)).alias("records"), _digest().alias("digest"))


def write_manifest(spark: SparkSession, output_dir: str, options: DatasetOptions) -> str:
    """List the shards of a dataset that has been written. It appears as a whole or not at all: its folder
    is renamed once it is complete."""
    remove_manifest(spark, output_dir)
    system, place = _place(spark, output_dir)
    draft = place.suffix(".draft")
    shards(spark, output_dir, options).write.mode("overwrite").json(draft.toString())
    if not system.rename(draft, place):
        raise OSError(f"cannot rename {draft.toString()}")
    return place.toString()


def read_manifest(spark: SparkSession, output_dir: str) -> DataFrame:
    """``split, shard, bytes, records, digest`` of each listed shard; an error if the dataset has no list."""
    system, place = _place(spark, output_dir)
    if not system.exists(place):
        raise FileNotFoundError(f"{output_dir} has no {MANIFEST_FILE}: it was not written to the end")
    return spark.read.schema(_SCHEMA).json(place.toString())


def read_dataset(spark: SparkSession, output_dir: str, options: DatasetOptions) -> DataFrame:
    """``split, content, language, metadata`` of the records in listed shards. Other files in the folders
    give no rows; the list is broadcast within the measured bound."""
    listed = read_manifest(spark, output_dir).select(*KEY)
    return sized_join(_items(spark, output_dir, options), listed, KEY, "left_semi").drop("shard", "bytes")


def shard_differences(spark: SparkSession, output_dir: str, options: DatasetOptions) -> DataFrame:
    """Shards that are not as listed: ``split, shard, records, difference``, which is ``missing``, ``changed``
    or ``stray``. ``records`` are those listed, and those found in a stray shard."""
    listed = read_manifest(spark, output_dir).withColumn("listed", F.lit(True))
    found = shards(spark, output_dir, options).select(
        *KEY, F.col("bytes").alias("_bytes"), F.col("records").alias("_records"), F.col("digest").alias("_digest"))
    same = (F.col("bytes") == F.col("_bytes")) & (F.col("digest") == F.col("_digest"))
    difference = (
        F.when(F.col("listed").isNull(), "stray").when(F.col("_digest").isNull(), "missing").when(~same, "changed"))
    return (
        listed.join(found.hint("merge"), list(KEY), "full")
        .select(*KEY, F.coalesce("records", "_records").alias("records"), difference.alias("difference"))
        .filter(F.col("difference").isNotNull())
    )

"""Token counts through a cache keyed by digests of content and tokenizer.

The cache is a Parquet table, partitioned by tokenizer version. Content is normalised so far as
no count can change: a null is the empty text. Counts of contents that the cache holds are
joined; of the others each distinct one is encoded once and appended.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, functions as F

from millrace.llm.files import prepare_tasks
from millrace.llm.tokens import encoder
from millrace.operators.joins import fits_broadcast
from millrace.staging import stage

_SCHEMA = "digest binary, n_tokens bigint"


def tokenizer_version(path: str) -> str:
    """Digest of the tokenizer's file."""
    with open(path, "rb") as file:
        return hashlib.file_digest(file, "sha256").hexdigest()


def _exists(spark, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def read_cache(spark, cache: str, version: str) -> DataFrame:
    """Stored counts of one tokenizer version. A count that two writers stored appears once."""
    path = f"{cache}/version={version}"
    if not _exists(spark, path):
        return spark.createDataFrame([], _SCHEMA)
    return spark.read.schema(_SCHEMA).parquet(path).groupBy("digest").agg(
        F.max("n_tokens").alias("n_tokens")
    )


def _counts(path: str):
    def count(batches):
        import pyarrow as pa

        for batch, texts in encoder(path).encode_batches(batches):
            counts = [len(ids) // 4 for ids in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column("digest"), pa.array(counts, pa.int64())], ["digest", "n_tokens"]
            )

    return count


def _missing(texts: DataFrame, known: DataFrame, limit: int | None) -> DataFrame:
    """Each distinct text without a stored count. Digests alone decide which; while the missing ones fit a
    broadcast, only their texts are moved, and beyond that one copy of each text and task is."""
    missing = stage(
        texts.select("digest").distinct().join(known.hint("merge"), "digest", "left_anti"), "missing-digests")
    if fits_broadcast(missing, limit):
        return texts.join(F.broadcast(missing), "digest", "left_semi").dropDuplicates(["digest"])
    return texts.dropDuplicates(["digest"]).join(missing.hint("merge"), "digest", "left_semi")


def cached_token_counts(
    docs: DataFrame, tokenizer: str, cache: str, *, text: str = "text", doc_id: str = "doc_id",
    limit: int | None = None,
) -> DataFrame:
    """``doc_id``, ``n_bytes`` and ``n_tokens`` of each row; adds what is new to ``cache``.

    ``tokenizer`` is the place of a tokenizers file on all machines, ``cache`` a folder they share.
    With a filled cache digests are compared first and the texts of misses are moved only (``limit`` is the
    bound of digests in a broadcast). A third of all rows with one content costs one row per task in the
    search for misses, and is split by adaptive execution in the join of the counts. Rows stay as many as they were, in ids
    repeated or null; an empty table adds nothing. Other columns are not read. A run that stops
    half way leaves the cache as it was or with the new counts, both of which are valid.
    """
    spark = docs.sparkSession
    prepare_tasks(spark)
    version = tokenizer_version(tokenizer)
    whole = docs.select(
        F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")
    ).withColumn("digest", F.unhex(F.sha2("text", 256)))
    texts = whole.select("digest", "text")
    if _exists(spark, f"{cache}/version={version}"):
        misses = _missing(texts, read_cache(spark, cache, version), limit)
    else:
        misses = texts.dropDuplicates(["digest"])
    misses.select("digest", "text").mapInArrow(_counts(tokenizer), _SCHEMA).write.mode("append").parquet(
        f"{cache}/version={version}"
    )
    keyed = whole.select("doc_id", F.octet_length("text").cast("bigint").alias("n_bytes"), "digest")
    return keyed.join(read_cache(spark, cache, version), "digest").select(
        "doc_id", "n_bytes", "n_tokens"
    )

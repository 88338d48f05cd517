"""The training-data pipeline over ``documents``: five stages, each written before the next reads it.

Each stage takes all that the one before kept. The first four return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.llm.language_cnn import keep_languages, train_language_network
from millrace.llm.mixing import Mix, mix_documents
from millrace.llm.packing import DOCUMENTS, pack_texts
from millrace.llm.quality_neighbours import fit_neighbours, keep_quality
from millrace.llm.simhash import keep_one_of_each
from millrace.staging import stage

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
# Workers serve all stages and keep the memo, beside the models and a heap that earlier stages have filled.
MEMO_CHUNKS = 100_000


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the nearest-neighbour classifier rejects."""
    model = fit_neighbours(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return keep_quality(docs, model, keep_unjudged=True)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents in none of the learned languages: those that the network scores too low, and
    those without a letter, whose score is 0."""
    return keep_languages(docs, train_language_network(docs), keep_unjudged=True)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leaves one document of each group of SimHash near-duplicates."""
    return keep_one_of_each(docs, null_ids_stay=False)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Orders documents in blocks of target weights; small sources are repeated up to twice."""
    return mix_documents(docs, Mix(repetition=2.0))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the mixture into sequences of at most 2048 tokens."""
    pieces = pack_texts(docs, TOKENIZER, DOCUMENTS, memo_chunks=MEMO_CHUNKS)
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


STAGES = [
    ("quality", quality),
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("mixing", mixing),
    ("packing", packing),
]

# Learned models and packing have no SQL; the tests compare the run with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

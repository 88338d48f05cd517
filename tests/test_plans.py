"""Physical plans: what is read, what is shuffled, and what is broadcast."""

import re

import pytest
from pyspark.sql import functions as F

from millrace.config import ChunkOptions, PreprocessOptions
from millrace.operators import chunking, commands, filters, positions
from millrace.operators.dedup import keep_first
from millrace.plans.build import build_chunks
from millrace.queries import build_queries, inputs, table_queries
from millrace.sources import tables

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture
def plan_of(spark, capsys):
    """Physical plan without adaptive execution, which hides the code generation stages."""

    def explain(frame):
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        try:
            capsys.readouterr()
            frame.explain()
            return capsys.readouterr().out
        finally:
            spark.conf.set("spark.sql.adaptive.enabled", "true")

    return explain


def records(spark):
    documents = inputs.files(spark, SF_DIR)
    return tables.to_records(tables.raw_records(
        documents, source_ord=F.col("source_ord"), source_name=F.col("source_name"),
        relative_path=F.col("relative_path"), text=F.col("text")))


def test_chunking_is_one_generated_stage_without_shuffle(spark, plan_of):
    processed = chunking.preprocess_record(records(spark), PreprocessOptions())
    plan = plan_of(chunking.chunk_lines(processed, ChunkOptions(4, 1), unix_only=True))
    assert "Exchange" not in plan
    assert set(re.findall(r"\*\((\d+)\)", plan)) == {"1"}
    assert re.search(r"\*\(1\) Generate explode", plan)


def test_scan_reads_needed_columns_only(spark, plan_of):
    plan = plan_of(records(spark).select("relative_path", "language"))
    assert "n_chars" not in plan and "lang:" not in plan
    sizes = filters.filter_size(inputs.table(spark, SF_DIR, "documents").select(
        "doc_id", F.col("n_chars").alias("size")), 100)
    assert "PushedFilters: [IsNotNull(n_chars), LessThanOrEqual(n_chars,100)]" in plan_of(sizes)


def test_few_repeats_leave_the_wide_side_in_place(spark, plan_of):
    wide = records(spark)
    plan = plan_of(keep_first(wide, ["file_hash"], table_queries.FILE_ORDER))
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_many_repeats_join_the_written_survivors_once(spark, plan_of):
    wide = records(spark)
    plan = plan_of(keep_first(wide, ["file_hash"], table_queries.FILE_ORDER, limit=0))
    assert "survivors-" in plan and "Aggregate" not in plan and "ShuffledHashJoin" not in plan


def test_many_repeats_decide_survivors_once(spark, plan_of):
    built = build_chunks(records(spark), build_queries.CONFIG, limit=0)
    plan = plan_of(built.emitted)
    assert "surviving-chunks-" in plan and "Aggregate" not in plan
    assert sum("FileScan" in line for line in plan.splitlines()) == 2


def test_three_caps_read_the_lines_once(spark, plan_of):
    corpus = inputs.transcripts(spark, SF_DIR).withColumnRenamed("line", "command")
    plan = plan_of(commands.command_cap(corpus, {0: 5, 1: 7, 2: 9}))
    assert "events.parquet" not in plan and "uncapped-corpus-" in plan


def test_many_repeats_move_the_text_once(spark, plan_of):
    built = build_chunks(records(spark), build_queries.CONFIG, limit=0)
    plan = plan_of(built.emitted)
    wide = [line for line in plan.splitlines() if "FileScan" in line and "content#" in line]
    assert len(wide) == 1
    narrow = plan_of(built.counters())
    assert "content#" not in narrow


def test_split_prunes_partitions(spark, plan_of):
    built = build_chunks(records(spark), build_queries.CONFIG)
    plan = plan_of(built.emitted.filter(F.col("split") == "eval"))
    assert re.search(r"PartitionFilters: \[isnotnull\(split#\d+\), \(split#\d+ = eval\)\]", plan)


def test_small_cap_is_pruned_before_the_shuffle(spark, plan_of):
    corpus = inputs.transcripts(spark, SF_DIR).withColumnRenamed("line", "command")
    plan = plan_of(positions.first_n(corpus, ["source_ord"], ["path", "line_no"], 50))
    partial = plan.index("Partial")
    assert plan.index("Exchange hashpartitioning") < partial


def test_sources_beyond_the_bound_do_not_move_the_text(spark, plan_of):
    focused = filters.filter_source_language(records(spark), inputs.sources(spark, SF_DIR), limit=0)
    plan = plan_of(focused)
    assert plan.count("BroadcastHashJoin") == 2 and "Exchange hashpartitioning" not in plan

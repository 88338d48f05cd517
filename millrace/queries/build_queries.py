"""Queries for the whole build, its statistics and its outputs."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.config import ChunkOptions, JobConfig, PreprocessOptions, QualityOptions
from millrace.operators import filters, stats
from millrace.plans.build import build_chunks
from millrace.queries import inputs
from millrace.queries.inputs import SOURCES_SQL
from millrace.queries.registry import query
from millrace.queries.table_queries import RECORDS_SQL, chunks_sql, file_records, split_sql
from millrace.queries.text_queries import normalise_sql
from millrace.sinks import writers
from millrace.staging import new_path

CONFIG = JobConfig(
    root="/data", output_dir="/data/out",
    preprocess=PreprocessOptions(max_line_length=400),
    chunk=ChunkOptions(4, 1),
    quality=QualityOptions(min_characters=256, min_lines=2),
)

BUILD_SQL = f"""{RECORDS_SQL}, {SOURCES_SQL},
scanned AS (SELECT r.* FROM records r JOIN sources s USING (source_ord)
  WHERE len(s.languages) = 0 OR list_contains(s.languages, r.language)),
firsts AS (SELECT * FROM scanned QUALIFY row_number() OVER (
  PARTITION BY file_hash ORDER BY source_ord, relative_path) = 1),
normalised AS (SELECT * EXCLUDE (content), {normalise_sql('content', 400)} AS content FROM firsts),
passed AS (SELECT * FROM normalised WHERE length(content) >= 256
  AND len(string_split(content, chr(10))) >= 2),
{chunks_sql('passed', 4, 1, keep='source_ord, source_name, relative_path, language, file_hash')},
emitted AS (SELECT *, sha1(content) AS chunk_hash, {split_sql(13, 0.9, 'sha1(content)')} AS split
  FROM chunks QUALIFY row_number() OVER (
  PARTITION BY sha1(content) ORDER BY source_ord, relative_path, start_line) = 1)"""

COUNTERS_SQL = f"""{BUILD_SQL}, sizes AS (SELECT
  (SELECT count(*) FROM scanned) AS files_scanned, (SELECT count(*) FROM firsts) AS first_files,
  (SELECT count(*) FROM passed) AS files_emitted, (SELECT count(*) FROM chunks) AS chunks_generated,
  (SELECT count(*) FROM emitted) AS chunks_emitted),
counters AS (SELECT files_scanned, files_emitted, files_scanned - first_files AS files_deduplicated,
  first_files - files_emitted AS files_filtered, chunks_generated, chunks_emitted,
  chunks_generated - chunks_emitted AS chunks_deduplicated FROM sizes)"""


def _built(spark, sf_dir):
    records = filters.filter_source_language(
        file_records(spark, sf_dir), inputs.sources(spark, sf_dir)
    )
    return build_chunks(records, CONFIG)


@query("build_dataset", f"""WITH {BUILD_SQL} SELECT source_ord, relative_path, language, file_hash,
  start_line, end_line, chunk_hash, split FROM emitted""")
def build_dataset(spark, sf_dir):
    return _built(spark, sf_dir).emitted.select(
        "source_ord", "relative_path", "language", "file_hash",
        "start_line", "end_line", "chunk_hash", "split",
    )


@query("dataset_item", f"""WITH {BUILD_SQL} SELECT content, language, relative_path AS source_path,
  start_line, end_line, file_hash AS hash FROM emitted""")
def dataset_item(spark, sf_dir):
    items = writers.dataset_item(_built(spark, sf_dir).emitted)
    return items.select("content", "language", "metadata.*")


@query("json_line", f"""WITH {BUILD_SQL} SELECT relative_path, start_line, CAST(to_json({{
  'content': content, 'language': language, 'metadata': {{'source_path': relative_path,
  'start_line': start_line, 'end_line': end_line, 'hash': file_hash}}}}) AS VARCHAR) AS line FROM emitted""")
def json_line(spark, sf_dir):
    items = writers.dataset_item(_built(spark, sf_dir).emitted)
    return items.select("metadata.source_path", "metadata.start_line",
                        writers.json_line().alias("line")).withColumnRenamed(
        "source_path", "relative_path")


# --- statistics ----------------------------------------------------------------------------
@query("run_stats", f"WITH {COUNTERS_SQL} SELECT * FROM counters")
def run_stats(spark, sf_dir):
    return _built(spark, sf_dir).counters()


@query("language_distribution",
       f"WITH {BUILD_SQL} SELECT language, count(*) AS chunks FROM emitted GROUP BY language")
def language_distribution(spark, sf_dir):
    return stats.language_distribution(_built(spark, sf_dir).emitted)


@query("source_file_counts",
       f"WITH {BUILD_SQL} SELECT source_name, count(*) AS files FROM scanned GROUP BY source_name")
def source_file_counts(spark, sf_dir):
    return stats.source_file_counts(_built(spark, sf_dir).scanned())


@query("stats_document", f"""WITH {COUNTERS_SQL},
  counted AS (UNPIVOT counters ON COLUMNS(*) INTO NAME entry VALUE amount)
  SELECT 'counter' AS part, entry, amount FROM counted
  UNION ALL SELECT 'language', language, count(*) FROM emitted GROUP BY language
  UNION ALL SELECT 'source', source_name, count(*) FROM scanned GROUP BY source_name""")
def stats_document(spark, sf_dir):
    """The one-row document, laid out as one row per entry."""
    counters = F.create_map(*[x for c in stats.COUNTERS for x in (F.lit(c), F.col(c))])
    parts = F.array(
        F.struct(F.lit("counter").alias("part"), counters.alias("entries")),
        F.struct(F.lit("language").alias("part"), F.col("language_distribution").alias("entries")),
        F.struct(F.lit("source").alias("part"), F.col("source_file_counts").alias("entries")),
    )
    return (
        _built(spark, sf_dir).document()
        .select(F.inline(parts))
        .select("part", F.explode("entries").alias("entry", "amount"))
    )


@query("stats_summary", f"""WITH {COUNTERS_SQL} SELECT format(
  'files: {{}}/{{}} emitted, deduped: {{}}, filtered: {{}} | chunks: {{}}/{{}} emitted, deduped: {{}} | sources: {{}}',
  files_emitted, files_scanned, files_deduplicated, files_filtered, chunks_emitted, chunks_generated,
  chunks_deduplicated, (SELECT count(DISTINCT source_name) FROM scanned)) AS summary FROM counters""")
def stats_summary(spark, sf_dir):
    return stats.stats_summary(_built(spark, sf_dir).document())


# --- outputs -------------------------------------------------------------------------------
WRITTEN_SQL = f"""WITH {BUILD_SQL} SELECT split, content, language, relative_path AS source_path,
  start_line, end_line, file_hash AS hash FROM emitted"""


def _written(spark, sf_dir, compress):
    """Write the dataset to the shared folder and read it back."""
    output = new_path(spark, "dataset")
    targets = writers.write_jsonl(_built(spark, sf_dir).emitted, output, compress=compress)
    read = [
        spark.read.schema(writers.ITEM).json(path).select(
            F.lit(name).alias("split"), "content", "language", "metadata.*"
        )
        for name, path in targets.items()
    ]
    return read[0].unionByName(read[1])


@query("write_jsonl", WRITTEN_SQL)
def write_jsonl(spark, sf_dir):
    return _written(spark, sf_dir, compress=False)


@query("write_jsonl_gzip", WRITTEN_SQL)
def write_jsonl_gzip(spark, sf_dir):
    return _written(spark, sf_dir, compress=True)

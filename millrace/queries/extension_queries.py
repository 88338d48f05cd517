"""Queries for the optional steps."""

from __future__ import annotations

import dataclasses
import os

import pandas as pd
from pyspark.sql import functions as F

from millrace.config import ChunkOptions, CommandSource, DatasetOptions, IngestionOptions, QualityOptions
from millrace.functions import fixed
from millrace.operators import extensions, ledger
from millrace.operators.near_dedup import (
    NearOptions, class_sets, near_groups, similar_pairs, word_classes,
)
from millrace.queries import inputs
from millrace.queries.build_queries import BUILD_SQL, CONFIG, COUNTERS_SQL, _built
from millrace.queries.inputs import FILES_SQL, SOURCES_SQL, TRANSCRIPTS_SQL
from millrace.queries.registry import query
from millrace.queries.table_queries import RECORDS_SQL, file_records
from millrace.plans.build import build_chunks
from millrace.queries.text_queries import EXT_SQL, LANGUAGE_SQL, PROMPT_SQL, STRIP_SQL, WORDS_SQL, normalise_sql
from millrace.sinks import manifest, writers
from millrace.sources import scan, tables
from millrace.sources.resolve import ResolvedSource
from millrace.staging import bound_batches, new_path, qualified, stage


def _documents(spark, sf_dir):
    return inputs.table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("content"))


@query("exclude_extensions", f"""WITH {FILES_SQL}, tagged AS (SELECT doc_id, relative_path, {EXT_SQL} AS ext
  FROM files) SELECT doc_id, relative_path FROM tagged WHERE ext NOT IN ('.png', '.js', '.gz')""")
def exclude_extensions(spark, sf_dir):
    files = inputs.files(spark, sf_dir)
    return extensions.exclude_extensions(files, (".PNG", ".js", ".gz")).select("doc_id", "relative_path")


@query("exclude_globs", f"""WITH {FILES_SQL} SELECT doc_id, relative_path FROM files
  WHERE NOT (lower(relative_path) LIKE 'src/vendor/%'
    OR regexp_matches(lower(regexp_extract(relative_path, '[^/]*$')), '^f1.*\\.md$'))""")
def exclude_globs(spark, sf_dir):
    files = inputs.files(spark, sf_dir)
    return extensions.exclude_globs(files, ("src/vendor/*", "F1*.md")).select("doc_id", "relative_path")


@query("forbidden_patterns", r"""SELECT doc_id FROM documents
  WHERE NOT (regexp_matches(text, 'password=\w+') OR regexp_matches(text, '[\w.]+@[\w.]+'))""")
def forbidden_patterns(spark, sf_dir):
    rejected = extensions.reject_forbidden(
        _documents(spark, sf_dir), (r"password=\w+", r"[\w.]+@[\w.]+"))
    return rejected.select("doc_id")


@query("soft_wrap", """SELECT doc_id, array_to_string(list_transform(string_split(text, chr(10)), lambda x:
  CASE WHEN length(x) <= 80 THEN x ELSE array_to_string(list_transform(range(0, length(x), 80),
    lambda i: substr(x, i + 1, 80)), chr(10)) END), chr(10)) AS content FROM documents""")
def soft_wrap(spark, sf_dir):
    return _documents(spark, sf_dir).withColumn("content", extensions.soft_wrap("content", 80))


@query("canonicalize_shell", f"""WITH {TRANSCRIPTS_SQL} SELECT line_no,
  CASE WHEN line_no % 2 = 0 THEN {WORDS_SQL % (PROMPT_SQL % (STRIP_SQL % 'line'))} ELSE line END AS content
  FROM transcripts""")
def canonicalize_shell(spark, sf_dir):
    lines = inputs.transcripts(spark, sf_dir).select(
        "line_no", F.col("line").alias("content"),
        F.when(F.col("line_no") % 2 == 0, "terminal").otherwise("text").alias("language"))
    return extensions.canonicalize_shell(lines).drop("language")


def _starts_sql(size: int, overlap: int) -> str:
    return f"unnest(range(0, greatest(0, n - {overlap} - 1) + 1, {size - overlap}))"


@query("chunk_characters", f"""WITH starts AS (SELECT doc_id, text, n, {_starts_sql(500, 60)} AS s FROM
    (SELECT doc_id, text, length(text) AS n FROM documents) WHERE n > 0)
  SELECT doc_id, CAST(s + 1 AS BIGINT) AS start, CAST(least(n, s + 500) AS BIGINT) AS "end",
         substr(text, CAST(s + 1 AS BIGINT), 500) AS content FROM starts""")
def chunk_characters(spark, sf_dir):
    return extensions.chunk_characters(_documents(spark, sf_dir), ChunkOptions(500, 60))


@query("chunk_tokens", rf"""WITH starts AS (SELECT doc_id, w, n, {_starts_sql(100, 20)} AS s FROM
    (SELECT doc_id, w, len(w) AS n FROM (SELECT doc_id, regexp_extract_all(text, '[^\s]+') AS w FROM documents))
    WHERE n > 0)
  SELECT doc_id, CAST(s + 1 AS BIGINT) AS start, CAST(least(n, s + 100) AS BIGINT) AS "end",
         array_to_string(list_slice(w, s + 1, s + 100), ' ') AS content FROM starts""")
def chunk_tokens(spark, sf_dir):
    return extensions.chunk_tokens(_documents(spark, sf_dir), ChunkOptions(100, 20))


@query("max_chunks_per_file", f"""WITH {BUILD_SQL} SELECT relative_path, source_ord, start_line FROM emitted
  WHERE start_line <= {2 * CONFIG.chunk.step + 1}""")
def max_chunks_per_file(spark, sf_dir):
    emitted = _built(spark, sf_dir).emitted
    return extensions.first_chunks(emitted, CONFIG.chunk, 3).select("relative_path", "source_ord", "start_line")


@query("language_coverage", f"""WITH {RECORDS_SQL}, {SOURCES_SQL}, found AS (
    SELECT source_ord, list(DISTINCT language) AS f FROM records GROUP BY source_ord)
  SELECT source_ord,
    array_to_string(list_sort(list_filter(languages, lambda x: NOT list_contains(f, x))), ',') AS missing,
    array_to_string(list_sort(list_filter(f, lambda x: NOT list_contains(languages, x))), ',') AS beyond
  FROM sources JOIN found USING (source_ord)""")
def language_coverage(spark, sf_dir):
    covered = extensions.language_coverage(file_records(spark, sf_dir), inputs.sources(spark, sf_dir))
    return covered.select(
        "source_ord", *[F.array_join(c, ",").alias(c) for c in ("missing", "beyond")])


@query("dedup_ratios", f"""WITH {COUNTERS_SQL} SELECT files_deduplicated / files_scanned AS file_ratio,
  chunks_deduplicated / chunks_generated AS chunk_ratio FROM counters""")
def dedup_ratios(spark, sf_dir):
    return extensions.dedup_ratios(_built(spark, sf_dir).counters())


@query("estimate_run", """WITH planted AS (SELECT CASE WHEN doc_id % 3 = 0 THEN text || chr(10)
      WHEN doc_id % 3 = 1 THEN text || chr(10) || chr(10) ELSE text END AS text FROM documents),
  counted AS (SELECT len(string_split(text, chr(10)))
    - CASE WHEN text LIKE '%' || chr(10) THEN 1 ELSE 0 END AS n FROM planted WHERE text <> ''),
  sums AS (SELECT (SELECT count(*) FROM documents) AS files,
    CAST(sum(greatest(0, n - 2) // 3 + 1) AS BIGINT) AS chunks FROM counted)
  SELECT files, chunks, CAST(ceil(chunks / 1000) AS BIGINT) AS shards FROM sums""")
def estimate_run(spark, sf_dir):
    """Every document; two thirds of them get the line breaks at the end that files have."""
    ends = F.when(F.col("doc_id") % 3 == 0, "\n").when(F.col("doc_id") % 3 == 1, "\n\n").otherwise("")
    planted = _documents(spark, sf_dir).withColumn("content", F.concat("content", ends))
    return extensions.estimate_run(planted, ChunkOptions(4, 1), 1000)


@query("write_parquet", f"""WITH {BUILD_SQL} SELECT split, content, language, relative_path AS source_path,
  start_line, end_line, file_hash AS hash FROM emitted""")
def write_parquet(spark, sf_dir):
    path = writers.write_parquet(_built(spark, sf_dir).emitted, new_path(spark, "dataset"))
    return spark.read.parquet(path).select("split", "content", "language", "metadata.*")


@query("shard_index", f"""WITH {BUILD_SQL} SELECT CAST(count(*) AS BIGINT) AS records,
  min(start_line) AS first_line, max(end_line) AS last_line, TRUE AS within FROM emitted""")
def shard_index(spark, sf_dir):
    """Shards of at most 100 rows; the names of files differ from run to run, so sums are compared."""
    path = writers.write_parquet(
        _built(spark, sf_dir).emitted, new_path(spark, "shards"), shard_records=100)
    return writers.shard_index(spark.read.parquet(path)).agg(
        F.sum("records").alias("records"), F.min("first_line").alias("first_line"),
        F.max("last_line").alias("last_line"), (F.max("records") <= 100).alias("within"))


SHARDS = {"jsonl": DatasetOptions(), "parquet": DatasetOptions(output_format="parquet")}


def _with_strays(spark, sf_dir, form):
    """A dataset with its list of shards, to which another job then adds its train items again."""
    emitted, path, options = _built(spark, sf_dir).emitted, new_path(spark, "listed"), SHARDS[form]
    strays = writers.dataset_item(emitted.filter("split = 'train'"))
    if form == "parquet":
        folder = f"{writers.write_parquet(emitted, path, shard_records=100)}/split=train"
    else:
        folder = writers.write_jsonl(emitted, path, shard_records=100)["train"]
    manifest.write_manifest(spark, path, options)
    getattr(strays.write.mode("append"), "parquet" if form == "parquet" else "json")(folder)
    return path, options


_LISTED_SQL = f"""WITH {BUILD_SQL} SELECT split, content, language, relative_path AS source_path,
  start_line, end_line, file_hash AS hash FROM emitted"""


@query("read_listed_shards", _LISTED_SQL)
def read_listed_shards(spark, sf_dir):
    """The stray files beside the shards give no rows."""
    path, options = _with_strays(spark, sf_dir, "jsonl")
    return manifest.read_dataset(spark, path, options).select("split", "content", "language", "metadata.*")


@query("shard_manifest", f"""WITH {BUILD_SQL} SELECT 'listed' AS part, split, count(*) AS records, TRUE AS within
  FROM emitted GROUP BY split UNION ALL SELECT 'stray', split, count(*), TRUE FROM emitted
  WHERE split = 'train' GROUP BY split""")
def shard_manifest(spark, sf_dir):
    """Records by split in the listed shards and in those that do not belong; names differ from run to run."""
    path, options = _with_strays(spark, sf_dir, "parquet")
    listed = manifest.read_manifest(spark, path).select(F.lit("listed").alias("part"), "split", "records")
    strays = manifest.shard_differences(spark, path, options).select(
        F.col("difference").alias("part"), "split", "records")
    within = (F.max("records") <= 100) | (F.col("part") != "listed")
    return listed.unionByName(strays).groupBy("part", "split").agg(
        F.sum("records").alias("records"), within.alias("within"))


# --- source trees: the tables written as files, then scanned ---------------------------------------
def _write_tree(files, folder):
    """Write rows (``place``, ``raw``) as files below a mounted folder, on the executors."""

    def write(batches):
        for batch in batches:
            for place, raw in batch.itertuples(index=False):
                path = f"{folder}/{place}"
                os.makedirs(os.path.dirname(path), exist_ok=True)
                with open(path, "wb") as handle:
                    handle.write(raw)
            yield pd.DataFrame({"written": [len(batch)]})

    bound_batches(files.sparkSession)
    stage(files.select("place", "raw").mapInPandas(write, "written bigint"), "written-files")


def _mounted(spark, name):
    """A new folder in the shared one, which must lie on a mounted file system: trees are read from such."""
    path = qualified(spark, new_path(spark, name))
    if not path.startswith("file:"):
        raise RuntimeError(f"source trees need a mounted folder, not {path}")
    return "/" + path.removeprefix("file:").lstrip("/")


_EXTENSIONS_SQL = ", ".join(f"'{e}'" for e in fixed.DEFAULT_INCLUDE_EXTENSIONS)


@query("scan_source_tree", f"""WITH {FILES_SQL}, tagged AS (SELECT *, {EXT_SQL} AS ext FROM files)
  SELECT source_ord, source_name, relative_path, size, sha1(text) AS file_hash FROM tagged
  WHERE (ext = '' OR ext IN ({_EXTENSIONS_SQL})) AND relative_path NOT LIKE '%/vendor/%'
    AND relative_path NOT LIKE '%/build/%'""")
def scan_source_tree(spark, sf_dir):
    folder = _mounted(spark, "tree")
    _write_tree(inputs.files(spark, sf_dir).select(
        F.concat_ws("/", "source_name", "relative_path").alias("place"),
        F.col("text").cast("binary").alias("raw")), folder)
    sources = [
        ResolvedSource(n, f"src{n}", "code", "local", f"{folder}/src{n}") for n in range(20)
    ]
    raw = scan.scan_source_tree(spark, sources, IngestionOptions())
    return raw.select(
        "source_ord", "source_name", "relative_path", "size", F.sha1("raw").alias("file_hash"))


_HISTORIES_SQL = f"""WITH {TRANSCRIPTS_SQL} SELECT source_ord, path || '.history' AS path,
  row_number() OVER (PARTITION BY source_ord, path ORDER BY line_no) - 1 AS line_no, line
  FROM transcripts"""


def _histories(spark, sf_dir, line_end="'\\n'", **options):
    """Write a file per transcript, its lines joined by an expression, and scan the files."""
    folder = _mounted(spark, "histories")
    lines = F.sort_array(F.collect_list(F.struct("line_no", "line")))
    texts = inputs.transcripts(spark, sf_dir).groupBy("source_ord", "path").agg(lines.alias("_held"))
    _write_tree(texts.select(
        F.concat(F.lit("hist"), "source_ord", F.lit("/"), "path", F.lit(".history")).alias("place"),
        F.expr(f"array_join(_held.line, {line_end})").cast("binary").alias("raw")), folder)
    sources = [
        ResolvedSource(n, f"hist{n}-commands", "commands", "local", f"{folder}/hist{n}",
                       commands=CommandSource(f"hist{n}", "local", f"{folder}/hist{n}"))
        for n in range(3)
    ]
    return scan.scan_command_files(spark, sources, **options).withColumn(
        "path", F.substring_index("path", "/", -1))


@query("scan_command_files", _HISTORIES_SQL)
def scan_command_files(spark, sf_dir):
    return _histories(spark, sf_dir)


@query("scan_command_file_ranges", _HISTORIES_SQL)
def scan_command_file_ranges(spark, sf_dir):
    """Every file is cut into ranges of 256 bytes; lines end in three ways."""
    line_end = "CASE source_ord WHEN 0 THEN '\\n' WHEN 1 THEN '\\r' ELSE '\\r\\n' END"
    return _histories(spark, sf_dir, line_end, range_bytes=256)


NEAR_SQL = r"""docs AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
  classes AS (SELECT array_to_string(w, ' ') AS words, min(doc_id) AS class_id, any_value(w) AS w
    FROM docs GROUP BY array_to_string(w, ' ')),
  sets AS (SELECT class_id, CASE WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE list_distinct(
      [array_to_string(w[k:k + 4], ' ') for k in range(1, len(w) - 3)]) END AS s FROM classes WHERE len(w) > 0),
  entries AS (SELECT class_id, len(s) AS n, unnest(s) AS g FROM sets),
  met AS (SELECT x.class_id AS a, y.class_id AS b, x.n + y.n AS total, count(*) AS c
    FROM entries x JOIN entries y USING (g) WHERE x.class_id < y.class_id GROUP BY ALL),
  links AS (SELECT a, b FROM met WHERE c / (total - c) >= 0.8),
  ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links)"""
DOC_ORDER = ("doc_id",)


@query("near_duplicate_links", f"""WITH {NEAR_SQL}, counted AS (SELECT a, count(*) AS n FROM ways GROUP BY a)
  SELECT doc_id, class_id, CAST(coalesce(n, 0) AS BIGINT) AS links FROM docs
  JOIN classes ON array_to_string(docs.w, ' ') = words LEFT JOIN counted ON a = class_id""")
def near_duplicate_links(spark, sf_dir):
    """Per document the smallest id with the same words, and how many other texts are near it."""
    docs = _documents(spark, sf_dir)
    classes = word_classes(docs, DOC_ORDER)
    pairs = similar_pairs(class_sets(docs, DOC_ORDER, NearOptions(), classes=classes), 0.8)
    ways = pairs.select(F.explode(F.array("a", "b")).alias("class")).groupBy("class").agg(
        F.count(F.lit(1)).alias("links"))
    named = classes.groupBy("class").agg(F.min("doc_id").alias("class_id")).join(ways, "class", "left")
    return classes.join(named.hint("merge"), "class").select(
        "doc_id", "class_id", F.coalesce("links", F.lit(0).cast("bigint")).alias("links"))


@query("near_duplicate_groups", f"""WITH RECURSIVE {NEAR_SQL},
  reach AS (SELECT class_id AS u, class_id AS v FROM classes UNION SELECT u, b FROM reach JOIN ways ON v = a),
  firsts AS (SELECT u, min(v) AS component_id FROM reach GROUP BY u)
  SELECT doc_id, component_id FROM docs JOIN classes ON array_to_string(docs.w, ' ') = words
  JOIN firsts ON u = class_id""")
def near_duplicate_groups(spark, sf_dir):
    """Per document the smallest id of its group by bands and stars; the SQL links all similar pairs."""
    groups = near_groups(_documents(spark, sf_dir), DOC_ORDER)
    firsts = groups.groupBy("group").agg(F.min("doc_id").alias("component_id"))
    return groups.join(firsts.hint("merge"), "group").select("doc_id", "component_id")


# --- accounts of rejected files --------------------------------------------------------------------
ACCOUNTED = dataclasses.replace(
    CONFIG,
    ingestion=IngestionOptions(max_file_size_mb=1024 / (1 << 20), exclude_globs=("*/f1?.*",)),
    quality=QualityOptions(min_characters=128, min_lines=2, forbidden_patterns=("[ ]be[ ]",)),
    dataset=DatasetOptions(write_rejections=True),
)
LEDGER_SQL = rf"""{FILES_SQL}, {SOURCES_SQL},
planted AS (SELECT * REPLACE (CASE WHEN doc_id % 13 = 0 THEN NULL WHEN doc_id % 11 = 0 THEN text || chr(1)
    WHEN doc_id % 17 = 0 THEN 'one' || chr(10) || 'copy' ELSE text END AS text) FROM files),
listed AS (SELECT *, {EXT_SQL} AS ext, lower(relative_path) AS low FROM planted),
early AS (SELECT l.* EXCLUDE (size), strlen(text) AS size, sha1(text) AS file_hash, {LANGUAGE_SQL} AS language, CASE
    WHEN relative_path LIKE '%/vendor/%' OR relative_path LIKE '%/build/%' THEN 'directory'
    WHEN NOT (ext = '' OR ext IN ({_EXTENSIONS_SQL})) THEN 'extension'
    WHEN low GLOB '*/f1?.*' THEN 'excluded' WHEN strlen(text) > 1024 THEN 'size'
    WHEN text IS NULL THEN 'unreadable'
    WHEN regexp_matches(text, '[\x00-\x06\x0B\x0E-\x1A\x1C-\x1F]') THEN 'binary'
    WHEN len(s.languages) > 0 AND NOT list_contains(s.languages, {LANGUAGE_SQL}) THEN 'language' END AS reason
  FROM listed l JOIN sources s USING (source_ord)),
firsts AS (SELECT * FROM early WHERE reason IS NULL QUALIFY row_number() OVER (
  PARTITION BY file_hash ORDER BY source_ord, relative_path) = 1),
gated AS (SELECT *, {normalise_sql('text', 400)} AS content FROM firsts),
late AS (SELECT *, CASE WHEN length(content) < 128 OR len(string_split(content, chr(10))) < 2 THEN 'gates'
  WHEN regexp_matches(content, '[ ]be[ ]') THEN 'forbidden' END AS why FROM gated),
ledger AS (SELECT source_ord, source_name, relative_path, CAST(size AS BIGINT) AS size, reason FROM early
  WHERE reason IS NOT NULL UNION ALL SELECT source_ord, source_name, relative_path, CAST(size AS BIGINT), why
  FROM late WHERE why IS NOT NULL)"""


def _accounted(spark, sf_dir):
    """A build with a ledger; some documents have no text, are binary or are copies."""
    files, key = inputs.files(spark, sf_dir), F.col("doc_id")
    text = (
        F.when(key % 13 == 0, F.lit(None).cast("string")).when(key % 11 == 0, F.concat("text", F.lit("\x01")))
        .when(key % 17 == 0, "one\ncopy").otherwise(F.col("text"))
    )
    raw = tables.raw_records(
        files, source_ord=F.col("source_ord"), source_name=F.col("source_name"),
        relative_path=F.col("relative_path"), text=text,
    ).withColumn(ledger.REJECTED, ledger.listing_reason(ACCOUNTED.ingestion))
    records = ledger.reject_source_language(tables.to_records(raw), inputs.sources(spark, sf_dir))
    return build_chunks(records, ACCOUNTED)


@query("rejection_ledger", f"WITH {LEDGER_SQL} SELECT * FROM ledger")
def rejection_ledger(spark, sf_dir):
    return _accounted(spark, sf_dir).rejections


@query("rejection_counts", f"""WITH {LEDGER_SQL}
  SELECT reason, count(*) AS files FROM ledger GROUP BY reason
  UNION ALL SELECT 'listed', count(*) FROM planted
  UNION ALL SELECT 'emitted', count(*) FROM late WHERE why IS NULL
  UNION ALL SELECT 'deduplicated', (SELECT count(*) FROM early WHERE reason IS NULL) - (SELECT count(*) FROM firsts)""")
def rejection_counts(spark, sf_dir):
    """Files per reason beside the files emitted and deduplicated; ``listed`` is the sum of all of them."""
    built = _accounted(spark, sf_dir)
    counted = built.counters().select(F.inline(F.array(*[
        F.struct(F.lit(name).alias("reason"), F.col(f"files_{name}").alias("files"))
        for name in ("emitted", "deduplicated")
    ])))
    parts = stage(ledger.reason_counts(built.rejections).unionByName(counted), "reason-counts")
    return parts.unionByName(parts.agg(F.lit("listed").alias("reason"), F.sum("files").alias("files")))

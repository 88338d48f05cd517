"""Queries for scans, filters, joins, deduplication, windows and metadata."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.config import (
    ChunkOptions, DatasetOptions, IngestionOptions, PreprocessOptions, QualityOptions,
)
from millrace.functions import fixed, paths, text
from millrace.operators import chunking, commands, filters, metadata, split
from millrace.operators.dedup import keep_first
from millrace.queries import inputs
from millrace.queries.inputs import (
    FILES_SQL, MESSY_SQL, REPO_PATHS_SQL, REPOS_SQL, SOURCES_SQL, TRANSCRIPTS_SQL,
)
from millrace.queries.registry import query
from millrace.queries.text_queries import (
    COMMENT_SQL, EXT_SQL, LANGUAGE_SQL, PROMPT_SQL, STRIP_SQL, WORDS_SQL, lines_sql, normalise_sql,
)
from millrace.sources import tables

FILE_ORDER = ["source_ord", "relative_path"]
GATES = QualityOptions(min_characters=256, max_characters=5000, min_lines=2, max_lines=40)
SMALL_FILE = 2048


def file_records(spark, sf_dir):
    raw = tables.raw_records(
        inputs.files(spark, sf_dir),
        source_ord=F.col("source_ord"), source_name=F.col("source_name"),
        relative_path=F.col("relative_path"), text=F.col("text"),
    )
    return tables.to_records(raw)


RECORDS_SQL = f"""{FILES_SQL}, tagged AS (SELECT *, {EXT_SQL} AS ext FROM files),
records AS (SELECT source_ord, source_name, relative_path, text AS content,
  {LANGUAGE_SQL} AS language, sha1(text) AS file_hash, size FROM tagged)"""


# --- scans -------------------------------------------------------------------------------
@query("scan_record_table", f"WITH {RECORDS_SQL} SELECT * FROM records")
def scan_record_table(spark, sf_dir):
    return file_records(spark, sf_dir)


@query("union_sources", """
  SELECT 0 AS source_ord, 'documents' AS source_name, CAST(doc_id AS VARCHAR) AS relative_path,
         sha1(text) AS file_hash, CAST(strlen(text) AS BIGINT) AS size FROM documents
  UNION ALL SELECT 1, 'conversations', conv_id || '/' || turn, sha1(text), strlen(text)
  FROM conversations
  UNION ALL SELECT 2, 'pages', CAST(page_id AS VARCHAR), sha1(html), strlen(html) FROM pages""")
def union_sources(spark, sf_dir):
    def source(number, name, path, content):
        return tables.scan_record_table(
            spark, f"{sf_dir}/{name}.parquet",
            source_ord=F.lit(number), source_name=F.lit(name),
            relative_path=path.cast("string"), text=F.col(content),
        )

    raw = tables.union_sources(
        source(0, "documents", F.col("doc_id"), "text"),
        source(1, "conversations", F.concat_ws("/", "conv_id", "turn"), "text"),
        source(2, "pages", F.col("page_id"), "html"),
    )
    return tables.to_records(raw).select(
        "source_ord", "source_name", "relative_path", "file_hash", "size"
    )


# --- filters -----------------------------------------------------------------------------
@query("filter_extension", f"""WITH {FILES_SQL} SELECT doc_id, relative_path FROM files
  WHERE {EXT_SQL} IN ('', {', '.join(f"'{e}'" for e in fixed.DEFAULT_INCLUDE_EXTENSIONS)})""")
def filter_extension(spark, sf_dir):
    files = inputs.files(spark, sf_dir).select("doc_id", "relative_path")
    return filters.filter_extension(files, fixed.DEFAULT_INCLUDE_EXTENSIONS)


@query("filter_dirs", f"""WITH {FILES_SQL} SELECT doc_id, relative_path FROM files
  WHERE NOT list_has_any(string_split(relative_path, '/')[:-2],
    [{', '.join(f"'{d}'" for d in fixed.DEFAULT_EXCLUDE_DIRS)}])""")
def filter_dirs(spark, sf_dir):
    files = inputs.files(spark, sf_dir).select("doc_id", "relative_path")
    return filters.filter_dirs(files, fixed.DEFAULT_EXCLUDE_DIRS)


@query("filter_size",
       f"WITH {FILES_SQL} SELECT doc_id, size FROM files WHERE size <= {SMALL_FILE}")
def filter_size(spark, sf_dir):
    return filters.filter_size(inputs.files(spark, sf_dir), SMALL_FILE).select("doc_id", "size")


@query("filter_binary", r"""WITH marked AS (SELECT doc_id,
    CASE WHEN doc_id % 11 = 0 THEN text || chr(1) ELSE text END AS content FROM documents)
  SELECT doc_id FROM marked
  WHERE NOT regexp_matches(content, '[\x00-\x06\x0B\x0E-\x1A\x1C-\x1F]')""")
def filter_binary(spark, sf_dir):
    content = F.when(F.col("doc_id") % 11 == 0, F.concat("text", F.lit("\x01"))).otherwise(F.col("text"))
    documents = inputs.table(spark, sf_dir, "documents")
    marked = documents.select("doc_id", content.cast("binary").alias("raw"))
    return filters.filter_binary(marked).select("doc_id")


@query("filter_globs", f"""WITH {FILES_SQL},
  named AS (SELECT doc_id, lower('/data/' || source_name || '/' || relative_path) AS path FROM files)
  SELECT doc_id, path FROM named
  WHERE (path GLOB '*.sh' OR path GLOB '*.md' OR path GLOB '*/f1?.*' OR path GLOB '*/src3/*')
    AND NOT path GLOB '*/vendor/*'""")
def filter_globs(spark, sf_dir):
    path = F.lower(F.concat(F.lit("/data/"), "source_name", F.lit("/"), "relative_path"))
    files = inputs.files(spark, sf_dir).select("doc_id", path.alias("path"))
    return files.filter(
        paths.matches_globs("path", ["*.sh", "*.MD", "f1?.*", "*/src3/*"])
        & ~paths.matches_globs("path", ["*/vendor/*"])
    )


@query("filter_source_language", f"""WITH {RECORDS_SQL}, {SOURCES_SQL}
  SELECT r.source_ord, r.relative_path, r.language FROM records r JOIN sources s USING (source_ord)
  WHERE len(s.languages) = 0 OR list_contains(s.languages, r.language)""")
def filter_source_language(spark, sf_dir):
    records = file_records(spark, sf_dir).select(*FILE_ORDER, "language")
    return filters.filter_source_language(records, inputs.sources(spark, sf_dir))


_CUSTOMER_FOCUS = """CASE c_custkey % 4 WHEN 0 THEN {empty} WHEN 1 THEN {array}('python', 'go'{end}
  WHEN 2 THEN {array}('markdown'{end} ELSE {array}('shell', 'text', 'go'{end} END"""


@query("filter_source_language_bits", f"""WITH {RECORDS_SQL}, spread AS (SELECT doc_id, r.relative_path, r.language,
    CAST(doc_id * 7 % ((SELECT count(*) FROM customer) + 40) AS INTEGER) AS ord FROM records r
    JOIN files f USING (source_ord, relative_path)),
  focused AS (SELECT c_custkey, {_CUSTOMER_FOCUS.format(
      empty="CAST([] AS VARCHAR[])", array="list_value", end=")")} AS languages FROM customer)
  SELECT doc_id, ord AS source_ord, language FROM spread JOIN focused ON ord = c_custkey
  WHERE len(languages) = 0 OR list_contains(languages, language)""")
def filter_source_language_bits(spark, sf_dir):
    """A source per customer, beyond a bound of no rows; some documents are of unknown sources."""
    customers = inputs.table(spark, sf_dir, "customer")
    sources = customers.select(
        F.col("c_custkey").cast("int").alias("source_ord"),
        F.expr(_CUSTOMER_FOCUS.format(empty="CAST(array() AS array<string>)", array="array", end=")"))
        .alias("languages"))
    spread = F.expr("CAST(doc_id * 7 % (customers + 40) AS INT)").alias("source_ord")
    files = inputs.files(spark, sf_dir).select(
        "doc_id", "relative_path", paths.detect_language("relative_path").alias("language"),
        F.lit(customers.count()).alias("customers")).select("doc_id", spread, "language")
    return filters.filter_source_language(files, sources, limit=0)


@query("source_attributes", f"""WITH {RECORDS_SQL}, {SOURCES_SQL}
  SELECT r.source_ord, r.relative_path, s.name, s.kind, s.origin, s.path,
         array_to_string(s.languages, ',') AS languages
  FROM records r JOIN sources s USING (source_ord)""")
def source_attributes(spark, sf_dir):
    records = file_records(spark, sf_dir).select(*FILE_ORDER)
    joined = filters.with_source_attributes(records, inputs.sources(spark, sf_dir))
    return joined.withColumn("languages", F.array_join("languages", ","))


@query("quality_gates", """SELECT doc_id FROM documents
  WHERE length(text) BETWEEN 256 AND 5000
    AND CASE WHEN text = '' THEN 0 ELSE len(string_split(text, chr(10))) END BETWEEN 2 AND 40""")
def quality_gates(spark, sf_dir):
    documents = inputs.table(spark, sf_dir, "documents")
    return filters.quality_gates(
        documents.select("doc_id", F.col("text").alias("content")), GATES
    ).select("doc_id")


@query("preprocess_record", f"""WITH {MESSY_SQL}
  SELECT doc_id, sha1(content) AS file_hash, {normalise_sql('content', 400)} AS content FROM messy""")
def preprocess_record(spark, sf_dir):
    messy = inputs.messy(spark, sf_dir).select(
        "doc_id", text.fingerprint("content").alias("file_hash"), "content"
    )
    return chunking.preprocess_record(messy, PreprocessOptions(max_line_length=400))


# --- deduplication ---------------------------------------------------------------------------
FIRST_FILES_SQL = f"""WITH {RECORDS_SQL} SELECT source_ord, relative_path, file_hash FROM records
  QUALIFY row_number() OVER (PARTITION BY file_hash ORDER BY source_ord, relative_path) = 1"""


@query("dedup_files", FIRST_FILES_SQL)
def dedup_files(spark, sf_dir):
    records = file_records(spark, sf_dir)
    return keep_first(records, ["file_hash"], FILE_ORDER).select(*FILE_ORDER, "file_hash")


@query("survivor_semi_join", FIRST_FILES_SQL)
def survivor_semi_join(spark, sf_dir):
    """The same by the way taken when the repeated keys do not fit a broadcast."""
    records = file_records(spark, sf_dir)
    return keep_first(records, ["file_hash"], FILE_ORDER, limit=0).select(*FILE_ORDER, "file_hash")


# --- windows of lines ------------------------------------------------------------------------
def chunks_sql(source: str, size: int, overlap: int, content: str = "content", keep: str = "doc_id") -> str:
    """CTEs ``cut`` and ``chunks`` over a relation with a text column."""
    step = size - overlap
    return f"""cut AS (SELECT {keep}, {lines_sql(content)} AS lines FROM {source}),
      starts AS (SELECT {keep}, lines, unnest(CASE WHEN len(lines) = 0 THEN CAST([] AS BIGINT[])
        ELSE range(0, greatest(0, len(lines) - {overlap} - 1) + 1, {step}) END) AS s FROM cut),
      chunks AS (SELECT {keep}, CAST(s + 1 AS BIGINT) AS start_line,
        CAST(least(len(lines), s + {size}) AS BIGINT) AS end_line,
        array_to_string(list_slice(lines, s + 1, s + {size}), chr(10)) AS content FROM starts)"""


def _chunked(spark, sf_dir, size, overlap):
    documents = inputs.table(spark, sf_dir, "documents")
    return chunking.chunk_lines(
        documents.select("doc_id", F.col("text").alias("content")), ChunkOptions(size, overlap)
    )


@query("chunk_lines", f"WITH {chunks_sql('documents', 4, 1, 'text')} SELECT * FROM chunks")
def chunk_lines(spark, sf_dir):
    return _chunked(spark, sf_dir, 4, 1)


@query("chunk_lines_overlapped",
       f"WITH {chunks_sql('documents', 7, 6, 'text')} SELECT * FROM chunks")
def chunk_lines_overlapped(spark, sf_dir):
    return _chunked(spark, sf_dir, 7, 6)


@query("chunk_fingerprint", f"""WITH {chunks_sql('documents', 3, 0, 'text')}
  SELECT doc_id, start_line, sha1(content) AS chunk_hash FROM chunks""")
def chunk_fingerprint(spark, sf_dir):
    chunks = chunking.with_chunk_hash(_chunked(spark, sf_dir, 3, 0))
    return chunks.select("doc_id", "start_line", "chunk_hash")


@query("dedup_chunks", f"""WITH {chunks_sql('documents', 3, 0, 'text')}
  SELECT doc_id, start_line, end_line, content FROM chunks
  QUALIFY row_number() OVER (PARTITION BY sha1(content) ORDER BY doc_id, start_line) = 1""")
def dedup_chunks(spark, sf_dir):
    chunks = chunking.with_chunk_hash(_chunked(spark, sf_dir, 3, 0))
    return keep_first(chunks, ["chunk_hash"], ["doc_id", "start_line"]).drop("chunk_hash")


# --- commands ----------------------------------------------------------------------------------
SHELLS_SQL = ", ".join(f"'{s}'" for s in fixed.DEFAULT_SHELLS)
FOUND_SQL = f"""{TRANSCRIPTS_SQL},
stripped AS (SELECT source_ord, path, line_no, {STRIP_SQL % 'line'} AS line FROM transcripts),
cleaned AS (SELECT source_ord, path, line_no, {WORDS_SQL % (PROMPT_SQL % 'line')} AS command
  FROM stripped WHERE line <> '' AND NOT {COMMENT_SQL % 'line'}),
found AS (SELECT * FROM cleaned WHERE command <> '' AND lower(command) NOT IN ({SHELLS_SQL}))"""
CORPUS_SQL = f"""{FOUND_SQL}, corpus AS (SELECT * FROM found QUALIFY row_number() OVER (
  PARTITION BY source_ord, command ORDER BY path, line_no) = 1)"""


@query("command_line_predicates",
       f"WITH {FOUND_SQL} SELECT source_ord, path, line_no, command FROM found")
def command_line_predicates(spark, sf_dir):
    return commands.command_lines(inputs.transcripts(spark, sf_dir), fixed.DEFAULT_SHELLS)


@query("extract_commands", f"""WITH {FOUND_SQL}, once AS (SELECT * FROM found
    QUALIFY row_number() OVER (PARTITION BY source_ord, path, command ORDER BY line_no) = 1)
  SELECT source_ord, path, line_no, command FROM once
  QUALIFY row_number() OVER (PARTITION BY source_ord, path ORDER BY line_no) <= 20""")
def extract_commands(spark, sf_dir):
    return commands.extract_commands(inputs.transcripts(spark, sf_dir), fixed.DEFAULT_SHELLS, 20)


def _corpus(spark, sf_dir):
    return commands.command_corpus(inputs.transcripts(spark, sf_dir), fixed.DEFAULT_SHELLS)


@query("command_corpus_distinct",
       f"WITH {CORPUS_SQL} SELECT source_ord, path, line_no, command FROM corpus")
def command_corpus_distinct(spark, sf_dir):
    return _corpus(spark, sf_dir)


@query("command_cap", f"""WITH {CORPUS_SQL} SELECT source_ord, path, line_no, command FROM corpus
  QUALIFY row_number() OVER (PARTITION BY source_ord ORDER BY path, line_no) <= 50""")
def command_cap(spark, sf_dir):
    return commands.command_cap(_corpus(spark, sf_dir), 50)


TEXTS_SQL = f"""{CORPUS_SQL}, texts AS (SELECT source_ord,
  string_agg(command, chr(10) ORDER BY path, line_no) AS text FROM corpus GROUP BY source_ord)"""


@query("collect_command_corpus", f"""WITH {TEXTS_SQL}
  SELECT source_ord, CAST(strlen(text) AS BIGINT) AS size, text FROM texts
  WHERE strlen(text) <= {IngestionOptions().max_bytes}""")
def collect_command_corpus(spark, sf_dir):
    return commands.corpus_records(_corpus(spark, sf_dir), IngestionOptions().max_bytes).drop("part")


@query("oversize_command_corpus", f"""WITH {CORPUS_SQL},
  placed AS (SELECT source_ord, path, line_no, command,
    coalesce(sum(strlen(command) + 1) OVER (PARTITION BY source_ord ORDER BY path, line_no
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
    sum(strlen(command) + 1) OVER (PARTITION BY source_ord) - 1 AS whole FROM corpus)
  SELECT source_ord, CAST(CASE WHEN whole <= 2000 THEN 0 ELSE before // 1000 END AS BIGINT) AS part,
    CAST(sum(strlen(command) + 1) - 1 AS BIGINT) AS size,
    string_agg(command, chr(10) ORDER BY path, line_no) AS text FROM placed GROUP BY 1, 2""")
def oversize_command_corpus(spark, sf_dir):
    """Corpora above a cap of 2,000 bytes come as parts; no command is lost."""
    return commands.corpus_records(_corpus(spark, sf_dir), 2000)


PART_WINDOWS = ChunkOptions(target_chunk_size=12, overlap=5)


@query("command_windows_over_parts", f"""WITH {CORPUS_SQL},
  held AS (SELECT source_ord, list(command ORDER BY path, line_no) AS w FROM corpus GROUP BY source_ord),
  starts AS (SELECT source_ord, w, unnest(generate_series(0, greatest(0, len(w) - 6), 7)) AS s FROM held)
  SELECT source_ord, s + 1 AS start_line, least(len(w), s + 12) AS end_line,
    array_to_string(w[s + 1:s + 12], chr(10)) AS content FROM starts""")
def command_windows_over_parts(spark, sf_dir):
    """Windows of corpora cut at 2,000 bytes are those of the uncut corpora."""
    texts = commands.corpus_records(_corpus(spark, sf_dir), 2000, PART_WINDOWS)
    windows = chunking.chunk_lines(texts.withColumnRenamed("text", "content"), PART_WINDOWS)
    return windows.select(
        "source_ord", (F.col("start_line") + F.col("first_line")).alias("start_line"),
        (F.col("end_line") + F.col("first_line")).alias("end_line"), "content")


@query("command_cap_per_source", f"""WITH {CORPUS_SQL} SELECT source_ord, path, line_no, command
  FROM corpus QUALIFY source_ord = 2 OR row_number() OVER (PARTITION BY source_ord
  ORDER BY path, line_no) <= CASE source_ord WHEN 0 THEN 50 ELSE 120 END""")
def command_cap_per_source(spark, sf_dir):
    return commands.command_cap(_corpus(spark, sf_dir), {0: 50, 1: 120, 2: None})


@query("command_source_record", f"""WITH {TEXTS_SQL}
  SELECT source_ord, 'hist ' || source_ord || '-commands' AS source_name,
         'hist-' || source_ord || '.terminal' AS relative_path, text AS content,
         'terminal' AS language, sha1(text) AS file_hash, CAST(strlen(text) AS BIGINT) AS size
  FROM texts WHERE strlen(text) <= {IngestionOptions().max_bytes}""")
def command_source_record(spark, sf_dir):
    corpus = _corpus(spark, sf_dir)
    texts = commands.corpus_records(corpus, IngestionOptions().max_bytes)
    names = inputs.transcripts(spark, sf_dir).select("source_ord").distinct().select(
        "source_ord", F.concat(F.lit("Hist "), F.col("source_ord").cast("string")).alias("name")
    )
    raw = commands.command_source_records(texts, names, IngestionOptions())
    return tables.to_records(raw).withColumn("source_name", F.lower("source_name"))


@query("long_text_windows", f"""WITH {CORPUS_SQL},
  texts AS (SELECT source_ord, list(command ORDER BY path, line_no) AS lines FROM corpus
            GROUP BY source_ord),
  starts AS (SELECT source_ord, lines,
             unnest(range(0, greatest(0, len(lines) - 8) + 1, 43)) AS s FROM texts)
  SELECT source_ord, CAST(s + 1 AS BIGINT) AS start_line,
         CAST(least(len(lines), s + 50) AS BIGINT) AS end_line,
         array_to_string(list_slice(lines, s + 1, s + 50), chr(10)) AS content FROM starts""")
def long_text_windows(spark, sf_dir):
    lines = _corpus(spark, sf_dir).withColumnRenamed("command", "line")
    return chunking.long_text_windows(
        lines, ["source_ord"], ["path", "line_no"], ChunkOptions(50, 7)
    )


# --- split -------------------------------------------------------------------------------------
def split_sql(seed: int, ratio: float, chunk_hash: str) -> str:
    draw = f"CAST('0x' || substr(sha1('{seed}:' || {chunk_hash}), 1, 13) AS BIGINT)"
    return f"CASE WHEN {draw} < {int(ratio * 2**52)} THEN 'train' ELSE 'eval' END"


@query("train_eval_split", f"""SELECT doc_id, {split_sql(13, 0.9, 'sha1(text)')} AS split,
  {split_sql(1337, 0.92, 'sha1(text)')} AS other_split FROM documents""")
def train_eval_split(spark, sf_dir):
    documents = inputs.table(spark, sf_dir, "documents")
    hashed = documents.select("doc_id", text.fingerprint("text").alias("chunk_hash"))
    return hashed.select(
        "doc_id",
        split.hash_split(DatasetOptions()).alias("split"),
        split.hash_split(DatasetOptions(0.92, 1337)).alias("other_split"),
    )


# The seeded state of the generator word by word, then its stream in blocks of 227 words, the most that
# depend on earlier blocks alone.
def _mixed(word, last, factor, added):
    return (f"((xor({word}, (xor({last}, {last} >> 30) * {factor}) & 4294967295) + {added})"
            " & 4294967295)")


def twister_sql(seed, draws):
    """CTE ``draws(position, draw)`` of the Mersenne Twister seeded with a number below 2**32."""
    return f"""plain(i, v) AS (SELECT 0, 19650218::BIGINT UNION ALL SELECT i + 1,
    (1812433253 * xor(v, v >> 30) + i + 1) & 4294967295 FROM plain WHERE i < 623),
  keyed(i, v) AS (SELECT 0, v FROM plain WHERE i = 0 UNION ALL SELECT p.i,
    {_mixed('p.v', 'k.v', 1664525, seed)} FROM keyed k JOIN plain p ON p.i = k.i + 1),
  turned(i, v) AS (SELECT 1, {_mixed('k.v', 'z.v', 1664525, seed)} FROM keyed k, keyed z
    WHERE k.i = 1 AND z.i = 623
    UNION ALL SELECT k.i, {_mixed('k.v', 't.v', 1566083941, '4294967296 - k.i')}
    FROM turned t JOIN keyed k ON k.i = t.i + 1),
  state(i, v) AS (SELECT 0, 2147483648::BIGINT
    UNION ALL SELECT 1, {_mixed('f.v', 'l.v', 1566083941, 4294967295)} FROM turned f, turned l
    WHERE f.i = 1 AND l.i = 623
    UNION ALL SELECT i, v FROM turned WHERE i > 1),
  blocks(n, w) AS (SELECT 0, list(v ORDER BY i) FROM state UNION ALL SELECT n + 1,
    list_concat(w[228:], list_transform(range(1, 228), lambda i: xor(xor(w[i + 397],
      ((w[i] & 2147483648) | (w[i + 1] & 2147483647)) >> 1), (w[i + 1] & 1) * 2567483615)))
    FROM blocks WHERE n * 227 < 2 * {draws}),
  raw AS (SELECT (n - 1) * 227 + i - 1 AS o, w[397 + i] AS a FROM blocks, range(1, 228) AS r(i) WHERE n > 0),
  shift1 AS (SELECT o, xor(a, a >> 11) AS a FROM raw),
  shift2 AS (SELECT o, xor(a, (a << 7) & 2636928640) AS a FROM shift1),
  shift3 AS (SELECT o, xor(a, (a << 15) & 4022730752) AS a FROM shift2),
  outputs AS (SELECT o, xor(a, a >> 18) AS a FROM shift3),
  draws AS (SELECT x.o // 2 AS position, ((x.a >> 5) * 67108864 + (y.a >> 6)) / 9007199254740992.0::DOUBLE
    AS draw FROM outputs x JOIN outputs y ON y.o = x.o + 1 WHERE x.o % 2 = 0)"""


@query("train_eval_split_sequence", f"""WITH RECURSIVE {twister_sql(13, '(SELECT count(*) FROM documents)')},
  placed AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS position FROM documents)
  SELECT doc_id, CASE WHEN draw < 0.9 THEN 'train' ELSE 'eval' END AS split FROM placed JOIN draws USING (position)""")
def train_eval_split_sequence(spark, sf_dir):
    keys = inputs.table(spark, sf_dir, "documents").select("doc_id")
    return split.sequence_split(keys, ["doc_id"], DatasetOptions())


# --- repository metadata -------------------------------------------------------------------------
MANIFESTS_SQL = f"""{REPO_PATHS_SQL}, names(relative_path, ecosystem) AS (VALUES {', '.join(
    f"('{n}', '{e}')" for n, e in fixed.DEPENDENCY_MANIFESTS.items())}),
manifests AS (SELECT source_ord, relative_path, ecosystem FROM repo_paths JOIN names USING (relative_path))"""
CI_SQL = """ci AS (SELECT source_ord, relative_path, 'workflow' AS ci_kind FROM repo_paths
  WHERE relative_path IN ('.gitlab-ci.yml', 'Jenkinsfile')
     OR (relative_path LIKE '.github/workflows/%' AND relative_path LIKE '%.yml'))"""


@query("dependency_manifests", f"WITH {MANIFESTS_SQL} SELECT * FROM manifests")
def dependency_manifests(spark, sf_dir):
    return metadata.dependency_manifests(inputs.repo_paths(spark, sf_dir)).drop("is_dir")


@query("repo_manifests", f"WITH {MANIFESTS_SQL} SELECT * FROM manifests")
def repo_manifests(spark, sf_dir):
    return metadata.repo_manifests(inputs.repo_paths(spark, sf_dir)).drop("is_dir")


@query("ci_configs", f"WITH {REPO_PATHS_SQL}, {CI_SQL} SELECT * FROM ci")
def ci_configs(spark, sf_dir):
    return metadata.ci_configs(inputs.repo_paths(spark, sf_dir)).drop("is_dir")


@query("repository_metadata", f"""WITH {MANIFESTS_SQL}, {CI_SQL}, {REPOS_SQL},
  deps AS (SELECT source_ord, string_agg(relative_path || '=' || ecosystem, ',' ORDER BY relative_path)
           AS dependency_manifests FROM manifests GROUP BY 1),
  flows AS (SELECT source_ord, string_agg(relative_path || '=' || ci_kind, ',' ORDER BY relative_path)
           AS ci_cd FROM ci GROUP BY 1)
  SELECT source_ord, name, kind, origin, path, coalesce(dependency_manifests, '') AS dependency_manifests,
         coalesce(ci_cd, '') AS ci_cd
  FROM repos LEFT JOIN deps USING (source_ord) LEFT JOIN flows USING (source_ord)""")
def repository_metadata(spark, sf_dir):
    result = metadata.repository_metadata(
        inputs.repos(spark, sf_dir), inputs.repo_paths(spark, sf_dir)
    )
    for name in ("dependency_manifests", "ci_cd"):
        pairs = F.transform(F.map_entries(name), lambda e: F.concat_ws("=", e.key, e.value))
        result = result.withColumn(name, F.array_join(F.sort_array(pairs), ","))
    return result

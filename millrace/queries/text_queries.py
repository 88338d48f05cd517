"""Queries for text and path functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import fixed, paths, text
from millrace.queries import inputs
from millrace.queries.inputs import FILES_SQL, MESSY_SQL, TRANSCRIPTS_SQL
from millrace.queries.registry import query

BLANKS_SQL = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
STRIP_SQL = f"trim(%s, {BLANKS_SQL})"


def squeeze_sql(value: str) -> str:
    return f"regexp_replace({value}, '[\\t\\x0B\\x0C\\r]+', ' ', 'g')"


def blank_lines_sql(value: str) -> str:
    return f"regexp_replace({value}, '\\n{{3,}}', chr(10) || chr(10), 'g')"


def lines_sql(value: str) -> str:
    """Lines of a text whose only boundaries are line feeds and CR LF."""
    unix = f"replace(replace({value}, chr(13) || chr(10), chr(10)), chr(13), chr(10))"
    closed = f"CASE WHEN right({unix}, 1) = chr(10) THEN left({unix}, -1) ELSE {unix} END"
    return f"CASE WHEN {value} = '' THEN CAST([] AS VARCHAR[]) ELSE string_split({closed}, chr(10)) END"


def cut_sql(value: str, width: int) -> str:
    return f"array_to_string([substr(x, 1, {width}) FOR x IN {lines_sql(value)}], chr(10))"


def normalise_sql(value: str, width: int) -> str:
    return cut_sql(blank_lines_sql(STRIP_SQL % squeeze_sql(value)), width)


LANGUAGE_SQL = f"""CASE {' '.join(
    f"WHEN ext = '{e}' THEN '{lang}'" for e, lang in fixed.LANGUAGE_BY_EXTENSION.items()
)} ELSE 'unknown' END"""
EXT_SQL = "lower(regexp_extract(relative_path, '[^/](\\.[^./]+)$', 1))"


# --- bytes -----------------------------------------------------------------------------
@query("decode_text", "SELECT doc_id, text AS content FROM documents")
def decode_text(spark, sf_dir):
    """Every other document as Latin-1 bytes, the rest as UTF-8; both give the text back."""
    documents = inputs.table(spark, sf_dir, "documents")
    raw = F.when(F.col("doc_id") % 2 == 0, F.encode("text", "UTF-8")).otherwise(
        F.encode("text", "ISO-8859-1")
    )
    return documents.select("doc_id", raw.alias("raw")).select(
        "doc_id", text.decode_text("raw").alias("content")
    )


@query("file_fingerprint", "SELECT doc_id, sha1(text) AS file_hash FROM documents")
def file_fingerprint(spark, sf_dir):
    documents = inputs.table(spark, sf_dir, "documents")
    return documents.select("doc_id", text.fingerprint("text").alias("file_hash"))


# --- normalisation -----------------------------------------------------------------------
@query("normalize_whitespace",
       f"WITH {MESSY_SQL} SELECT doc_id, {squeeze_sql('content')} AS content FROM messy")
def normalize_whitespace(spark, sf_dir):
    messy = inputs.messy(spark, sf_dir)
    return messy.select("doc_id", text.normalize_whitespace("content").alias("content"))


@query("strip_text",
       f"""WITH {MESSY_SQL} SELECT doc_id,
       {STRIP_SQL % "chr(9) || chr(10) || content || '  ' || chr(13)"} AS content FROM messy""")
def strip_text(spark, sf_dir):
    padded = F.concat(F.lit("\t\n"), "content", F.lit("  \r"))
    messy = inputs.messy(spark, sf_dir)
    return messy.select("doc_id", text.strip_text(padded).alias("content"))


@query("collapse_blank_lines",
       f"WITH {MESSY_SQL} SELECT doc_id, {blank_lines_sql('content')} AS content FROM messy")
def collapse_blank_lines(spark, sf_dir):
    messy = inputs.messy(spark, sf_dir)
    return messy.select("doc_id", text.collapse_blank_lines("content").alias("content"))


@query("truncate_lines",
       f"WITH {MESSY_SQL} SELECT doc_id, {cut_sql('content', 80)} AS content FROM messy")
def truncate_lines(spark, sf_dir):
    messy = inputs.messy(spark, sf_dir)
    return messy.select("doc_id", text.truncate_lines("content", 80).alias("content"))


@query("truncate_page_lines",
       f"SELECT page_id, {cut_sql('html', 2000)} AS content FROM pages")
def truncate_page_lines(spark, sf_dir):
    pages = inputs.table(spark, sf_dir, "pages")
    return pages.select("page_id", text.truncate_lines("html", 2000).alias("content"))


@query("normalise_content",
       f"WITH {MESSY_SQL} SELECT doc_id, {normalise_sql('content', 400)} AS content FROM messy")
def normalise_content(spark, sf_dir):
    normalised = text.normalise_content("content", max_line_length=400)
    return inputs.messy(spark, sf_dir).select("doc_id", normalised.alias("content"))


# --- lines -------------------------------------------------------------------------------
@query("split_lines", f"""WITH {MESSY_SQL},
  cut AS (SELECT doc_id, {lines_sql('content')} AS lines FROM messy)
  SELECT doc_id, CAST(i AS BIGINT) AS line_no, lines[i] AS line
  FROM (SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS i FROM cut)""")
def split_lines(spark, sf_dir):
    lines = F.posexplode(text.split_lines("content")).alias("pos", "line")
    return inputs.messy(spark, sf_dir).select("doc_id", lines).select(
        "doc_id", (F.col("pos") + 1).cast("bigint").alias("line_no"), "line"
    )


@query("line_count", f"""WITH {MESSY_SQL} SELECT doc_id,
  CAST(CASE WHEN content = '' THEN 0 ELSE len(string_split(content, chr(10))) END AS BIGINT)
  AS line_count FROM messy""")
def line_count(spark, sf_dir):
    messy = inputs.messy(spark, sf_dir)
    return messy.select("doc_id", text.line_count("content").alias("line_count"))


# --- command lines -------------------------------------------------------------------------
COMMENT_SQL = r"regexp_matches(lower(%s), '^(#|//|rem |::|;)')"
PROMPT_SQL = r"regexp_replace(%s, '^([$#%%>λ]|PS |PS>|C:\\)\s*', '')"
WORDS_SQL = f"regexp_replace({STRIP_SQL}, '\\s+', ' ', 'g')"


@query("is_comment_line",
       f"WITH {TRANSCRIPTS_SQL} SELECT line_no, {COMMENT_SQL % 'line'} AS is_comment FROM transcripts")
def is_comment_line(spark, sf_dir):
    lines = inputs.transcripts(spark, sf_dir)
    return lines.select("line_no", text.is_comment_line("line").alias("is_comment"))


@query("strip_prompt",
       f"WITH {TRANSCRIPTS_SQL} SELECT line_no, {PROMPT_SQL % 'line'} AS command FROM transcripts")
def strip_prompt(spark, sf_dir):
    lines = inputs.transcripts(spark, sf_dir)
    return lines.select("line_no", text.strip_prompt("line").alias("command"))


@query("collapse_command",
       f"WITH {TRANSCRIPTS_SQL} SELECT line_no, {WORDS_SQL % 'line'} AS command FROM transcripts")
def collapse_command(spark, sf_dir):
    lines = inputs.transcripts(spark, sf_dir)
    return lines.select("line_no", text.collapse_command("line").alias("command"))


@query("slugify", f"""SELECT doc_id, coalesce(nullif(trim(regexp_replace(lower(
  {STRIP_SQL % "' !' || text"}), '[^\\p{{L}}\\p{{N}}_-]', '-', 'g'), '-'), ''),
  'commands') AS slug FROM documents""")
def slugify(spark, sf_dir):
    name = F.concat(F.lit(" !"), "text")
    documents = inputs.table(spark, sf_dir, "documents")
    return documents.select("doc_id", text.slugify(name).alias("slug"))


# --- paths -----------------------------------------------------------------------------------
@query("detect_language", f"""WITH {FILES_SQL},
  tagged AS (SELECT doc_id, relative_path, {EXT_SQL} AS ext FROM files)
  SELECT doc_id, {LANGUAGE_SQL} AS language FROM tagged""")
def detect_language(spark, sf_dir):
    files = inputs.files(spark, sf_dir)
    return files.select("doc_id", paths.detect_language("relative_path").alias("language"))


@query("language_lookup", f"""WITH {FILES_SQL},
  tagged AS (SELECT relative_path, {EXT_SQL} AS ext FROM files)
  SELECT ext, {LANGUAGE_SQL} AS language, count(*) AS files FROM tagged GROUP BY ALL""")
def language_lookup(spark, sf_dir):
    return (
        inputs.files(spark, sf_dir)
        .select(
            paths.extension("relative_path").alias("ext"),
            paths.detect_language("relative_path").alias("language"),
        )
        .groupBy("ext", "language")
        .agg(F.count(F.lit(1)).alias("files"))
    )


@query("relative_path", f"""WITH {FILES_SQL}
  SELECT doc_id, replace('/data/' || source_name || '/' || relative_path,
                         '/data/' || source_name || '/', '') AS relative_path FROM files""")
def relative_path(spark, sf_dir):
    root = F.concat(F.lit("/data/"), "source_name", F.lit("/"))
    return (
        inputs.files(spark, sf_dir)
        .select("doc_id", root.alias("root"), F.concat(root, "relative_path").alias("path"))
        .select("doc_id", paths.relative_path("path", "root").alias("relative_path"))
    )

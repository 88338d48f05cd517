"""Inputs derived from the test tables, in Spark and as SQL for the check.

The tables hold no file tree and no shell history. Both sides derive them with the
same expressions, so that their size follows the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F



def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- files: one per document -------------------------------------------------------
_PATH = """'src/' || CASE doc_id % 7 WHEN 0 THEN 'vendor/' WHEN 1 THEN 'build/x/' ELSE 'lib/' END
 || 'f' || doc_id || CASE CAST(floor(doc_id / 20) AS BIGINT) % 10
   WHEN 0 THEN '.py' WHEN 1 THEN '.JS' WHEN 2 THEN '.md' WHEN 3 THEN '' WHEN 4 THEN '.go'
   WHEN 5 THEN '.sh' WHEN 6 THEN '.txt' WHEN 7 THEN '.png' WHEN 8 THEN '.tar.gz' ELSE '.h' END"""

FILES_SQL = f"""files AS (
  SELECT CAST(substr(source, 4) AS INTEGER) AS source_ord, source AS source_name,
         {_PATH} AS relative_path, text, CAST(strlen(text) AS BIGINT) AS size, doc_id
  FROM documents)"""


def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        F.expr("CAST(substr(source, 4) AS INT)").alias("source_ord"),
        F.col("source").alias("source_name"),
        F.expr(_PATH).alias("relative_path"),
        "text",
        F.octet_length("text").cast("bigint").alias("size"),
        "doc_id",
    )


# --- messy text: tabs, carriage returns, blank lines and double spaces ---------------
MESSY_SQL = """messy AS (
  SELECT doc_id, replace(replace(replace(text, ', ', ',' || chr(9)),
    '.' || chr(10), '.' || chr(13) || chr(10) || chr(10) || chr(10) || chr(10)),
    ' the ', '  the ') AS content
  FROM documents)"""


def messy(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("text")
    for old, new in ((", ", ",\t"), (".\n", ".\r\n\n\n\n"), (" the ", "  the ")):
        text = F.replace(text, F.lit(old), F.lit(new))
    documents = table(spark, sf_dir, "documents")
    return documents.select("doc_id", text.alias("content"))


# --- sources: those of the documents, every third one with a language focus ----------
SOURCES_SQL = """sources AS (
  SELECT DISTINCT CAST(substr(source, 4) AS INTEGER) AS source_ord, source AS name,
         'code' AS kind, 'local' AS origin, '/data/' || source AS path,
         CASE WHEN CAST(substr(source, 4) AS INTEGER) % 3 = 0
              THEN ['python', 'go', 'markdown'] ELSE CAST([] AS VARCHAR[]) END AS languages
  FROM documents)"""


def sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    focus = F.array(F.lit("python"), F.lit("go"), F.lit("markdown"))
    ord_ = F.col("source_ord")
    return (
        table(spark, sf_dir, "documents")
        .select("source").distinct()
        .select(F.expr("CAST(substr(source, 4) AS INT)").alias("source_ord"), "source")
        .select(
            ord_,
            F.col("source").alias("name"),
            F.lit("code").alias("kind"),
            F.lit("local").alias("origin"),
            F.concat(F.lit("/data/"), "source").alias("path"),
            F.when(ord_ % 3 == 0, focus).otherwise(F.array().cast("array<string>")).alias("languages"),
        )
    )


# --- transcripts: one line per event, one file per user, three sources ---------------
_LINE = """CASE event_id % 10
   WHEN 0 THEN '$ ' || event_type || ' --user ' || user_id
   WHEN 1 THEN '# ' || event_type
   WHEN 2 THEN 'PS C:' || chr(92) || '> ' || event_type || '  -v'
   WHEN 3 THEN '> ' || event_type
   WHEN 4 THEN 'bash'
   WHEN 5 THEN '   '
   WHEN 6 THEN 'REM ' || event_type
   WHEN 7 THEN 'C:' || chr(92) || 'tools> run ' || (user_id % 20)
   WHEN 8 THEN '$  # note ' || event_type
   ELSE event_type || chr(9) || (event_id % 50) END"""

TRANSCRIPTS_SQL = f"""transcripts AS (
  SELECT CAST(user_id % 3 AS INTEGER) AS source_ord, CAST(user_id AS VARCHAR) AS path,
         event_id AS line_no, {_LINE} AS line
  FROM events)"""


def transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.expr("CAST(user_id % 3 AS INT)").alias("source_ord"),
        F.expr("CAST(user_id AS STRING)").alias("path"),
        F.col("event_id").alias("line_no"),
        F.expr(_LINE).alias("line"),
    )


# --- repositories: one per customer, with some of these paths ------------------------
_REPO_PATHS = (
    ("go.mod", 2), ("Jenkinsfile", 3), (".github/workflows/a/ci.yml", 4),
    (".github/workflows/x.yaml", 1), ("sub/go.mod", 1), ("package.json", 5),
    (".gitlab-ci.yml", 6), ("src/a.py", 1),
)

REPO_PATHS_SQL = f"""listed AS (
  SELECT CAST(c_custkey AS INTEGER) AS source_ord, unnest([{
    ", ".join(f"CASE WHEN c_custkey % {k} = 0 AND c_custkey % 10 <> 9 THEN '{p}' END"
              for p, k in _REPO_PATHS)}]) AS relative_path
  FROM customer),
repo_paths AS (SELECT * FROM listed WHERE relative_path IS NOT NULL)"""


def repo_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    names = F.array_compact(
        F.array(*[F.when((key % k == 0) & (key % 10 != 9), F.lit(p)) for p, k in _REPO_PATHS])
    )
    return table(spark, sf_dir, "customer").select(
        key.cast("int").alias("source_ord"),
        F.explode(names).alias("relative_path"),
        F.lit(False).alias("is_dir"),
    )


REPOS_SQL = """repos AS (
  SELECT CAST(c_custkey AS INTEGER) AS source_ord, c_name AS name, 'code' AS kind,
         'local' AS origin, '/repos/' || c_custkey AS path
  FROM customer)"""


def repos(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("int").alias("source_ord"),
        F.col("c_name").alias("name"),
        F.lit("code").alias("kind"),
        F.lit("local").alias("origin"),
        F.concat(F.lit("/repos/"), F.col("c_custkey").cast("string")).alias("path"),
    )

"""Queries of the package over the test tables, with their SQL checks where SQL can say it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from millrace.llm.byte_bpe import Vocabulary, decode_texts, encode_texts
from millrace.llm.common import held_out
from millrace.llm.fill_middle import fill_in_middle, restore
from millrace.llm.language_cnn import identify_language, train_language_network
from millrace.llm.line_frequency import line_frequency_rules
from millrace.llm.mixing import Mix, mixing_plan
from millrace.llm.norm_search import ranked_search
from millrace.llm.packing import DOCUMENTS, pack_texts
from millrace.llm.quality_neighbours import fit_neighbours, score_quality
from millrace.llm.simhash import simhash_components
from millrace.llm.token_cache import cached_token_counts
from millrace.llm.token_records import read_records, write_records
from millrace.llm.warc import URN, read_warc, whole_records, write_warc
from millrace.llm.weighted_sampling import weighted_fingerprints
from millrace.staging import new_path

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
RANKS = Vocabulary(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
OVER_TOKENS = 512

QUERIES: dict = {}
CHECKS: dict[str, str] = {}


def query(name: str, check: str | None = None):
    def register(function):
        QUERIES[name] = function
        if check is not None:
            CHECKS[name] = check
        return function

    return register


def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"
LINE_FREQUENCY_SQL = rf"""
WITH docs AS (SELECT doc_id, source, coalesce(text, '') AS text,
    {WORDS.format("coalesce(text, '')")} AS w FROM documents),
lines AS (SELECT doc_id, source, line, {WORDS.format('line')} AS lw
  FROM (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line FROM docs)
  WHERE len({WORDS.format('line')}) > 0),
named AS (SELECT doc_id, source, line, len(lw) AS n, lower(array_to_string(lw, ' ')) AS norm FROM lines),
hosts AS (SELECT source, count(DISTINCT doc_id) AS total FROM docs GROUP BY source),
frequent AS (SELECT source, norm FROM (
    SELECT source, norm, count(DISTINCT doc_id) AS c FROM named GROUP BY source, norm)
  JOIN hosts USING (source) WHERE c > 5 AND c > least(total * 0.01, 100)),
gone AS (SELECT doc_id, CAST(sum(n) AS BIGINT) AS removed FROM named
  SEMI JOIN frequent USING (source, norm) GROUP BY doc_id),
dups AS (SELECT doc_id, CAST(count(*) - count(DISTINCT line) AS BIGINT) AS d FROM named GROUP BY doc_id),
windows AS (SELECT doc_id, i, array_to_string(w[i:i+4], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM docs WHERE len(w) >= 5)),
repeated AS (SELECT doc_id, i FROM (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM windows) WHERE c > 1),
covered AS (SELECT doc_id, count(DISTINCT p) AS r FROM (
  SELECT doc_id, unnest(range(i, i + 5)) AS p FROM repeated) GROUP BY doc_id),
counts AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
    CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(coalesce(d, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(r, 0) AS BIGINT) AS n_repeat_words,
    CAST(coalesce(removed, 0) AS BIGINT) AS removed_words
  FROM docs LEFT JOIN dups USING (doc_id) LEFT JOIN covered USING (doc_id) LEFT JOIN gone USING (doc_id))
SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
  NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words)
  AND n_words - removed_words >= 10 AND n_words - removed_words >= n_words * 0.5 AS kept FROM counts"""


@query("op1_line_frequency", LINE_FREQUENCY_SQL)
def op1_line_frequency(spark, sf_dir):
    return line_frequency_rules(documents(spark, sf_dir))


@query("op9_weighted_sampling")
def op9_weighted_sampling(spark, sf_dir):
    return weighted_fingerprints(documents(spark, sf_dir))


@query("op3_token_counts")
def op3_token_counts(spark, sf_dir):
    """Each call starts with an empty cache, so that every distinct text is encoded."""
    counts = cached_token_counts(
        documents(spark, sf_dir), TOKENIZER, new_path(spark, "token-counts")
    )
    return counts.withColumn("over_limit", F.col("n_tokens") > OVER_TOKENS)


@query("op5_token_records")
def op5_token_records(spark, sf_dir):
    files = write_records(documents(spark, sf_dir), new_path(spark, "records"), TOKENIZER)
    return read_records(files).select(
        "doc_id", "start", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )


@query("op10_packing")
def op10_packing(spark, sf_dir):
    return pack_texts(documents(spark, sf_dir), TOKENIZER, DOCUMENTS).withColumn(
        "ids_crc32", F.crc32("ids")
    ).drop("ids")


@query("op2_mixing")
def op2_mixing(spark, sf_dir):
    return mixing_plan(documents(spark, sf_dir), Mix(repetition=2.0)).drop("row_key")


WARC_SQL = """
WITH whole AS (SELECT page_id, sha256(coalesce(html, '')) AS digest,
    CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS n FROM pages),
firsts AS (SELECT digest, min(page_id) AS first FROM whole WHERE n >= 100 GROUP BY digest)
SELECT page_id, n AS payload_bytes, digest AS payload_digest,
  CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN first <> page_id THEN first END AS refers_to FROM whole LEFT JOIN firsts USING (digest)"""


@query("op4_warc", WARC_SQL)
def op4_warc(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    records = whole_records(read_warc(write_warc(pages, new_path(spark, "warc"))))

    def page(column):  # a page without an id is written as the smallest integer
        number = F.regexp_extract(column, f"^{URN}(-?[0-9]+)$", 1).cast("bigint")
        return F.nullif(number, F.lit(-(1 << 63)).cast("bigint"))

    return records.select(
        page("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        page("refers_to").alias("refers_to"),
    )


@query("op6_simhash")
def op6_simhash(spark, sf_dir):
    return simhash_components(documents(spark, sf_dir))


@query("op7_language")
def op7_language(spark, sf_dir):
    docs = documents(spark, sf_dir)
    return identify_language(docs, train_language_network(docs)).withColumn(
        "held_out", held_out(F.col("doc_id"))
    )


@query("op8_quality")
def op8_quality(spark, sf_dir):
    docs = documents(spark, sf_dir)
    model = fit_neighbours(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score_quality(docs, model).withColumn("held_out", held_out(F.col("doc_id")))


FILL_MIDDLE_SQL = """
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text,
    sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS digest FROM documents),
units AS (SELECT doc_id, text, regexp_extract_all(text, '[A-Za-z]+|[^A-Za-z]') AS u,
    [CAST('0x' || substr(digest, k, 8) AS BIGINT) for k in [1, 9, 17, 25]] AS h FROM docs),
cuts AS (SELECT doc_id, text, u, h, CAST(len(u) AS BIGINT) AS n,
    least(h[1] % (len(u) + 1), h[2] % (len(u) + 1)) AS a,
    greatest(h[1] % (len(u) + 1), h[2] % (len(u) + 1)) AS b,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
      OR h[3] % 100 >= 90 THEN 'plain' WHEN h[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM units),
parts AS (SELECT doc_id, text, n, form, array_to_string(u[1:a], '') AS prefix,
    array_to_string(u[a + 1:b], '') AS middle, array_to_string(u[b + 1:], '') AS suffix FROM cuts)
SELECT doc_id, n, form,
  CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text
    WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(text) AS restored_sha256 FROM parts"""


@query("op11_fill_middle", FILL_MIDDLE_SQL)
def op11_fill_middle(spark, sf_dir):
    made = fill_in_middle(documents(spark, sf_dir))
    restored = restore(F.col("output"), F.col("form"))
    return made.withColumn("output_sha256", F.sha2("output", 256)).withColumn(
        "restored_sha256", F.sha2(restored, 256)).drop("output")


@query("op12_byte_bpe")
def op12_byte_bpe(spark, sf_dir):
    coded = decode_texts(encode_texts(documents(spark, sf_dir), RANKS), RANKS)
    return coded.select(
        "doc_id", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )


TERMS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""
NORM_SEARCH_SQL = rf"""
WITH docs AS (SELECT doc_id, {TERMS} AS t FROM documents),
sums AS (SELECT CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(len(t)) AS BIGINT) AS n_terms
  FROM docs WHERE len(t) > 0),
wanted AS (SELECT item_id, unnest(list_distinct({TERMS})) AS term FROM benchmark),
counts AS (SELECT doc_id, n, term, count(*) AS tf FROM (
    SELECT doc_id, len(t) AS n, unnest(t) AS term FROM docs)
  SEMI JOIN wanted USING (term) GROUP BY doc_id, n, term),
weights AS (SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM counts, sums GROUP BY term, n_docs),
impacts AS (SELECT doc_id, term, CAST(w AS BIGINT) * ((1000000000 * tf) //
    (1000 * tf + 20 * (50 + (50 * n * n_docs) // n_terms))) AS impact
  FROM counts JOIN weights USING (term), sums),
scores AS (SELECT item_id, doc_id, CAST(sum(impact) AS BIGINT) AS score
  FROM wanted JOIN impacts USING (term) GROUP BY item_id, doc_id)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank
  FROM scores WHERE score > 0) WHERE rank <= 50"""


@query("op13_norm_search", NORM_SEARCH_SQL)
def op13_norm_search(spark, sf_dir):
    return ranked_search(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))

"""Quality rules by cross-document line frequency. DataFrame functions only.

Lines are normalised (words joined by one space, lower case) and hashed. A line that more
documents of its host hold than a limit allows is boilerplate and counts as removed. A document
that loses too many of its words this way is depleted and rejected, as is one that fails the base
rules (too few words, or too many words in repeated five-word windows).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm.common import split_words
from millrace.operators.joins import sized_join

WINDOW = 5
SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class LineRules:
    """Limits. A line goes if over ``max(min_documents, min(max_documents, host_share * documents of the
    host))`` documents of its host hold it: in a large host the count decides, not the share."""

    min_documents: int = 5
    host_share: float = 0.01
    min_words: int = 10
    max_repeat_percent: int = 20
    min_left_words: int = 10
    min_left_share: float = 0.5
    max_documents: int = 100


def word_lines(text: Column) -> Column:
    """The ``\\n``-split lines that hold a word, as arrays of words."""
    lines = F.split(F.coalesce(text, F.lit("")), "\n", -1)
    return F.filter(F.transform(lines, split_words), lambda words: F.size(words) > 0)


def line_hash(words: Column) -> Column:
    return F.xxhash64(F.lower(F.array_join(words, " ")))


def line_hashes(lines: Column) -> Column:
    return F.transform(lines, line_hash)


def symbol_count(text: Column) -> Column:
    """Each symbol is one byte, so the bytes that replacing removes are the symbols."""
    rest = text
    for symbol in SYMBOLS:
        rest = F.replace(rest, F.lit(symbol), F.lit(""))
    return (F.octet_length(text) - F.octet_length(rest)).cast("bigint")


def duplicate_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line of the same text, code point by code point."""
    lines = F.filter(
        F.split(text, "\n", -1), lambda line: F.btrim(line, F.lit(" \t\n\x0b\x0c\r")) != ""
    )
    return (F.size(lines) - F.size(F.array_distinct(lines))).cast("bigint")


def with_repeat_words(df: DataFrame, words: str, name: str) -> DataFrame:
    """Count the words that lie in a five-word window found twice or more in their text.

    Windows are compared by hash. Texts in which all windows differ end there. In the others
    windows are sorted by (hash, place): equal ones become neighbours, and the covered words
    follow from the gaps between the places of repeated windows, in n log n steps for any text.
    """
    w, h, s, p = (F.col(c) for c in ("_word_hash", "_windows", "_sorted", "_places"))
    size = F.size(words)
    none = F.array().cast("array<bigint>")
    df = df.withColumn("_word_hash", F.transform(words, lambda word: F.xxhash64(word)))
    df = df.withColumn("_windows", F.when(size >= WINDOW, F.transform(
        F.sequence(F.lit(0), size - WINDOW),
        lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(WINDOW)]),
    )).otherwise(none))
    df = df.withColumn("_sorted", F.when(
        F.size(F.array_distinct(h)) < F.size(h),
        F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))),
    ))

    def repeated(e: Column, i: Column) -> Column:
        near = [F.get(s, i + d)["h"] == e["h"] for d in (-1, 1)]
        return F.coalesce(near[0], F.lit(False)) | F.coalesce(near[1], F.lit(False))

    df = df.withColumn(
        "_places", F.sort_array(F.transform(F.filter(s, repeated), lambda e: e["i"]))
    )
    gaps = F.transform(p, lambda x, j: F.least(F.lit(WINDOW), F.coalesce(
        F.get(p, j + 1) - x, F.lit(WINDOW))))
    total = F.aggregate(gaps, F.lit(0).cast("bigint"), lambda a, x: a + x)
    return df.withColumn(name, F.coalesce(total, F.lit(0).cast("bigint"))).drop(
        "_word_hash", "_windows", "_sorted", "_places"
    )


def base_metrics(docs: DataFrame, text: str, keep: list[Column]) -> DataFrame:
    """Counts of each whole text, beside its lines as (raw line, hash) structs in ``_lines``; lines
    without a word have no hash, and a null text has no lines."""
    whole = F.coalesce(F.col(text), F.lit(""))
    df = docs.select(
        *keep, F.split(F.col(text), "\n", -1).alias("_raw_lines"),
        F.transform(F.split(whole, "\n", -1), split_words).alias("_word_lines"),
        symbol_count(whole).alias("n_symbols"), duplicate_lines(whole).alias("n_dup_lines"),
    )
    df = df.withColumn("_words", F.flatten("_word_lines"))
    df = with_repeat_words(df, "_words", "n_repeat_words")
    return df.select(
        *[c for c in df.columns if c not in ("_words", "_word_lines", "_raw_lines")],
        F.size("_words").cast("bigint").alias("n_words"),
        F.char_length(F.array_join("_words", "")).cast("bigint").alias("word_chars"),
        F.zip_with("_raw_lines", "_word_lines", lambda raw, words: F.struct(
            raw.alias("raw"), F.when(F.size(words) > 0, line_hash(words)).alias("h"),
        )).alias("_lines"),
    )


def frequent_lines(
    docs: DataFrame, rules: LineRules, *, text: str, doc_id: str, host: str
) -> DataFrame:
    """Host and hash of the lines that too many distinct documents of the host hold.

    Lines are made distinct within a document before the shuffle; a document id counts once
    however many rows carry it. The pairs (line, document) are dealt by all three columns, so a
    line that a third of all documents hold is spread over all tasks.
    """
    lines = docs.select(
        F.col(host).alias("_host"), F.col(doc_id).alias("_doc"),
        F.explode(F.array_distinct(line_hashes(word_lines(F.col(text))))).alias("_hash"),
    )
    counts = (
        lines.distinct().groupBy("_host", "_hash").agg(F.count(F.lit(1)).alias("_documents"))
        .filter(F.col("_documents") > rules.min_documents)
    )
    hosts = (
        docs.select(F.col(host).alias("_of"), F.col(doc_id).alias("_doc")).distinct()
        .groupBy("_of").agg(F.count(F.lit(1)).alias("_host_documents"))
    )
    return (
        counts.join(hosts, F.col("_host").eqNullSafe(F.col("_of")))
        .filter(F.col("_documents") > F.least(
            F.col("_host_documents") * rules.host_share, F.lit(float(rules.max_documents))))
        .select(F.coalesce("_host", F.lit("")).alias("_host"),
                F.col("_host").isNull().alias("_no_host"), "_hash")
    )


def remove_frequent_lines(
    docs: DataFrame, rules: LineRules = LineRules(), *, text: str = "text",
    doc_id: str = "doc_id", host: str = "source", limit: int | None = None,
) -> DataFrame:
    """One row per row of ``docs``: its id, ``text`` without the frequent lines, and the counts of the
    whole text.

    Lines go through the join with their number and are put together in order; the others, blank
    ones too, stay as they are. A null text stays null. ``limit`` is the row bound for a
    broadcast of the frequent lines, whose size is measured.
    """
    frequent = frequent_lines(docs, rules, text=text, doc_id=doc_id, host=host)
    base = base_metrics(docs, text, [
        F.col(doc_id).alias("doc_id"), F.coalesce(F.col(host), F.lit("")).alias("_host"),
        F.col(host).isNull().alias("_no_host"), F.monotonically_increasing_id().alias("_row"),
    ])
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    lines = base.select(
        "_row", "doc_id", "_host", "_no_host", *counts, F.posexplode_outer("_lines").alias("_at", "_line")
    ).select(
        "*", F.col("_line.h").alias("_hash"), F.col("_line.raw").alias("_raw")
    ).drop("_line")
    flagged = sized_join(
        lines, frequent.withColumn("_gone", F.lit(True)), ["_host", "_no_host", "_hash"], "left",
        limit=limit,
    )
    left = F.when(F.col("_gone").isNull() & F.col("_raw").isNotNull(), F.struct("_at", "_raw"))
    held = flagged.groupBy("_row").agg(
        *[F.first(c).alias(c) for c in ("doc_id", *counts)],
        F.count("_raw").alias("_all"), F.collect_list(left).alias("_left"),
    )
    whole = F.array_join(F.sort_array("_left")["_raw"], "\n")
    return held.select("doc_id", F.when(F.col("_all") > 0, whole).alias("text"), *counts)


def line_frequency_rules(
    docs: DataFrame, rules: LineRules = LineRules(), *, text: str = "text",
    doc_id: str = "doc_id", host: str = "source", limit: int | None = None,
) -> DataFrame:
    """One row per row of ``docs``: its id, the counts, ``removed_words`` and the verdicts, from the
    texts that ``remove_frequent_lines`` leaves.

    Null or blank texts have no words and fail the base rules. Rows without a host form a host of
    their own. Rows with the same id are judged one by one, and count as one document in the
    line counts. An empty table gives an empty one; other columns are not read.
    """
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    words_left = F.coalesce(F.size(split_words(F.col("text"))), F.lit(0)).cast("bigint")
    judged = remove_frequent_lines(
        docs, rules, text=text, doc_id=doc_id, host=host, limit=limit
    ).select("doc_id", *counts, F.when(F.col("text").isNull(), 0).otherwise(words_left).alias("_words_left"))
    n, left = F.col("n_words"), F.col("_words_left")
    failed = (n < rules.min_words) | (
        100 * F.col("n_repeat_words") > rules.max_repeat_percent * n
    )
    depleted = (left < rules.min_left_words) | (left < n * rules.min_left_share)
    return judged.select(
        "doc_id", *counts, (n - left).alias("removed_words"), failed.alias("base_failed"),
        (~failed & ~depleted).alias("kept"),
    )

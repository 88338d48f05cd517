"""Row filters on file records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from millrace.config import IngestionOptions, QualityOptions
from millrace.functions import paths, text
from millrace.operators import extensions
from millrace.operators.joins import BROADCAST_ROWS, fits_broadcast, sized_join
from millrace.staging import stage


def filter_extension(files: DataFrame, allowed: Sequence[str]) -> DataFrame:
    return files.filter(paths.allowed_extension("relative_path", allowed))


def filter_dirs(files: DataFrame, excluded: Sequence[str]) -> DataFrame:
    return files.filter(~paths.inside_directory("relative_path", excluded))


def filter_size(files: DataFrame, max_bytes: int) -> DataFrame:
    return files.filter(F.col("size") <= F.lit(max_bytes))


def filter_binary(files: DataFrame) -> DataFrame:
    return files.filter(~text.is_binary("raw"))


def ingestible(files: DataFrame, options: IngestionOptions) -> DataFrame:
    """Rules that need no file content; run them before any byte is read."""
    return (
        files.transform(filter_dirs, options.exclude_dirs)
        .transform(filter_extension, options.include_extensions)
        .transform(extensions.exclude_extensions, options.exclude_extensions)
        .transform(extensions.exclude_globs, options.exclude_globs)
        .transform(filter_size, options.max_bytes)
    )


def with_source_attributes(
    records: DataFrame, sources: DataFrame, rows: int | None = None
) -> DataFrame:
    """Add the attributes of its source to each record."""
    return sized_join(records, sources, ["source_ord"], rows=rows)


def in_focus(languages: Column, language: Column) -> Column:
    """True when the focus list is empty or holds the language."""
    return (F.size(languages) == 0) | F.array_contains(languages, language)


_WORD_BITS = 64


def focus_words(sources: DataFrame) -> DataFrame:
    """Languages in focus as bits: ``language, word, bits``, a bit for each source of a block of 64.

    Sources without a list have their bits under a null language. A null list has none.
    """
    every = F.when(F.size("languages") == 0, F.array(F.lit(None).cast("string")))
    listed = F.array_compact("languages")
    number = F.col("source_ord").cast("bigint")
    return (
        sources.select(number.alias("_number"), F.explode(F.coalesce(every, listed)).alias("language"))
        .groupBy("language", F.shiftright("_number", 6).alias("word"))
        .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"),
                                      F.pmod("_number", F.lit(_WORD_BITS)).cast("int"))).alias("bits"))
    )


def with_focus(
    records: DataFrame, sources: DataFrame, rows: int | None = None, limit: int | None = None
) -> DataFrame:
    """Records with ``_in_focus``: whether their source takes their language, false for unknown sources.

    The text stays where it is while the sources fit a broadcast. Beyond that their bits are looked up,
    64 sources in a row, which keeps it in place for tens of times as many sources. ``rows`` is the number
    of sources where the caller knows it.
    """
    focus = sources.select("source_ord", F.col("languages").alias("_languages"))
    if rows is None:
        focus = stage(focus, "focus")
        fits = fits_broadcast(focus, limit)
    else:
        fits = rows <= (BROADCAST_ROWS if limit is None else limit)
    if fits:
        inside = in_focus(F.col("_languages"), F.col("language"))
        marked = records.join(F.broadcast(focus), "source_ord", "left")
        return marked.select(*records.columns, F.coalesce(inside, F.lit(False)).alias("_in_focus"))
    words = stage(focus_words(focus.withColumnRenamed("_languages", "languages")), "focus-words")
    every = words.filter(F.col("language").isNull()).select(
        F.col("word").alias("_word"), F.col("bits").alias("_every"))
    some = words.filter(F.col("language").isNotNull()).select(
        "language", F.col("word").alias("_word"), F.col("bits").alias("_some"))
    number = F.col("source_ord").cast("bigint")
    marked = records.withColumn("_word", F.shiftright(number, 6))
    marked = sized_join(sized_join(marked, every, ["_word"], "left"), some, ["language", "_word"], "left")
    place = F.pmod(number, F.lit(_WORD_BITS)).cast("int")
    bits = F.coalesce("_every", F.lit(0).cast("bigint")).bitwiseOR(F.coalesce("_some", F.lit(0).cast("bigint")))
    inside = F.coalesce(F.getbit(bits, place) == 1, F.lit(False))
    return marked.select(*records.columns, inside.alias("_in_focus"))


def filter_source_language(
    records: DataFrame, sources: DataFrame, rows: int | None = None, *, limit: int | None = None
) -> DataFrame:
    """Drop records outside the language focus of their source."""
    return with_focus(records, sources, rows, limit).filter("_in_focus").select(*records.columns)


def passes_gates(content: Column, options: QualityOptions) -> Column:
    """Inclusive bounds on code points and lines of normalised text, and no forbidden pattern in it."""
    passed = F.lit(True)
    for value, low, high in (
        (F.length(content), options.min_characters, options.max_characters),
        (text.line_count(content), options.min_lines, options.max_lines),
    ):
        if low > 0:
            passed &= value >= low
        if high is not None:
            passed &= value <= high
    if options.forbidden_patterns:
        passed &= ~extensions.holds_forbidden(content, options.forbidden_patterns)
    return passed


def quality_gates(records: DataFrame, options: QualityOptions) -> DataFrame:
    return records.filter(passes_gates(F.col("content"), options))

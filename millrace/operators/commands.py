"""Shell commands mined from lines of text.

A line table has ``source_ord``, ``path``, ``line_no`` and ``line``. The corpus of a
source stays a table; it becomes one text when that text is within the size cap, and
several texts when it is not.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from millrace.config import ChunkOptions, CommandSource, IngestionOptions
from millrace.functions import paths, text
from millrace.operators.chunking import windows_of_line
from millrace.operators.dedup import distinct_first
from millrace.operators.joins import sized_join
from millrace.operators.positions import first_n, with_positions, with_totals_before
from millrace.staging import stage

ORDER = ("path", "line_no")


def is_candidate(line: Column) -> Column:
    """Stripped lines that are neither blank nor a comment."""
    return (line != "") & ~text.is_comment_line(line)


def is_command(command: Column, shells: Column | Sequence[str]) -> Column:
    """Cleaned lines that are not blank and not the bare name of a shell."""
    lowered = F.lower(command)
    if isinstance(shells, Column):
        bare = F.coalesce(F.array_contains(shells, lowered), F.lit(False))
    else:
        bare = lowered.isin(*[s.lower() for s in shells]) if shells else F.lit(False)
    return (command != "") & ~bare


def _with_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column that later filters read but do not compute again: a filter is not
    pushed through a generator whose output it uses."""
    others = [c for c in df.columns if c != name]
    return df.select(*others, F.explode(F.array(value)).alias(name))


def command_lines(lines: DataFrame, shells: Column | Sequence[str]) -> DataFrame:
    """Lines that are commands, with the cleaned ``command`` in place of ``line``."""
    stripped = _with_once(lines, "line", text.strip_text("line"))
    candidates = stripped.filter(is_candidate(F.col("line")))
    cleaned = _with_once(candidates, "command", text.collapse_command(text.strip_prompt("line")))
    return cleaned.drop("line").filter(is_command(F.col("command"), shells))


def extract_commands(
    lines: DataFrame, shells: Column | Sequence[str], max_lines: int | None = None
) -> DataFrame:
    """Distinct commands of each file at their first line, at most ``max_lines`` of them."""
    file = ("source_ord", "path")
    found = command_lines(lines, shells).select(*file, "line_no", "command")
    first = distinct_first(found, (*file, "command"), ("line_no",))
    return first if max_lines is None else first_n(first, file, ("line_no",), max_lines)


def command_corpus(lines: DataFrame, shells: Column | Sequence[str]) -> DataFrame:
    """Distinct commands of each source at their first file and line.

    The key is source and command, with a partial aggregate before the shuffle; a
    source with a third of all lines is spread over its commands.
    """
    found = command_lines(lines, shells).select("source_ord", "command", *ORDER)
    return distinct_first(found, ("source_ord", "command"), ORDER)


def command_cap(corpus: DataFrame, caps: Mapping[int, int | None] | int | None) -> DataFrame:
    """First ``max_lines`` commands of each source; one cap, or one per ``source_ord``."""
    if caps is None or isinstance(caps, int):
        return corpus if caps is None else first_n(corpus, ("source_ord",), ORDER, caps)
    limits = {source_ord: cap for source_ord, cap in caps.items() if cap is not None}
    if not limits:
        return corpus
    # Written once: the capped and the uncapped sources are two readers.
    corpus = stage(corpus, "uncapped-corpus")
    pairs = [F.lit(x) for pair in limits.items() for x in pair]
    cap = F.try_element_at(F.create_map(*pairs), F.col("source_ord"))
    capped = corpus.filter(cap.isNotNull())
    return corpus.filter(cap.isNull()).unionByName(
        first_n(capped, ("source_ord",), ORDER, max(limits.values()), cap=cap)
    )


def corpus_records(
    corpus: DataFrame, max_bytes: int, windows: ChunkOptions | None = None
) -> DataFrame:
    """Corpus of each source as texts of at most ``max_bytes``, numbered by ``part``.

    Sizes are summed first, so that only bounded groups are collected. A corpus within the cap is
    one text, part 0. A larger one is cut, in its order, where half the cap is reached: nothing
    is lost. Only a single command of over half the cap can make a part larger than the cap.

    With ``windows`` a part starts where a window of the whole corpus starts, and the commands
    that its last window needs follow it. The windows of all parts together are then those of the
    whole corpus, each once. A part grows by these commands and by those up to the next start.
    """
    corpus = stage(corpus, "command-corpus")
    length = F.octet_length("command").cast("bigint")
    sizes = corpus.groupBy("source_ord").agg((F.sum(length) + F.count(F.lit(1)) - 1).alias("size"))
    sizes = stage(sizes, "corpus-sizes")
    within, beyond = F.col("size") <= F.lit(max_bytes), F.col("size") > F.lit(max_bytes)
    zero = F.lit(0).cast("bigint")
    cut = sized_join(corpus, sizes.filter(within).select("source_ord"), ["source_ord"]).select(
        "source_ord", zero.alias("part"), zero.alias("position"), *ORDER, "command")
    oversize = sizes.filter(beyond).select("source_ord")
    if not oversize.isEmpty():
        large = sized_join(corpus, oversize, ["source_ord"]).withColumn("_bytes", length + 1)
        cut = cut.unionByName(
            _parts(large, max(1, max_bytes // 2), windows).select(*cut.columns))
    held = F.sort_array(F.collect_list(F.struct(*ORDER, "command")))
    texts = (
        cut.groupBy("source_ord", "part")
        .agg((F.sum(length) + F.count(F.lit(1)) - 1).alias("size"),
             F.min("position").alias("first_line"), held.alias("_held"))
        .select(
            "source_ord", "part", "size", F.array_join(F.col("_held.command"), "\n").alias("text"),
            "first_line",
        )
    )
    return texts if windows else texts.drop("first_line")


def _parts(large: DataFrame, part_bytes: int, windows: ChunkOptions | None) -> DataFrame:
    """Part of each command; with ``windows`` a row for each part that a command is in."""
    cut = F.floor(F.col("before") / F.lit(part_bytes)).cast("bigint").alias("part")
    group = ["source_ord"]
    if windows is None:
        placed = with_totals_before(large, group, ORDER, "_bytes")
        return placed.select("*", F.lit(0).cast("bigint").alias("position"), cut)
    placed = with_totals_before(with_positions(large, group, ORDER), group, ORDER, "_bytes")
    lowest, highest = windows_of_line(F.col("position"), F.col("group_size"), windows)
    placed = stage(placed.withColumns({"_lowest": lowest, "_highest": highest}), "placed-commands")
    parts = placed.groupBy(*group, F.col("_highest").alias("_window")).agg(
        F.min("before").alias("before")).select(*group, "_window", cut)
    held = placed.withColumn("_window", F.explode(F.sequence("_lowest", "_highest")))
    return sized_join(held, parts, [*group, "_window"]).dropDuplicates([*group, "part", "position"])


def command_source_records(
    corpora: DataFrame, sources: DataFrame, options: IngestionOptions, rows: int | None = None
) -> DataFrame:
    """Corpus texts as raw records named ``<slug>.terminal``, later parts ``<slug>-2.terminal`` and
    so on, under the ingestion rules.

    ``sources`` has ``source_ord`` and ``name``. The record belongs to the source
    ``<name>-commands``. The size cap has cut the corpora already; a part that a long command makes
    larger than the cap stays, so no command is lost.
    """
    named = sized_join(corpora, sources.select("source_ord", "name"), ["source_ord"], rows=rows)
    return named.select(
        "source_ord",
        F.concat("name", F.lit("-commands")).alias("source_name"),
        F.concat(
            text.slugify("name"),
            F.when(F.col("part") > 0, F.concat(F.lit("-"), (F.col("part") + 1).cast("string")))
            .otherwise(""),
            F.lit(".terminal"),
        ).alias("relative_path"),
        "size",
        F.col("text").cast("binary").alias("raw"),
    ).filter(
        paths.allowed_extension("relative_path", options.include_extensions)
    )


def matches_source(sources: Mapping[int, CommandSource], path: str) -> Column:
    """Include and ignore patterns of the source a path belongs to."""
    kept = F.lit(False)
    for source_ord, source in sources.items():
        kept |= (
            (F.col("source_ord") == source_ord)
            & paths.matches_globs(path, source.include_patterns)
            & ~paths.matches_globs(path, source.ignore_patterns)
        )
    return kept


def shells_by_source(sources: Mapping[int, CommandSource]) -> Column:
    """Shell names of the source a row belongs to."""
    pairs = []
    for source_ord, source in sources.items():
        shells = F.array(*[F.lit(s) for s in source.shells]).cast("array<string>")
        pairs += [F.lit(source_ord), shells]
    return F.try_element_at(F.create_map(*pairs), F.col("source_ord"))

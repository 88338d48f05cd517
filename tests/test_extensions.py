"""Optional steps on edge cases, against plain Python."""

import pytest
from pyspark.sql import functions as F

from millrace.config import ChunkOptions
from millrace.operators import extensions

TEXTS = [None, "", " ", "a", "one two three", "x" * 25, "ab\r\ncd\n", "é漢😀" * 7, "\n\n", "a\tb  c\u2003d"]


@pytest.fixture
def records(spark):
    rows = [(k, t, "terminal" if k % 2 else "text") for k, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "k int, content string, language string")


@pytest.mark.parametrize("size, overlap", [(4, 1), (5, 0), (6, 5)])
def test_windows_of_characters_and_tokens(records, size, overlap):
    options = ChunkOptions(size, overlap)

    def windows(units):
        return [] if not units else [
            (s + 1, min(len(units), s + size), units[s:s + size])
            for s in range(0, max(0, len(units) - overlap - 1) + 1, size - overlap)]

    want = [(k, a, b, c) for k, t in enumerate(TEXTS) for a, b, c in windows(t or "")]
    got = extensions.chunk_characters(records, options).select("k", "start", "end", "content").collect()
    assert sorted(map(tuple, got)) == sorted(want)
    want = [(k, a, b, " ".join(c)) for k, t in enumerate(TEXTS) for a, b, c in windows((t or "").split())]
    got = extensions.chunk_tokens(records, options).select("k", "start", "end", "content").collect()
    assert sorted(map(tuple, got)) == sorted(want)


def test_soft_wrap_loses_nothing(records):
    for row in records.select("content", extensions.soft_wrap("content", 4).alias("w")).collect():
        if row.content is None:
            assert row.w is None
            continue
        lines = row.content.replace("\r\n", "\n").split("\n")
        assert row.w == "\n".join("\n".join(x[i:i + 4] for i in range(0, max(1, len(x)), 4)) for x in lines)


def test_filters_pass_nulls_and_empty_lists(spark, records):
    assert extensions.reject_forbidden(records, ()).count() == len(TEXTS)
    kept = extensions.reject_forbidden(records, ("one|two", "^x+$")).collect()
    assert {r.k for r in kept} == set(range(len(TEXTS))) - {4, 5}
    files = spark.createDataFrame([("a.PY",), ("b/c.md",), ("d",)], "relative_path string")
    assert extensions.exclude_extensions(files, ()).count() == 3
    assert extensions.exclude_globs(files, ()).count() == 3
    assert [r[0] for r in extensions.exclude_extensions(files, (".py",)).collect()] == ["b/c.md", "d"]
    assert [r[0] for r in extensions.exclude_globs(files, ("b/*", "D")).collect()] == ["a.PY"]


def test_shell_rows_only_are_canonical(records):
    rows = records.withColumn("content", F.lit("$  ls   -l\nPS C:\\ dir")).select("k", "language", "content")
    got = {r.language: r.content for r in extensions.canonicalize_shell(rows).collect()}
    assert got == {"terminal": "ls -l\nC:\\ dir", "text": "$  ls   -l\nPS C:\\ dir"}


def test_cut_chunks_are_counted(spark):
    options = ChunkOptions(4, 1)
    chunks = spark.range(10).select((F.col("id") * 3 + 1).alias("start_line"))
    assert extensions.first_chunks(chunks, options, 4).count() == 4
    assert extensions.chunks_cut(chunks, options, 4).first()[0] == 6


def test_estimate_counts_the_lines_that_chunking_sees(spark):
    from millrace.operators.chunking import chunk_lines

    texts = ["a\nb\nc\nd\n", "a\nb\nc\nd", "\n", "", None, "a\r\nb\r\n", "x\n" * 50, "a\x0bb\x85c\n\n"]
    files = spark.createDataFrame([(t,) for t in texts], "content string")
    for size, overlap in ((4, 1), (3, 2), (1, 0)):
        options = ChunkOptions(size, overlap)
        row = extensions.estimate_run(files, options, 10).first()
        assert row.chunks == chunk_lines(files, options).count() and row.files == len(texts)


def test_estimate_and_ratios_of_nothing(spark, records):
    row = extensions.estimate_run(records.limit(0), ChunkOptions(4, 1), 10).first()
    assert tuple(row) == (0, 0, 0)
    names = ("files_deduplicated", "files_scanned", "chunks_deduplicated", "chunks_generated")
    assert tuple(extensions.dedup_ratios(spark.createDataFrame([(0, 0, 0, 0)], names)).first()) == (0.0, 0.0)

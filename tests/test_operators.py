"""Operators on hot keys, on both sides of their size bounds, against plain Python."""

import random

import pytest
from pyspark.sql import functions as F

import rules
from millrace.config import ChunkOptions, CommandSource, DatasetOptions, IngestionOptions
from millrace.functions import twister
from millrace.operators import chunking, commands, filters, joins, positions, split
from millrace.operators.dedup import find_repeats, keep_first
from millrace.sources import tables
from millrace.staging import qualified


@pytest.fixture
def hot(spark):
    """Rows of which a third share one key."""
    rng = random.Random(1)
    rows = [(i % 7, f"p{i:04d}", "hot" if i % 3 == 0 else f"k{rng.randint(0, 400)}") for i in range(3000)]
    frame = spark.createDataFrame(rows, "source_ord int, relative_path string, key string")
    return rows, frame.repartition(13)


def first_rows(rows):
    best = {}
    for source_ord, path, key in sorted(rows):
        best.setdefault(key, (source_ord, path, key))
    return sorted(best.values())


@pytest.mark.parametrize("limit", [None, 0])
@pytest.mark.parametrize("shuffle", [1, 4, 64])
def test_keep_first(spark, hot, limit, shuffle):
    rows, frame = hot
    spark.conf.set("spark.sql.shuffle.partitions", str(shuffle))
    try:
        kept = keep_first(frame, ["key"], ["source_ord", "relative_path"], limit=limit).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert sorted(map(tuple, kept)) == first_rows(rows)


def test_bytes_bound_the_broadcast_too(spark, hot, monkeypatch):
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 10)
    rows, frame = hot
    repeats = find_repeats(frame, ["key"], ["source_ord", "relative_path"])
    assert not repeats.fit_broadcast and not repeats.none
    kept = keep_first(frame, ["key"], ["source_ord", "relative_path"], repeats=repeats)
    assert sorted(map(tuple, kept.collect())) == first_rows(rows)


def test_keep_first_without_repeats(hot):
    _, frame = hot
    assert keep_first(frame, ["relative_path"], ["relative_path"]).count() == 3000


@pytest.mark.parametrize("limit", [None, 0])
@pytest.mark.parametrize("group", [[], ["key"]])
def test_with_positions(hot, group, limit, monkeypatch):
    if limit is not None:
        monkeypatch.setattr(joins, "BROADCAST_ROWS", limit)
    rows, frame = hot
    placed = positions.with_positions(frame, group, ["source_ord", "relative_path"]).collect()
    counters, sizes, want = {}, {}, {}
    for row in sorted(rows):
        label = row[2] if group else None
        want[row] = counters.get(label, 0)
        counters[label] = sizes[label] = want[row] + 1
    assert {tuple(r)[:3]: r.position for r in placed} == want
    assert all(r.group_size == sizes[r.key if group else None] for r in placed)


@pytest.mark.parametrize("n", [0, 1, 50, 1200])
@pytest.mark.parametrize("pruned", [1000, 0])
def test_first_n(hot, n, pruned, monkeypatch):
    monkeypatch.setattr(positions, "PRUNED_RANK", pruned)
    rows, frame = hot
    got = positions.first_n(frame, ["key"], ["source_ord", "relative_path"], n).collect()
    want, seen = [], {}
    for row in sorted(rows):
        seen[row[2]] = seen.get(row[2], 0) + 1
        if seen[row[2]] <= n:
            want.append(row)
    assert sorted(map(tuple, got)) == want


@pytest.mark.parametrize("size, overlap", [(4, 1), (3, 0), (7, 6), (50, 7), (2000, 3)])
@pytest.mark.parametrize("cap", [2, 60, 10_000])
def test_windows_of_a_cut_corpus(spark, size, overlap, cap):
    options = ChunkOptions(target_chunk_size=size, overlap=overlap)
    rng = random.Random(size)
    corpora = {0: [f"c{i}" + "x" * rng.randint(0, 9) for i in range(101)], 1: ["one"], 2: ["w" * 200, "v"]}
    rows = [(o, "p", i, command) for o, held in corpora.items() for i, command in enumerate(held)]
    rng.shuffle(rows)
    corpus = spark.createDataFrame(rows, "source_ord int, path string, line_no bigint, command string")
    texts = commands.corpus_records(corpus, cap, options).withColumnRenamed("text", "content")
    got = sorted(
        (r.source_ord, r.start_line + r.first_line, r.end_line + r.first_line, r.content)
        for r in chunking.chunk_lines(texts, options).collect())
    want = [
        (o, s + 1, min(len(held), s + size), "\n".join(held[s : s + size]))
        for o, held in corpora.items() for s in range(0, max(0, len(held) - overlap - 1) + 1, size - overlap)
    ]
    assert got == sorted(want)


@pytest.mark.parametrize("drawn_through", [split._DRAWN_THROUGH, 0])
def test_sequence_split_draws_like_the_generator(spark, drawn_through, monkeypatch):
    monkeypatch.setattr(split, "_DRAWN_THROUGH", drawn_through)
    options = DatasetOptions(train_ratio=0.7, seed=1337)
    keys = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("k")).repartition(17)
    got = split.sequence_split(keys, ["k"], options).orderBy("k").collect()
    draw = random.Random(1337)
    assert [r.split for r in got] == ["train" if draw.random() < 0.7 else "eval" for _ in got]


def test_characteristic_polynomial():
    polynomial = twister.characteristic()
    assert (polynomial.bit_length(), polynomial.bit_count(), polynomial & 1) == (19938, 135, 1)


@pytest.mark.parametrize("seed", [0, 13, 2**40 + 1])
def test_at_draw_continues_the_stream(seed):
    drawn = random.Random(seed)
    draws = [drawn.random() for _ in range(200_701)]
    for position in (0, 1, 2, 311, 312, 313, 9968, 9969, 200_001):
        got = twister.at_draw(seed, position, twister.characteristic()).random_sample(700)
        assert got.tolist() == draws[position : position + 700]


def test_at_draw_far_away():
    """Two jumps that end apart meet when the earlier one draws on."""
    polynomial = twister.characteristic()
    near, far = (twister.at_draw(13, 10**12 + more, polynomial) for more in (0, 100_003))
    near.random_sample(100_003)
    assert near.random_sample(700).tolist() == far.random_sample(700).tolist()


def test_hash_split_does_not_depend_on_partitions(spark):
    keys = spark.range(4000).select(F.sha1(F.col("id").cast("string").cast("binary")).alias("chunk_hash"))
    column = split.hash_split(DatasetOptions(train_ratio=0.9, seed=13)).alias("split")
    one, many = (
        keys.repartition(n).select("chunk_hash", column).orderBy("chunk_hash").collect() for n in (1, 31)
    )
    assert one == many
    assert 0.88 < sum(r.split == "train" for r in one) / 4000 < 0.92


@pytest.mark.parametrize("size, overlap", [(4, 1), (3, 0), (7, 6), (50, 7), (2000, 3)])
def test_long_text_windows(spark, size, overlap):
    rng = random.Random(2)
    texts = {"hot": [f"h{i}" for i in range(1003)], "one": ["x"], "edge": ["a"] * size}
    rows = [(g, i, line) for g, lines in texts.items() for i, line in enumerate(lines)]
    rng.shuffle(rows)
    frame = spark.createDataFrame(rows, "g string, i int, line string").repartition(9)
    got = chunking.long_text_windows(frame, ["g"], ["i"], ChunkOptions(size, overlap)).collect()
    want = [(g, *w) for g, lines in texts.items() for w in rules.windows("\n".join(lines), size, overlap)]
    assert sorted(map(tuple, got)) == sorted(want)


def command_table(spark):
    rows = [(0, "a", 0, "ls"), (0, "a", 1, "cd x"), (0, "b", 0, "ls"), (0, "b", 1, "top"),
            (1, "a", 0, "x" * 30), (1, "a", 1, "y" * 30)]
    return spark.createDataFrame(rows, "source_ord int, path string, line_no bigint, line string")


def test_corpus_above_the_cap_comes_in_parts(spark):
    corpus = commands.command_corpus(command_table(spark), ("bash",))
    assert sorted(map(tuple, commands.corpus_records(corpus, 60).collect())) == [
        (0, 0, 11, "ls\ncd x\ntop"), (1, 0, 30, "x" * 30), (1, 1, 30, "y" * 30)]
    assert sorted(map(tuple, commands.corpus_records(corpus, 61).collect())) == [
        (0, 0, 11, "ls\ncd x\ntop"), (1, 0, 61, "x" * 30 + "\n" + "y" * 30)]
    names = spark.createDataFrame([(0, "A b"), (1, "C")], "source_ord int, name string")
    records = commands.command_source_records(
        commands.corpus_records(corpus, 60), names, IngestionOptions())
    assert sorted(r.relative_path for r in records.collect()) == [
        "a-b.terminal", "c-2.terminal", "c.terminal"]


def test_a_part_above_the_cap_is_kept(spark):
    lines = [(0, "h", k, c) for k, c in enumerate(["ls", "cd x", "z" * 70, "top"])]
    table = spark.createDataFrame(lines, "source_ord int, path string, line_no bigint, line string")
    corpus = commands.corpus_records(commands.command_corpus(table, ()), 60)
    names = spark.createDataFrame([(0, "a")], "source_ord int, name string")
    records = commands.command_source_records(corpus, names, IngestionOptions(max_file_size_mb=60 / (1 << 20))).collect()
    assert sorted(c for r in records for c in bytes(r.raw).decode().split("\n")) == sorted(x[3] for x in lines)


@pytest.mark.parametrize("limit", [None, 0])
def test_null_keys_and_orders_follow_one_rule(spark, limit):
    schema = "key string, a int, b int"
    rows = [(None, 1, 1), (None, 2, 1), ("k", 3, None), ("k", 3, 2), ("m", None, None), ("n", 4, 1)]
    frame = spark.createDataFrame(rows, schema)
    kept = keep_first(frame, ["key"], ["a", "b"], limit=limit).collect()
    assert sorted(map(str, map(tuple, kept))) == sorted(map(str, [
        (None, 1, 1), ("k", 3, None), ("m", None, None), ("n", 4, 1)]))
    kept = keep_first(frame.select("key", "b"), ["key"], ["b"], limit=limit).collect()
    assert ("k", 2) in map(tuple, kept) and ("k", None) not in map(tuple, kept)


@pytest.mark.parametrize("n", [2, 2000])
def test_null_groups_are_groups(spark, n):
    frame = spark.range(10).selectExpr("if(id < 6, null, 'g') AS g", "id")
    assert positions.first_n(frame, ["g"], ["id"], n).count() == min(n, 6) + min(n, 4)
    placed = positions.with_positions(frame, ["g"], ["id"])
    assert sorted(r.position for r in placed.filter("g IS NULL").collect()) == list(range(6))


def test_totals_before(spark):
    frame = spark.range(500).selectExpr("id % 3 AS g", "id", "id % 7 AS v").repartition(5)
    sums = {0: 0, 1: 0, 2: 0}
    for row in positions.with_totals_before(frame, ["g"], ["id"], "v").orderBy("id").collect():
        assert row.before == sums[row.g]
        sums[row.g] += row.v


def test_caps_per_source(spark):
    corpus = commands.command_corpus(command_table(spark), ())
    capped = commands.command_cap(corpus, {0: 2, 1: None}).collect()
    assert sorted((r.source_ord, r.command) for r in capped) == [
        (0, "cd x"), (0, "ls"), (1, "x" * 30), (1, "y" * 30)
    ]
    assert commands.command_cap(corpus, {0: 0, 1: None}).count() == 2


def test_shells_differ_by_source(spark):
    sources = {
        0: CommandSource("a", "local", "/a", shells=("ls",)),
        1: CommandSource("b", "local", "/b", shells=()),
    }
    lines = spark.createDataFrame([(0, "f", 0, "LS"), (1, "f", 0, "LS")],
                                  "source_ord int, path string, line_no bigint, line string")
    found = commands.command_lines(lines, commands.shells_by_source(sources)).collect()
    assert [r.source_ord for r in found] == [1]


def test_command_records_follow_the_ingestion_rules(spark):
    texts = spark.createDataFrame([(3, 0, 2, "ls")], "source_ord int, part bigint, size bigint, text string")
    names = spark.createDataFrame([(3, " My Hist! ")], "source_ord int, name string")
    row = commands.command_source_records(texts, names, IngestionOptions()).first()
    assert (row.source_name, row.relative_path, bytes(row.raw)) == (
        " My Hist! -commands", "my-hist.terminal", b"ls")
    no_suffix = IngestionOptions(include_extensions=(".py",))
    assert commands.command_source_records(texts, names, no_suffix).count() == 0


def test_record_table_from_json_lines(spark, tmp_path):
    path = str(tmp_path / "records")
    spark.createDataFrame([("a.PY", "é\n"), ("b", "x\x00"), ("c.md", "")], "p string, t string") \
        .write.json(path)
    raw = tables.scan_record_table(
        spark, path, format="json", source_ord=F.lit(4), source_name=F.lit("s"),
        relative_path=F.col("p"), text=F.col("t"))
    rows = tables.to_records(raw).orderBy("relative_path").collect()
    assert [(r.source_ord, r.relative_path, r.content, r.language, r.size) for r in rows] == [
        (4, "a.PY", "é\n", "python", 3), (4, "c.md", "", "markdown", 0)]


@pytest.mark.parametrize("limit", [None, 0])
def test_sized_join_gives_the_same_rows(spark, hot, limit):
    _, frame = hot
    small = spark.createDataFrame([(i, f"s{i}") for i in range(5)], "source_ord int, name string")
    assert joins.sized_join(frame, small, ["source_ord"], limit=limit).count() == sum(
        i % 7 < 5 for i in range(3000)
    )


@pytest.mark.parametrize("limit", [None, 0])
def test_focus_of_odd_sources(spark, limit):
    """Nulls, negative and distant numbers, empty lists and unknown sources, on both ways."""
    lists = {-65: ["go"], -1: [], 0: ["go", None], 63: ["c"], 64: None, 65: [None], 2**31 - 1: ["go"]}
    sources = spark.createDataFrame(list(lists.items()), "source_ord int, languages array<string>")
    rows = [(o, language) for o in (*lists, 1, None) for language in ("go", "c", None)]
    records = spark.createDataFrame(rows, "source_ord int, language string").withColumn("word", F.lit("w"))
    got = filters.filter_source_language(records, sources, limit=limit).collect()
    want = [(o, x) for o, x in rows if lists.get(o) == [] or (x and x in (lists.get(o) or []))]
    assert sorted(map(str, ((r.source_ord, r.language) for r in got))) == sorted(map(str, want))
    assert filters.filter_source_language(records, sources.limit(0), limit=limit).isEmpty()


def test_plain_paths_lie_on_the_default_file_system(spark, tmp_path):
    conf = spark._jsc.hadoopConfiguration()
    before = conf.get("fs.defaultFS")
    assert qualified(spark, "/a/b").startswith("file:/") and qualified(spark, "file:///a/b") == "file:///a/b"
    conf.set("fs.viewfs.mounttable.shared.link./data", f"file://{tmp_path}")
    conf.set("fs.defaultFS", "viewfs://shared/")
    try:
        assert qualified(spark, "/data/x") == "viewfs://shared/data/x"
        assert qualified(spark, "file:///a/b") == "file:///a/b"
    finally:
        conf.set("fs.defaultFS", before)

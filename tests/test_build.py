"""Whole builds over trees, against a plain-Python restatement of the job."""

import dataclasses
import gzip
import hashlib
import json
import os
import random
from collections import Counter
from pathlib import Path, PurePosixPath

import pytest

import rules
from pyspark.sql import functions as F

from millrace.config import ConfigError
from millrace import (
    ChunkOptions, CodeSource, CommandSource, DatasetOptions, IngestionOptions, JobConfig,
    PreprocessOptions, QualityOptions, build_dataset, build_from_records, raw_records, run_from_paths,
)
from millrace.functions import fixed
from millrace.plans.build import build_chunks
from millrace.sinks import manifest
from millrace.sources.tables import to_records

WORDS = ["alpha", "beta\t", "gamma", "é", "  ", "\n", "\n\n\n\n", "\r\n", "x" * 70, "# note", "ls -la"]


def write_tree(base: Path, seed: int, files: int) -> None:
    rng = random.Random(seed)
    shared = random.Random(99)
    common = ["\n".join(shared.choices(WORDS, k=12)) for _ in range(4)]
    for i in range(files):
        suffix = rng.choice([".py", ".JS", ".md", "", ".sh", ".png", ".go"])
        folder = rng.choice(["", "lib/", "a/b/", "vendor/", "_x/"])
        body = rng.choice(common) if i % 3 == 0 else "\n".join(rng.choices(WORDS, k=rng.randint(0, 40)))
        path = base / f"{folder}f{i}{suffix}"
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(body.encode("latin-1" if i % 5 == 0 else "utf-8"))


def walk(root: str):
    """Files below a root in the order of their relative path, without outputs."""
    files = {p.relative_to(root).as_posix(): p for p in Path(root).rglob("*") if p.is_file()}
    return [(name, files[name]) for name in sorted(files) if not name.startswith("out/")]


def tree_files(root: str):
    """Ingested files of a tree, in path order: path, language and bytes."""
    options = IngestionOptions()
    for relative, path in walk(root):
        suffix = PurePosixPath(relative).suffix.lower()
        if set(relative.split("/")[:-1]) & set(options.exclude_dirs):
            continue
        if suffix and suffix not in options.include_extensions:
            continue
        yield relative, fixed.LANGUAGE_BY_EXTENSION.get(suffix, "unknown"), path.read_bytes()


def command_file(root: str, source: CommandSource) -> bytes | None:
    found = {}
    for _, path in walk(root):
        if f"*{path.suffix.lower()}" in source.include_patterns:
            for line in rules.decoded(path.read_bytes()).splitlines():
                found.setdefault(rules.command_of(line, set(source.shells)))
    listed = [c for c in found if c is not None][: source.max_lines]
    return "\n".join(listed).encode() if listed else None


def expected(config: JobConfig):
    """Items per emission order, counters, languages and sources of a build."""
    sources = [("primary-root", (), list(tree_files(config.root)))]
    sources += [(s.name, s.languages, list(tree_files(s.location))) for s in config.code_sources]
    for s in config.command_sources:
        data = command_file(s.location, s)
        if data is not None:
            name = rules.slug(s.name, "commands") + ".terminal"
            sources.append((f"{s.name}-commands", ("terminal",), [(name, "terminal", data)]))
    counts, languages, per_source, items = Counter(), Counter(), Counter(), []
    file_hashes, chunk_hashes = set(), set()
    for name, focus, files in sources:
        for relative, language, data in files:
            if rules.looks_binary(data) or (focus and language not in focus):
                continue
            counts["files_scanned"] += 1
            per_source[name] += 1
            digest = hashlib.sha1(data).hexdigest()
            if config.quality.deduplicate_files and digest in file_hashes:
                counts["files_deduplicated"] += 1
                continue
            file_hashes.add(digest)
            options = config.preprocess
            content = rules.normalised(rules.decoded(data), options.normalize_whitespace,
                                       options.strip_empty_lines, options.max_line_length)
            lines = content.count("\n") + 1 if content else 0
            q = config.quality
            if not (q.min_characters <= len(content) <= (q.max_characters or len(content))
                    and q.min_lines <= lines <= (q.max_lines or lines)):
                counts["files_filtered"] += 1
                continue
            counts["files_emitted"] += 1
            for start, end, chunk in rules.windows(content, config.chunk.target_chunk_size,
                                                   config.chunk.overlap):
                counts["chunks_generated"] += 1
                chunk_hash = hashlib.sha1(chunk.encode()).hexdigest()
                if config.quality.deduplicate_chunks and chunk_hash in chunk_hashes:
                    counts["chunks_deduplicated"] += 1
                    continue
                chunk_hashes.add(chunk_hash)
                counts["chunks_emitted"] += 1
                languages[language] += 1
                items.append({"content": chunk, "language": language, "metadata": {
                    "source_path": relative, "start_line": start, "end_line": end, "hash": digest}})
    return items, counts, dict(languages), dict(per_source)


def read_split(output: str, split: str, compress: bool) -> list[dict]:
    folder = Path(output) / (f"{split}.jsonl.gz" if compress else f"{split}.jsonl")
    assert folder.is_dir()
    rows = []
    for part in sorted(folder.glob("part-*")):
        assert (part.suffix == ".gz") == compress
        text = gzip.decompress(part.read_bytes()) if compress else part.read_bytes()
        rows += [json.loads(line) for line in text.decode().split("\n") if line]
    return rows


def canonical(items):
    return sorted(json.dumps(i, sort_keys=True) for i in items)


@pytest.fixture(scope="module")
def config(tmp_path_factory):
    base = tmp_path_factory.mktemp("build")
    for number, name in enumerate(["main", "other", "hist"]):
        write_tree(base / name, seed=number, files=40)
    (base / "main" / "go.mod").write_text("module x")
    return JobConfig(
        root=base / "main", output_dir=base / "main" / "out", workspace=base / "ws",
        preprocess=PreprocessOptions(max_line_length=60),
        chunk=ChunkOptions(5, 2),
        quality=QualityOptions(min_characters=10, max_characters=1500, min_lines=2, max_lines=60),
        code_sources=(CodeSource("other", "local", str(base / "other"),
                                 languages=("python", "shell", "unknown")),),
        command_sources=(
            CommandSource("My Hist", "local", str(base / "hist"),
                          include_patterns=("*.sh", "*.md"), max_lines=6),
            CommandSource("nothing", "local", str(base / "hist"), include_patterns=("*.zzz",)),
        ),
    )


VARIANTS = {
    "default": {},
    "gzip": {"dataset": DatasetOptions(compress=True)},
    "sequence": {"dataset": DatasetOptions(split_method="sequence", train_ratio=0.6)},
    "no dedup": {"quality": QualityOptions(deduplicate_files=False, deduplicate_chunks=False)},
    "chunk dedup only": {"quality": QualityOptions(deduplicate_files=False)},
    "file dedup only": {"quality": QualityOptions(deduplicate_chunks=False)},
    "raw text": {"preprocess": PreprocessOptions(False, False, None), "quality": QualityOptions()},
}


@pytest.mark.parametrize("variant", VARIANTS)
def test_build(spark, config, variant):
    config = dataclasses.replace(config, **VARIANTS[variant])
    stats = build_dataset(spark, config)
    items, counts, languages, per_source = expected(config)
    compress = config.dataset.compress
    train, evaluated = (read_split(config.output_dir, s, compress) for s in ("train", "eval"))
    assert canonical(train + evaluated) == canonical(items)
    for name, value in counts.items():
        assert stats[name] == value, name
    assert stats["language_distribution"] == languages
    assert stats["source_file_counts"] == per_source
    assert stats["files_scanned"] == sum(
        stats[f"files_{k}"] for k in ("deduplicated", "filtered", "emitted"))
    assert stats["chunks_generated"] == stats["chunks_emitted"] + stats["chunks_deduplicated"]
    if variant == "sequence":
        draw = random.Random(config.dataset.seed)
        wanted = [i for i in items if draw.random() < config.dataset.train_ratio]
        assert canonical(train) == canonical(wanted)
    if variant == "default":
        check_artefacts(config, stats)


def check_artefacts(config, stats):
    output = Path(config.output_dir)
    assert json.loads((output / "dataset_stats.json").read_text()) == stats
    assert json.loads((output / "pipeline_config.json").read_text()) == json.loads(config.to_json())
    parts = sorted((output / "repository_metadata.json").glob("part-*"))
    rows = [json.loads(line) for p in parts for line in p.read_text().splitlines()]
    assert [(r["name"], r["kind"]) for r in rows] == [
        ("primary-root", "code"), ("other", "code"), ("My Hist-commands", "commands")]
    assert rows[0]["dependency_manifests"] == {"go.mod": "go"} and rows[0]["ci_cd"] == {}
    assert rows[0]["path"] == config.root


def _built(spark, tmp_path, texts, **sections):
    rows = [(0, name, text) for name, text in texts.items()]
    table = spark.createDataFrame(rows, "source_ord int, relative_path string, text string")
    raw = raw_records(table, source_ord=F.col("source_ord"), source_name=F.lit("s"),
                      relative_path=F.col("relative_path"), text=F.col("text"))
    job = JobConfig(root=str(tmp_path), output_dir=str(tmp_path / "out"), **sections)
    return build_from_records(raw, job), job


def _items(spark, job):
    out = f"{job.output_dir}/dataset.parquet"
    frame = (spark.read.parquet(out) if job.dataset.output_format == "parquet"
             else spark.read.json([f"{job.output_dir}/train.jsonl", f"{job.output_dir}/eval.jsonl"]))
    return sorted((r.metadata.source_path, r.metadata.start_line, r.metadata.end_line, r.content)
                  for r in frame.collect())


def test_excluded_files_never_enter_a_job(spark, tmp_path):
    texts = {"a.py": "one\n", "b.md": "two", "lib/c.py": "three", "lib/d.MD": "four"}
    stats, job = _built(spark, tmp_path, texts, ingestion=IngestionOptions(
        exclude_extensions=(".md",), exclude_globs=("lib/*",)))
    assert [i[0] for i in _items(spark, job)] == ["a.py"] and stats["files_scanned"] == 1


def test_forbidden_texts_count_as_filtered(spark, tmp_path):
    texts = {"a.py": "key = 1", "b.py": "password=abc", "c.py": "other text"}
    stats, job = _built(spark, tmp_path, texts, quality=QualityOptions(forbidden_patterns=(r"password=\w+",)))
    assert [i[0] for i in _items(spark, job)] == ["a.py", "c.py"]
    assert (stats["files_scanned"], stats["files_filtered"], stats["files_emitted"]) == (3, 1, 2)


def test_wrapped_lines_and_tidied_shell(spark, tmp_path):
    texts = {"a.md": "abcdefgh\nij", "b.sh": "$ ls   -la\n> cd  /"}
    _, job = _built(spark, tmp_path, texts, preprocess=PreprocessOptions(
        max_line_length=5, soft_wrap=True, canonicalize_shell=True))
    assert [i[3] for i in _items(spark, job)] == ["abcde\nfgh\nij", "ls -l\na\ncd /"]


@pytest.mark.parametrize("unit, want", [
    ("characters", [("a.md", 1, 4, "ab c"), ("a.md", 4, 7, "cd e")]),
    ("tokens", [("a.md", 1, 4, "ab cd ef gh"), ("a.md", 4, 5, "gh ij")]),
])
def test_units_caps_and_empty_files(spark, tmp_path, unit, want):
    texts = {"a.md": "ab cd ef gh ij", "b.md": ""}
    stats, job = _built(spark, tmp_path, texts, chunk=ChunkOptions(4, 1, unit=unit, max_chunks_per_file=2))
    assert _items(spark, job) == want
    assert stats["files_emitted"] == 2 and stats["chunks_emitted"] == 2


@pytest.mark.parametrize("form", ["jsonl", "parquet"])
def test_shards_hold_so_many_records(spark, tmp_path, form):
    texts = {f"f{k:03d}.md": f"text {k}" for k in range(40)}
    _, job = _built(spark, tmp_path, texts, dataset=DatasetOptions(output_format=form, max_records_per_shard=3))
    assert len(_items(spark, job)) == 40
    parts = list(Path(job.output_dir).rglob("part-*"))
    if form == "jsonl":
        assert len(parts) >= 14 and all(len(p.read_text().splitlines()) <= 3 for p in parts)
    else:
        assert len(parts) >= 14


def test_only_the_first_of_near_copies_is_built(spark, tmp_path):
    words = [f"w{k}" for k in range(100)]
    texts = {"a.md": " ".join(words), "b.md": " ".join([*words[:99], "other"]), "c.md": "something else entirely here now"}
    stats, job = _built(spark, tmp_path, texts, quality=QualityOptions(near_similarity=0.8))
    assert [i[0] for i in _items(spark, job)] == ["a.md", "c.md"] and stats["files_scanned"] == 2


@pytest.mark.parametrize("options", [
    {}, {"compress": True}, {"output_format": "parquet"}], ids=["jsonl", "gzip", "parquet"])
def test_readers_trust_listed_shards_only(spark, tmp_path, options):
    texts = {f"f{k:03d}.md": f"text {k}\u2028\r\né" for k in range(30)}
    _, job = _built(spark, tmp_path, texts, dataset=DatasetOptions(max_records_per_shard=4, shard_manifest=True, **options))
    out, dataset = job.output_dir, job.dataset
    want = sorted(r.content for r in manifest.read_dataset(spark, out, dataset).collect())
    assert len(want) == 30 and manifest.shard_differences(spark, out, dataset).isEmpty()
    train = Path(out) / ("dataset.parquet/split=train" if options.get("output_format") else f"train.jsonl{'.gz' if options else ''}")
    parts = sorted(p for p in train.glob("part-*") if p.name.endswith(("jsonl", "json", "gz", "parquet")))
    stray = parts[0].with_name("part-99999-" + parts[0].name.split("-", 2)[2])
    stray.write_bytes(parts[0].read_bytes())
    assert sorted(r.content for r in manifest.read_dataset(spark, out, dataset).collect()) == want
    for crc in train.glob(".*.crc"):
        crc.unlink()
    parts[1].write_bytes(parts[2].read_bytes()), parts[3].unlink()
    found = {r.shard: r.difference for r in manifest.shard_differences(spark, out, dataset).collect()}
    assert found == {stray.name: "stray", parts[1].name: "changed", parts[3].name: "missing"}


def test_a_dataset_without_a_list_is_an_error(spark, tmp_path):
    _, job = _built(spark, tmp_path, {"a.md": "x"}, dataset=DatasetOptions(shard_manifest=True))
    assert manifest.read_dataset(spark, job.output_dir, job.dataset).count() == 1
    _, job = _built(spark, tmp_path, {"a.md": "y"})  # a later run without a list takes the old one away
    with pytest.raises(FileNotFoundError):
        manifest.read_dataset(spark, job.output_dir, job.dataset)


def test_the_list_of_an_empty_dataset(spark, tmp_path):
    _, job = _built(spark, tmp_path, {}, dataset=DatasetOptions(shard_manifest=True))
    assert manifest.read_dataset(spark, job.output_dir, job.dataset).isEmpty()
    assert manifest.read_manifest(spark, job.output_dir).isEmpty()


def _ledger(job):
    parts = (Path(job.output_dir) / "rejected_files.json").glob("part-*")
    rows = [json.loads(line) for p in parts for line in p.read_text().splitlines()]
    return {r["relative_path"]: r["reason"] for r in rows}


def test_every_rejected_file_has_a_reason(spark, tmp_path):
    root, long = tmp_path / "root", "many words " * 200_000
    files = {"a.py": "kept\nhere", "b.py": "kept\nhere", "c.bin": "x", "d.md": "x" * 9, "e.py": long, "f.py": "a\0b",
             "g.py": "secret=1\nx", "h.py": "s", "lib/i.py": "p\nq", "empty.py": "", "node_modules/z.js": "not walked"}
    for name, body in files.items():
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_text(body)
    (root / "broken.py").symlink_to("/proc/self/mem")  # a regular file that fails when it is read
    job = JobConfig(
        root=str(root), output_dir=str(tmp_path / "out"), dataset=DatasetOptions(write_rejections=True),
        ingestion=IngestionOptions(max_file_size_mb=1, exclude_extensions=(".md",), exclude_globs=("lib/*",)),
        quality=QualityOptions(min_lines=2, forbidden_patterns=("secret=",)))
    stats = build_dataset(spark, job)
    assert _ledger(job) == {
        "c.bin": "extension", "d.md": "excluded", "e.py": "size", "f.py": "binary", "g.py": "forbidden",
        "h.py": "gates", "empty.py": "gates", "lib/i.py": "excluded", "broken.py": "unreadable"}
    assert stats["files_rejected"] == Counter(_ledger(job).values())
    assert (stats["files_scanned"], stats["files_emitted"], stats["files_deduplicated"]) == (5, 1, 1)
    plain = dataclasses.replace(job, dataset=DatasetOptions(), output_dir=str(tmp_path / "plain"))
    assert build_dataset(spark, plain) == {k: v for k, v in stats.items() if k != "files_rejected"}
    assert _items(spark, plain) == _items(spark, job) and _ledger(plain) == {}


@pytest.mark.parametrize("variant", ["default", "sequence", "raw text"])
def test_a_ledger_changes_no_result(spark, config, variant):
    plain = dataclasses.replace(config, **VARIANTS[variant])
    options = dataclasses.replace(plain.dataset, write_rejections=True)
    job = dataclasses.replace(plain, dataset=options)
    stats = build_dataset(spark, job)
    items, counts, _, _ = expected(plain)
    rows = [read_split(job.output_dir, s, False) for s in ("train", "eval")]
    assert canonical(rows[0] + rows[1]) == canonical(items)
    assert {k: stats[k] for k in counts} == counts
    by_rule = Counter(stats["files_rejected"])
    assert by_rule["gates"] == stats["files_filtered"] and by_rule.total() >= stats["files_filtered"]


def test_near_copies_and_texts_without_bytes_are_accounted_for(spark, tmp_path):
    words = [f"w{k}" for k in range(100)]
    texts = {"a.md": " ".join(words), "b.md": " ".join([*words[:99], "other"]), "c.md": None, "d.md": "a\0b", "e.md": ""}
    stats, job = _built(spark, tmp_path, texts, quality=QualityOptions(near_similarity=0.8),
                        dataset=DatasetOptions(write_rejections=True))
    assert _ledger(job) == {"b.md": "near_duplicate", "c.md": "unreadable", "d.md": "binary"}
    assert stats["files_scanned"] == 2


def test_a_ledger_of_no_files_is_empty(spark, tmp_path):
    stats, job = _built(spark, tmp_path, {}, dataset=DatasetOptions(write_rejections=True))
    assert stats["files_rejected"] == {} and _ledger(job) == {}


@pytest.mark.parametrize("sections", [
    {"chunk": ChunkOptions(unit="pages")}, {"chunk": ChunkOptions(max_chunks_per_file=0)},
    {"dataset": DatasetOptions(output_format="csv")}, {"dataset": DatasetOptions(max_records_per_shard=0)},
    {"quality": QualityOptions(near_similarity=1.5)},
])
def test_bad_optional_values(tmp_path, sections):
    with pytest.raises(ConfigError):
        JobConfig(root=str(tmp_path), output_dir=str(tmp_path / "out"), **sections).validate()


def test_second_run_does_not_read_its_own_output(spark, tmp_path):
    (tmp_path / "a.py").write_text("x = 1\n")
    first = run_from_paths(spark, str(tmp_path), str(tmp_path / "out"))
    second = run_from_paths(spark, str(tmp_path), str(tmp_path / "out"))
    assert first == second and first["files_scanned"] == 1


def test_empty_root(spark, tmp_path):
    root = tmp_path / "root"
    root.mkdir()
    stats = run_from_paths(spark, str(root), str(tmp_path / "out"))
    assert stats["files_scanned"] == stats["chunks_emitted"] == 0
    assert stats["language_distribution"] == {} and stats["source_file_counts"] == {}
    assert read_split(str(tmp_path / "out"), "train", False) == []
    assert read_split(str(tmp_path / "out"), "eval", False) == []
    assert os.path.exists(tmp_path / "out" / "pipeline_config.json")


@pytest.mark.parametrize("scheme", ["", "file://"])
def test_build_from_a_table(spark, config, tmp_path, scheme):
    from pyspark.sql import functions as F

    from millrace.queries import build_queries, inputs, registry

    sf_dir = "/root/testdata/sf0.001"
    config = dataclasses.replace(
        build_queries.CONFIG, output_dir=f"{scheme}{tmp_path}/out",
        ingestion=IngestionOptions(include_extensions=(), exclude_dirs=()))
    raw = raw_records(
        inputs.files(spark, sf_dir), source_ord=F.col("source_ord"),
        source_name=F.col("source_name"), relative_path=F.col("relative_path"), text=F.col("text"))
    stats = build_from_records(raw, config, inputs.sources(spark, sf_dir))
    want = registry.QUERIES["run_stats"](spark, sf_dir).first().asDict()
    assert {k: stats[k] for k in want} == want
    output = str(tmp_path / "out")
    rows = read_split(output, "train", False) + read_split(output, "eval", False)
    assert len(rows) == want["chunks_emitted"]
    assert json.loads((tmp_path / "out" / "dataset_stats.json").read_text()) == stats


@pytest.mark.parametrize("shuffle, limit", [(1, None), (4, 0), (64, 0), (8, 1)])
def test_build_on_hot_copies(spark, config, shuffle, limit):
    """A third of all files are one text; the result is that of one partition."""
    from pyspark.sql import functions as F

    rng = random.Random(4)
    rows = []
    for i in range(600):
        body = "same\nfile\nhere\n" * 5 if i % 3 == 0 else "\n".join(rng.choices(WORDS, k=30))
        rows.append((i % 4, f"s{i % 4}", f"d/f{i}.py", body))
    table = spark.createDataFrame(rows, "o int, n string, p string, t string").repartition(7)
    records = to_records(raw_records(
        table, source_ord=F.col("o"), source_name=F.col("n"), relative_path=F.col("p"),
        text=F.col("t")))
    spark.conf.set("spark.sql.shuffle.partitions", str(shuffle))
    try:
        built = build_chunks(records, config, limit=limit)
        emitted = built.emitted.select("source_ord", "relative_path", "start_line", "content").collect()
        counters = built.counters().first().asDict()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    want, seen_files, seen = [], set(), set()
    for o, _, p, t in sorted(rows, key=lambda r: (r[0], r[2])):
        if t in seen_files:
            continue
        seen_files.add(t)
        content = rules.normalised(t, True, True, 60)
        if not (10 <= len(content) <= 1500 and 2 <= content.count("\n") + 1 <= 60):
            continue
        for start, _, chunk in rules.windows(content, 5, 2):
            if chunk not in seen:
                seen.add(chunk)
                want.append((o, p, start, chunk))
    assert sorted(map(tuple, emitted)) == sorted(want)
    assert counters["files_scanned"] == 600
    assert counters["files_deduplicated"] == 600 - len(seen_files)
    assert counters["chunks_emitted"] == len(want)

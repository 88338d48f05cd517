"""Source trees: listing, reading, command files and repository metadata."""

import hashlib
import os

import pytest

from millrace.config import CommandSource, IngestionOptions
from millrace.operators import commands, metadata
from millrace.sources import scan, tree
from millrace.sources.resolve import ResolvedSource, sources_frame
from millrace.sources.tables import to_records

CAP_MB = 0.001
CAP = int(CAP_MB * 1024 * 1024)
LATIN = "café = 1\n".encode("latin-1")
KEPT = {
    "pkg/__init__.py": b"x = 1\n",
    "pkg/_p.py": b"y = 2\n",
    ".gitlab-ci.yml": b"stages: []\n",
    ".github/workflows/ci.yml": b"on: push\n",
    "Makefile": b"all:\n\ttrue\n",
    ".gitignore": b"*.o\n",
    "a.PY": b"print()\n",
    "e.py": b"",
    "l.py": LATIN,
    "d.py": b"a\x7fb\n",
    "bom.py": "\ufeffx\n".encode(),
    "crlf.py": b"a\r\nb\r\n",
    "at_cap.txt": b"x" * CAP,
    "k=v/x.py": b"1\n",
    "sp ace#1.py": b"2\n",
    "same.js": b"x = 1\n",
}
DROPPED = {
    "b.tar.gz": b"z",
    "n.py": b"a\0b",
    "v.py": b"a\x0bb",
    "over_cap.txt": b"x" * (CAP + 1),
    "node_modules/m.js": b"1",
    "lib/node_modules/n.js": b"1",
    "out/train.json": b"{}",
}


@pytest.fixture(scope="module")
def root(tmp_path_factory):
    base = tmp_path_factory.mktemp("tree")
    for name, data in {**KEPT, **DROPPED}.items():
        path = base / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(data)
    (base / "dangling.py").symlink_to(base / "missing.py")
    (base / "loop").symlink_to(base)
    (base / "linked.py").symlink_to(base / "pkg" / "_p.py")
    return str(base)


def source(path, **values):
    return ResolvedSource(source_ord=0, name="s", kind="code", origin="local", path=path, **values)


def scanned(spark, root, **options):
    raw = scan.scan_source_tree(
        spark, [source(root)], IngestionOptions(max_file_size_mb=CAP_MB, **options),
        exclude_paths=[os.path.join(root, "out")],
    )
    return {r.relative_path: r for r in to_records(raw).collect()}


def test_scan_keeps_and_drops(spark, root):
    found = scanned(spark, root)
    assert set(found) == {*KEPT, "linked.py"}
    for name, data in KEPT.items():
        row = found[name]
        assert (row.size, row.file_hash) == (len(data), hashlib.sha1(data).hexdigest())
    assert found["l.py"].content == "café = 1\n"
    assert found["bom.py"].content == "\ufeffx\n"
    assert found["crlf.py"].content == "a\r\nb\r\n"
    assert found["a.PY"].language == "python"
    assert found["Makefile"].language == found[".gitignore"].language == "unknown"


def test_empty_allow_list_keeps_all_suffixes(spark, root):
    assert "b.tar.gz" in scanned(spark, root, include_extensions=())


def test_links_to_directories(spark, root):
    found = scanned(spark, root, follow_symlinks=True)
    assert set(found) == {*KEPT, "linked.py"}, "a link back to the root is not entered again"


def test_links_to_other_directories_are_followed_on_request(spark, tmp_path):
    inner, outer = tmp_path / "inner", tmp_path / "outer"
    inner.mkdir(), outer.mkdir()
    (outer / "x.py").write_text("1")
    (outer / "back").symlink_to(inner)
    (inner / "link").symlink_to(outer)
    assert set(scanned(spark, str(inner))) == set()
    assert set(scanned(spark, str(inner), follow_symlinks=True)) == {"link/x.py"}


def test_rounds_give_the_same_listing(spark, root, monkeypatch):
    whole = {r.relative_path for r in tree.list_tree(spark, [(0, root)]).collect()}
    monkeypatch.setattr(tree, "_FIRST_BUDGET", 1)
    monkeypatch.setattr(tree, "_LAST_BUDGET", 2)
    rows = tree.list_tree(spark, [(0, root)]).collect()
    assert {r.relative_path for r in rows} == whole and len(rows) == len(whole)


def test_unreadable_and_odd_names(spark, tmp_path):
    name = os.fsencode(str(tmp_path)) + b"/caf\xe9.py"
    with open(name, "wb") as handle:
        handle.write(b"x")
    os.mkfifo(tmp_path / "pipe.py")
    assert set(scanned(spark, str(tmp_path))) == {"caf\\xe9.py"}


def test_unreadable_file_is_skipped(spark, tmp_path):
    (tmp_path / "a.py").write_text("1")
    (tmp_path / "b.py").write_text("2")
    listing = tree.list_tree(spark, [(0, str(tmp_path))])
    (tmp_path / "b.py").unlink()
    rows = {r.relative_path: r.raw for r in tree.read_files(listing).collect()}
    assert bytes(rows["a.py"]) == b"1" and rows["b.py"] is None


def test_no_source(spark, tmp_path):
    assert scan.scan_source_tree(spark, [], IngestionOptions()).count() == 0
    assert scanned(spark, str(tmp_path / "missing")) == {}


def test_command_files(spark, tmp_path):
    (tmp_path / "node_modules").mkdir()
    (tmp_path / "node_modules" / "A.SH").write_bytes(b"$ ls\r\nps\x0caux\n")
    (tmp_path / "latin.md").write_bytes("écho é\n".encode("latin-1"))
    (tmp_path / "shot.sh.png").write_bytes(b"$ no\n")
    (tmp_path / "code.py").write_bytes(b"x = 1\n")
    (tmp_path / "big_history.txt").write_text("one two\x85three\n\nfour")
    config = CommandSource("h", "local", str(tmp_path))
    lines = scan.scan_command_files(spark, [source(str(tmp_path), commands=config)])
    got = {(r.path, r.line_no): r.line for r in lines.collect()}
    assert got == {
        ("node_modules/A.SH", 0): "$ ls", ("node_modules/A.SH", 1): "ps",
        ("node_modules/A.SH", 2): "aux", ("latin.md", 0): "écho é",
        ("big_history.txt", 0): "one", ("big_history.txt", 1): "two",
        ("big_history.txt", 2): "three", ("big_history.txt", 3): "", ("big_history.txt", 4): "four",
    }
    corpus = commands.command_corpus(lines, commands.shells_by_source({0: config}))
    assert {r.command for r in corpus.collect()} == {
        "ls", "ps", "aux", "écho é", "one", "two", "three", "four"
    }


def test_patterns_see_the_full_path(spark, tmp_path):
    (tmp_path / "Keep").mkdir(), (tmp_path / "skip").mkdir()
    (tmp_path / "Keep" / "a.txt").write_text("x")
    (tmp_path / "skip" / "b.txt").write_text("y")
    config = CommandSource("h", "local", "", include_patterns=("*/keep/*",))
    lines = scan.scan_command_files(spark, [source(str(tmp_path), commands=config)])
    assert [r.path for r in lines.collect()] == ["Keep/a.txt"]


def test_metadata(spark, tmp_path):
    first, second = tmp_path / "one", tmp_path / "two"
    for name in ("go.mod", "package.json", "sub/go.mod", "Jenkinsfile", ".github/workflows/ci.yml",
                 ".github/workflows/a/b/x.yml", ".github/workflows/y.yaml", ".github/z.yml",
                 "circle.yml/deep/w.yml", "src/deep/a.py", "Cargo.toml/inner.txt"):
        path = first / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text("x")
    second.mkdir()
    sources = [
        ResolvedSource(0, "one", "code", "local", str(first)),
        ResolvedSource(1, "two", "code", "github", str(second)),
    ]
    listing = scan.list_metadata_paths(spark, sources)
    assert "src/deep/a.py" not in {r.relative_path for r in listing.collect()}
    rows = metadata.repository_metadata(sources_frame(spark, sources), listing)
    one, two = rows.orderBy("source_ord").collect()
    assert one.dependency_manifests == {
        "go.mod": "go", "package.json": "node", "Cargo.toml": "rust",
    }
    assert set(one.ci_cd) == {
        "Jenkinsfile", ".github/workflows/ci.yml", ".github/workflows/a/b/x.yml",
        "circle.yml/deep/w.yml",
    }
    assert set(one.ci_cd.values()) == {"workflow"}
    assert (two.name, two.origin, two.dependency_manifests, two.ci_cd) == ("two", "github", {}, {})
    joined = metadata.repo_manifests(listing).select("relative_path", "ecosystem").collect()
    assert dict(map(tuple, joined)) == one.dependency_manifests


def test_tasks_hold_few_files(spark, tmp_path, monkeypatch):
    """Batches of rows that reach a task, and of files that leave it, are bounded in number and bytes."""
    for k in range(7):
        (tmp_path / f"f{k}.md").write_bytes(b"x" * (k * 1000))
    (tmp_path / "empty.md").write_bytes(b"")
    monkeypatch.setattr(tree, "_BATCH_FILES", 2)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    listing = tree.list_tree(spark, [(0, str(tmp_path))])
    assert int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= 256
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    rows = tree.read_files(listing).collect()
    assert int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= 256
    assert sorted(len(r.raw) for r in rows) == [0, *range(0, 7000, 1000)]

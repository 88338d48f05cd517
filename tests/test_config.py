import json

import pytest

from millrace.config import (
    ChunkOptions, CodeSource, CommandSource, ConfigError, DatasetOptions, IngestionOptions,
    JobConfig, QualityOptions,
)
from millrace.sources.resolve import resolve_sources


def test_values_overlay_defaults(tmp_path):
    path = tmp_path / "dataset.yaml"
    path.write_text(
        "output_dir: out\n"
        "ingestion:\n  max_file_size_mb: 12\n  include_extensions: ['.py', '.go']\n"
        "chunk:\n  target_chunk_size: 1024\n"
        "code_sources:\n  - {name: X, type: Local, location: /x, languages: [Python]}\n"
        "command_sources:\n  - {location: /h, type: local, shells: [BASH], include_patterns: ['*.MD']}\n"
    )
    config = JobConfig.load(path).validate()
    assert config.root == str(tmp_path.resolve())
    assert config.ingestion == IngestionOptions(
        include_extensions=(".py", ".go"), max_file_size_mb=12
    )
    assert config.chunk == ChunkOptions(1024, 200)
    assert config.code_sources == (CodeSource("X", "local", "/x", languages=("python",)),)
    source = config.command_sources[0]
    assert (source.name, source.shells, source.include_patterns) == ("/h", ("bash",), ("*.md",))
    assert source.ignore_patterns == CommandSource("", "", "").ignore_patterns


def test_json_file_and_output_alias(tmp_path):
    path = tmp_path / "dataset.json"
    path.write_text(json.dumps({"root": "/r", "output": "/o", "dataset": {"seed": 1337}}))
    config = JobConfig.load(path)
    assert (config.root, config.output_dir, config.dataset.seed) == ("/r", "/o", 1337)


@pytest.mark.parametrize("values", [{"chunks": {}}, {"chunk": {"size": 3}},
                                    {"code_sources": [{"name": "a", "tag": "v1"}]}])
def test_unknown_keys_are_errors(values):
    with pytest.raises(ConfigError, match="unknown key"):
        JobConfig.from_mapping(values)


@pytest.mark.parametrize(
    "changes",
    [
        {"dataset": DatasetOptions(train_ratio=1.0)},
        {"dataset": DatasetOptions(train_ratio=0)},
        {"dataset": DatasetOptions(split_method="random")},
        {"chunk": ChunkOptions(10, 10)},
        {"chunk": ChunkOptions(0, 0)},
        {"chunk": ChunkOptions(5, -1)},
        {"ingestion": IngestionOptions(max_file_size_mb=0)},
        {"quality": QualityOptions(max_characters=0)},
        {"quality": QualityOptions(max_lines=0)},
        {"quality": QualityOptions(min_characters=5, max_characters=4)},
        {"quality": QualityOptions(min_lines=5, max_lines=4)},
        {"code_sources": (CodeSource("a", "local", ""),)},
        {"command_sources": (CommandSource("a", "local", ""),)},
        {"workspace": "/out"},
    ],
)
def test_bad_values(changes):
    with pytest.raises(ConfigError):
        JobConfig(**{"root": "/r", "output_dir": "/out", **changes}).validate()


def test_dump_leaves_out_missing_top_level_values():
    document = json.loads(JobConfig(root="/r", output_dir="/o").to_json())
    assert "workspace" not in document
    assert document["quality"]["max_lines"] is None
    assert JobConfig.from_mapping(document) == JobConfig(root="/r", output_dir="/o")


def test_sources_in_order(tmp_path):
    checkout = tmp_path / "ws" / "code" / "my-repo"
    checkout.mkdir(parents=True)
    (checkout / "a.py").write_text("x")
    config = JobConfig(
        root=tmp_path, output_dir=tmp_path / "out", workspace=tmp_path / "ws",
        code_sources=(CodeSource("My Repo", "github", "https://example.org/r.git"),),
        command_sources=(CommandSource("hist", "local", str(tmp_path)),),
    )
    sources = resolve_sources(config)
    assert [(s.source_ord, s.name, s.kind, s.origin) for s in sources] == [
        (0, "primary-root", "code", "local"),
        (1, "My Repo", "code", "github"),
        (2, "hist-commands", "commands", "local"),
    ]
    assert sources[1].path == str(checkout)


def test_missing_checkout_is_an_error(tmp_path):
    config = JobConfig(
        root=tmp_path, output_dir=tmp_path / "out",
        code_sources=(CodeSource("r", "git", "https://example.org/r.git"),),
    )
    with pytest.raises(FileNotFoundError, match="not checked out"):
        resolve_sources(config)

"""Job parameters. Driver-side only: frozen values that the plans read."""

from __future__ import annotations

import dataclasses
import json
import os
from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import Any, TypeVar

from millrace.functions import fixed

Section = TypeVar("Section")


class ConfigError(ValueError):
    """A job parameter is missing, unknown or out of range."""


@dataclass(frozen=True)
class IngestionOptions:
    """Which files are read."""

    include_extensions: tuple[str, ...] = fixed.DEFAULT_INCLUDE_EXTENSIONS
    exclude_dirs: tuple[str, ...] = fixed.DEFAULT_EXCLUDE_DIRS
    max_file_size_mb: int | float = 5
    follow_symlinks: bool = False
    exclude_extensions: tuple[str, ...] = ()
    exclude_globs: tuple[str, ...] = ()

    @property
    def max_bytes(self) -> int:
        return int(self.max_file_size_mb * 1024 * 1024)


@dataclass(frozen=True)
class PreprocessOptions:
    """How text is normalised; ``max_line_length`` of None or 0 keeps long lines. With ``soft_wrap``
    longer lines are broken there instead of cut; ``canonicalize_shell`` tidies shell and terminal text."""

    normalize_whitespace: bool = True
    strip_empty_lines: bool = True
    max_line_length: int | None = 2000
    soft_wrap: bool = False
    canonicalize_shell: bool = False


@dataclass(frozen=True)
class ChunkOptions:
    """Window length and overlap, both in ``unit``: lines, characters or tokens (words). Start and end of
    a chunk count the same unit. ``max_chunks_per_file`` keeps the first windows of a file only."""

    target_chunk_size: int = 2048
    overlap: int = 200
    unit: str = "lines"
    max_chunks_per_file: int | None = None

    @property
    def step(self) -> int:
        return self.target_chunk_size - self.overlap


@dataclass(frozen=True)
class DatasetOptions:
    """Train share, seed and compression of the output.

    ``split_method`` is ``hash`` (a function of seed and chunk, the same under any
    partitioning) or ``sequence`` (the seeded Mersenne Twister draw per emitted chunk).
    ``output_format`` is ``jsonl`` or ``parquet``; a file holds at most ``max_records_per_shard`` records.
    ``write_rejections`` lists the rejected files with their reasons and counts them in the statistics.
    ``shard_manifest`` lists the shards of the output after they are written (``sinks.manifest``).
    """

    train_ratio: float = 0.9
    seed: int = 13
    compress: bool = False
    split_method: str = "hash"
    output_format: str = "jsonl"
    max_records_per_shard: int | None = None
    write_rejections: bool = False
    shard_manifest: bool = False


@dataclass(frozen=True)
class QualityOptions:
    """Inclusive size gates on normalised text, and the two deduplication switches. A text in which one of
    the ``forbidden_patterns`` is found counts as filtered. With ``near_similarity`` (0.8, say) only the first
    of near-duplicate files enters the build, before anything is counted."""

    min_characters: int = 0
    max_characters: int | None = None
    min_lines: int = 0
    max_lines: int | None = None
    deduplicate_files: bool = True
    deduplicate_chunks: bool = True
    forbidden_patterns: tuple[str, ...] = ()
    near_similarity: float | None = None


@dataclass(frozen=True)
class CodeSource:
    """A source tree. A ``type`` other than ``local`` is looked up in the workspace."""

    name: str
    type: str
    location: str
    branch: str | None = None
    languages: tuple[str, ...] = ()
    shallow: bool = True
    depth: int = 1
    sparse_paths: tuple[str, ...] = ()
    keep_checkout: bool = False

    def __post_init__(self) -> None:
        _fold_case(self, "type", "languages")
        object.__setattr__(self, "sparse_paths", tuple(p.strip() for p in self.sparse_paths))


@dataclass(frozen=True)
class CommandSource:
    """A tree of shell histories and notes to mine commands from."""

    name: str
    type: str
    location: str
    shells: tuple[str, ...] = fixed.DEFAULT_SHELLS
    include_patterns: tuple[str, ...] = fixed.DEFAULT_COMMAND_PATTERNS
    ignore_patterns: tuple[str, ...] = fixed.DEFAULT_IGNORE_PATTERNS
    max_lines: int | None = None

    def __post_init__(self) -> None:
        _fold_case(self, "type", "shells", "include_patterns", "ignore_patterns")


@dataclass(frozen=True)
class JobConfig:
    """One dataset build."""

    root: str
    output_dir: str
    ingestion: IngestionOptions = field(default_factory=IngestionOptions)
    preprocess: PreprocessOptions = field(default_factory=PreprocessOptions)
    chunk: ChunkOptions = field(default_factory=ChunkOptions)
    dataset: DatasetOptions = field(default_factory=DatasetOptions)
    quality: QualityOptions = field(default_factory=QualityOptions)
    code_sources: tuple[CodeSource, ...] = ()
    command_sources: tuple[CommandSource, ...] = ()
    workspace: str | None = None
    include_primary_root: bool = True

    def __post_init__(self) -> None:
        for name in ("root", "output_dir", "workspace"):
            value = getattr(self, name)
            if value is not None:
                object.__setattr__(self, name, _absolute(value))

    @property
    def workspace_dir(self) -> str:
        return self.workspace or os.path.join(self.output_dir, "_workspace")

    @property
    def output_uri(self) -> str:
        """Output folder for Spark: a plain path is one of the session's default file system."""
        return self.output_dir

    # --- loading -------------------------------------------------------------------
    @classmethod
    def from_mapping(cls, values: Mapping[str, Any], root: str | None = None) -> JobConfig:
        """Values from a config file laid over the defaults. Unknown keys are errors."""
        values = dict(values)
        if "output" in values:
            values.setdefault("output_dir", values["output"])
            del values["output"]
        values.setdefault("output_dir", "dataset")
        values.setdefault("root", root or os.curdir)
        for name, section in _SECTIONS.items():
            if name in values:
                values[name] = _overlay(section(), values[name] or {}, name)
        values["code_sources"] = tuple(
            _source(CodeSource, item, "source") for item in values.get("code_sources") or ()
        )
        values["command_sources"] = tuple(
            _source(CommandSource, item, "commands")
            for item in values.get("command_sources") or ()
        )
        _reject_unknown(cls, values, "config")
        return cls(**values)

    @classmethod
    def load(cls, path: str | os.PathLike[str]) -> JobConfig:
        """Read a JSON or YAML file; a missing root means the folder of the file."""
        with open(path, encoding="utf-8") as handle:
            text = handle.read()
        try:
            values = json.loads(text)
        except json.JSONDecodeError:
            try:
                import yaml
            except ImportError:
                raise ConfigError("reading YAML needs PyYAML") from None
            values = yaml.safe_load(text)
        return cls.from_mapping(values or {}, root=os.path.dirname(os.path.abspath(path)))

    # --- checks --------------------------------------------------------------------
    def validate(self) -> JobConfig:
        """Raise :class:`ConfigError` for the first bad value; return self otherwise."""
        quality, chunk = self.quality, self.chunk
        checks = [
            (0 < self.dataset.train_ratio < 1, "train_ratio must lie between 0 and 1"),
            (self.dataset.split_method in ("hash", "sequence"), "unknown split_method"),
            (chunk.target_chunk_size >= 1, "target_chunk_size must be at least 1"),
            (chunk.overlap >= 0, "overlap must not be negative"),
            (chunk.overlap < chunk.target_chunk_size, "overlap must be below target_chunk_size"),
            (chunk.unit in ("lines", "characters", "tokens"), "unknown unit of chunks"),
            (chunk.max_chunks_per_file is None or chunk.max_chunks_per_file > 0,
             "max_chunks_per_file must be positive"),
            (self.dataset.output_format in ("jsonl", "parquet"), "unknown output_format"),
            (self.dataset.max_records_per_shard is None or self.dataset.max_records_per_shard > 0,
             "max_records_per_shard must be positive"),
            (quality.near_similarity is None or 0 < quality.near_similarity <= 1,
             "near_similarity must lie between 0 and 1"),
            (self.ingestion.max_file_size_mb > 0, "max_file_size_mb must be positive"),
            (self.workspace != self.output_dir, "workspace and output_dir must differ"),
        ]
        for unit in ("characters", "lines"):
            low, high = getattr(quality, f"min_{unit}"), getattr(quality, f"max_{unit}")
            checks.append((high is None or high > 0, f"max_{unit} must be positive"))
            checks.append((high is None or high >= low, f"max_{unit} is below min_{unit}"))
        for source in (*self.code_sources, *self.command_sources):
            checks.append((bool(source.location), f"source {source.name!r} has no location"))
        for passed, message in checks:
            if not passed:
                raise ConfigError(message)
        return self

    # --- dumping -------------------------------------------------------------------
    def to_json(self) -> str:
        """Effective configuration; top-level keys without a value are left out."""
        document = {k: v for k, v in dataclasses.asdict(self).items() if v is not None}
        return json.dumps(document, indent=2, sort_keys=True)


_SECTIONS = {
    "ingestion": IngestionOptions,
    "preprocess": PreprocessOptions,
    "chunk": ChunkOptions,
    "dataset": DatasetOptions,
    "quality": QualityOptions,
}


def _absolute(path: str | os.PathLike[str]) -> str:
    """Resolved path; a URI of another file system stays as it is."""
    text = os.fspath(path).removeprefix("file://")
    if "://" in text:
        return text.rstrip("/")
    return os.path.realpath(os.path.expanduser(text))


def _fold_case(target: Any, *names: str) -> None:
    for name in names:
        value = getattr(target, name)
        folded = value.lower() if isinstance(value, str) else tuple(v.lower() for v in value)
        object.__setattr__(target, name, folded)


def _reject_unknown(target: type, values: Mapping[str, Any], where: str) -> None:
    unknown = sorted(set(values) - {f.name for f in dataclasses.fields(target)})
    if unknown:
        raise ConfigError(f"unknown key in {where}: {', '.join(unknown)}")


def _frozen(values: Mapping[str, Any]) -> dict[str, Any]:
    return {k: tuple(v) if isinstance(v, list) else v for k, v in values.items()}


def _overlay(defaults: Section, values: Mapping[str, Any], where: str) -> Section:
    _reject_unknown(type(defaults), values, where)
    return dataclasses.replace(defaults, **_frozen(values))


def _source(kind: type[Section], values: Mapping[str, Any], fallback: str) -> Section:
    """A source entry; its name falls back to ``id``, then to the location."""
    given = _frozen(values)
    alias = given.pop("id", None)
    given["name"] = given.get("name") or alias or given.get("location", fallback)
    given.setdefault("type", "github")
    given.setdefault("location", "")
    for key in ("shells", "include_patterns", "ignore_patterns", "languages", "sparse_paths"):
        if key in given and not given[key]:
            del given[key]
    _reject_unknown(kind, given, given["name"] or fallback)
    return kind(**given)

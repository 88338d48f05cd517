"""Sources of a job, in order. Driver side: one entry per configured source."""

from __future__ import annotations

import os
import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from millrace.config import CodeSource, CommandSource, JobConfig

SOURCES = (
    "source_ord int, name string, kind string, origin string, path string, "
    "languages array<string>"
)


@dataclass(frozen=True)
class ResolvedSource:
    """A source with the folder that holds it. ``commands`` is set for command sources."""

    source_ord: int
    name: str
    kind: str
    origin: str
    path: str
    languages: tuple[str, ...] = ()
    commands: CommandSource | None = None


def resolve_sources(config: JobConfig) -> list[ResolvedSource]:
    """Primary root, code sources, command sources: their order is the order in which
    the first of several equal files or chunks is found."""
    found: list[ResolvedSource] = []

    def add(**values) -> None:
        found.append(ResolvedSource(source_ord=len(found), **values))

    if config.include_primary_root and os.path.exists(config.root):
        add(name="primary-root", kind="code", origin="local", path=config.root)
    for source in config.code_sources:
        add(name=source.name, kind="code", path=_folder(source, config, "code"),
            origin=source.type, languages=source.languages)
    for source in config.command_sources:
        add(name=f"{source.name}-commands", kind="commands", origin=source.type,
            path=_folder(source, config, "commands", "repository"),
            languages=("terminal",), commands=source)
    return found


def sources_frame(spark: SparkSession, sources: list[ResolvedSource]) -> DataFrame:
    rows = [(s.source_ord, s.name, s.kind, s.origin, s.path, list(s.languages)) for s in sources]
    return spark.createDataFrame(rows, SOURCES)


def folder_slug(name: str, fallback: str = "source") -> str:
    """Driver-side form of :func:`millrace.functions.text.slugify`, for folder names."""
    safe = re.sub(r"[^\w-]", "-", name.strip().lower(), flags=re.UNICODE)
    return safe.strip("-") or fallback


def _folder(source: CodeSource | CommandSource, config: JobConfig, kind: str, *below: str) -> str:
    """Folder of a local source, or the existing checkout of a remote one."""
    if source.type == "local":
        return os.path.realpath(os.path.expanduser(source.location))
    checkout = os.path.join(
        config.workspace_dir, kind, folder_slug(source.name or source.location), *below
    )
    if not (os.path.isdir(checkout) and os.listdir(checkout)):
        raise FileNotFoundError(
            f"source {source.name!r} is not checked out: expected {source.location} in {checkout}"
        )
    return checkout

"""Builds train/eval datasets from source trees and text tables with Spark."""

from millrace.config import (
    ChunkOptions,
    CodeSource,
    CommandSource,
    DatasetOptions,
    IngestionOptions,
    JobConfig,
    PreprocessOptions,
    QualityOptions,
)
from millrace.plans.build import build_dataset, build_from_records, run_from_paths
from millrace.sources.tables import raw_records, scan_record_table

__all__ = [
    "ChunkOptions",
    "CodeSource",
    "CommandSource",
    "DatasetOptions",
    "IngestionOptions",
    "JobConfig",
    "PreprocessOptions",
    "QualityOptions",
    "build_dataset",
    "build_from_records",
    "raw_records",
    "run_from_paths",
    "scan_record_table",
]

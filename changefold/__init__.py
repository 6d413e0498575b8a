"""Fold append-only, versioned change histories into current-state tables with Spark."""

from changefold.errors import (
    ConflictingSourceVersionError,
    PublishConflictError,
    SourceDataError,
    TargetVersionConflictError,
)
from changefold.plans.load import LoadParams, LoadResult, load_records, result_document, run_load
from changefold.plans.store import TargetStore
from changefold.session import build_session, configure, scratch_dir
from changefold.sources.history import append_csv_history, read_csv_history
from changefold.sources.zones import ZonedHistory
from changefold.spec import PRODUCTS, TableSpec, VersionedTable

__all__ = [
    "PRODUCTS",
    "ConflictingSourceVersionError",
    "LoadParams",
    "LoadResult",
    "PublishConflictError",
    "SourceDataError",
    "TableSpec",
    "TargetStore",
    "TargetVersionConflictError",
    "VersionedTable",
    "ZonedHistory",
    "append_csv_history",
    "build_session",
    "configure",
    "load_records",
    "read_csv_history",
    "result_document",
    "run_load",
    "scratch_dir",
]

"""Keyed table synchronisation as Spark DataFrame jobs."""

from tablesync.plans.job import (
    ConstraintError,
    RunResult,
    TableJob,
    link_sync,
    retried,
    run_all,
    run_report,
    sync_table,
)
from tablesync.plans.report import SyncReport
from tablesync.sources.bucketed import BucketedTarget
from tablesync.sources.relational import RelationalTarget
from tablesync.sources.snapshot import SnapshotTarget
from tablesync.sources.state import StateFile
from tablesync.spec import SCAN_ORDER, Reference, SyncOptions, TableSpec

__all__ = [
    "BucketedTarget",
    "ConstraintError",
    "Reference",
    "RelationalTarget",
    "RunResult",
    "SCAN_ORDER",
    "SnapshotTarget",
    "StateFile",
    "SyncOptions",
    "SyncReport",
    "TableJob",
    "TableSpec",
    "link_sync",
    "retried",
    "run_all",
    "run_report",
    "sync_table",
]

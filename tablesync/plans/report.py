"""What a run tells: one row per table."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import asdict, dataclass, field, fields

from pyspark.sql import DataFrame, SparkSession

REPORT_SCHEMA = (
    "table string, mode string, read_rows long, affected_rows long, deleted_rows long, "
    "created boolean, identity array<string>, sequences map<string,long>, "
    "sequence_synced boolean, added_columns map<string,string>, target_only array<string>, "
    "retyped array<string>, dry_run boolean, unique_check string, watermark string, "
    "version long, error string"
)


@dataclass(frozen=True)
class SyncReport:
    """``affected_rows`` counts inserts and real updates."""

    table: str
    mode: str = "full"
    read_rows: int = 0
    affected_rows: int = 0
    deleted_rows: int = 0
    created: bool = False
    identity: tuple[str, ...] = ()
    sequences: dict[str, int] = field(default_factory=dict)
    sequence_synced: bool = False
    added_columns: dict[str, str] = field(default_factory=dict)
    target_only: tuple[str, ...] = ()
    retyped: tuple[str, ...] = ()
    dry_run: bool = False
    unique_check: str = "final"
    watermark: str | None = None
    version: int | None = None
    error: str | None = None


def report_rows(spark: SparkSession, reports: Iterable[SyncReport]) -> DataFrame:
    names = [f.name for f in fields(SyncReport)]
    rows = []
    for report in reports:
        values = asdict(report)
        rows.append(tuple(list(v) if isinstance(v, tuple) else v for v in map(values.get, names)))
    return spark.createDataFrame(rows, REPORT_SCHEMA)

"""Watermarks of targets that have no pointer of their own: one JSON file per table."""

from __future__ import annotations

import json
from urllib.parse import quote, unquote

from pyspark.sql import SparkSession

from tablesync.operators.watermark import Watermark, applicable
from tablesync.session import SharedFiles

ENDING = ".json"


class StateFile:
    """A folder of ``{column, type, value}`` files, one per table.

    Tables never share a file, so runs side by side cannot lose each other's entries.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.files = SharedFiles(spark, path)

    def _name(self, table: str) -> str:
        return quote(table, safe="") + ENDING

    def load(self) -> dict[str, dict]:
        """All entries; missing or unreadable ones do not count."""
        names = [n for n in self.files.names() if n.endswith(ENDING)]
        entries = {unquote(n.removesuffix(ENDING)): self._entry(n) for n in names}
        return {table: entry for table, entry in entries.items() if entry}

    def _entry(self, name: str) -> dict | None:
        if not self.files.exists(name):
            return None
        try:
            entry = json.loads(self.files.read_text(name))
        except ValueError:
            return None
        return entry if isinstance(entry, dict) else None

    def saved(self, table: str) -> Watermark | None:
        return Watermark.from_dict(self._entry(self._name(table)))

    def get(self, table: str, column: str) -> Watermark | None:
        """The saved value, if it belongs to this column."""
        return applicable(self.saved(table), column, full_refresh=False)

    def set(self, table: str, watermark: Watermark) -> None:
        text = json.dumps(watermark.as_dict(), ensure_ascii=False, indent=2)
        self.files.write_text(self._name(table), text, True)

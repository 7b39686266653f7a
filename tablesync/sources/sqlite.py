"""SQLite files as a Spark data source, always opened read-only.

    spark.dataSource.register(SqliteSource)
    spark.read.format("sqlite").option("path", p).option("table", "t").load()

The file must be readable by every executor under the same path. Rows are split by
rowid range; a table without rowid is split by its first key column. Column types
follow the declared types; cells of another storage class are converted by the rules
of the column type, and a cell that does not fit fails the read. Comparisons on numbers and texts are pushed into
the file when ``spark.sql.python.filterPushdown.enabled`` is on; Spark checks every
row again, so a pushed filter may only let too many rows pass.
"""

from __future__ import annotations

import datetime as dt
import os
import sqlite3
from collections.abc import Callable, Iterator
from contextlib import closing
from dataclasses import dataclass
from decimal import Decimal

import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    EqualTo,
    GreaterThan,
    GreaterThanOrEqual,
    InputPartition,
    LessThan,
    LessThanOrEqual,
)
from pyspark.sql.pandas.types import to_arrow_schema

from tablesync.functions.declared_types import spark_type
from tablesync.spec import TableSpec, text_is_true

BATCH_ROWS = 10_000
DEFAULT_PARTITIONS = 8

_COMPARISONS = {
    EqualTo: "=",
    GreaterThan: ">",
    GreaterThanOrEqual: ">=",
    LessThan: "<",
    LessThanOrEqual: "<=",
}


def quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def connect(path: str) -> sqlite3.Connection:
    """Read-only connection; a missing file is an error, never a new database."""
    if not os.path.isfile(path):
        raise FileNotFoundError(f"not a SQLite file: {path}")
    return sqlite3.connect(f"file:{path}?mode=ro", uri=True)


@dataclass(frozen=True)
class TableInfo:
    """Columns with declared types and the key in key order."""

    declared: dict[str, str]
    key: tuple[str, ...]
    has_rowid: bool


def table_info(path: str, table: str) -> TableInfo:
    with closing(connect(path)) as db:
        rows = db.execute(
            "SELECT name, type, pk FROM pragma_table_info(?) ORDER BY cid", (table,)
        ).fetchall()
        if not rows:
            raise ValueError(f"no table {table} in {path}")
        kind = db.execute("SELECT wr FROM pragma_table_list(?)", (table,)).fetchone()
    key = sorted((place, name) for name, _, place in rows if place)
    return TableInfo(
        declared={name: declared or "" for name, declared, _ in rows},
        key=tuple(name for _, name in key),
        has_rowid=not (kind and kind[0]),
    )


def sqlite_spec(path: str, table: str, **declared) -> TableSpec:
    """Spec of a SQLite table: its own key and declared types. No key, no sync."""
    info = table_info(path, table)
    return TableSpec(name=table, key=info.key, declared_types=info.declared, **declared)


def read_sqlite(
    spark: SparkSession, path: str, table: str, partitions: int = DEFAULT_PARTITIONS
):
    connect(path).close()
    spark.dataSource.register(SqliteSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    reader = spark.read.format("sqlite").option("path", path).option("table", table)
    return reader.option("partitions", partitions).load()


class SqliteSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "sqlite"

    def schema(self) -> T.StructType:
        info = table_info(self.options["path"], self.options["table"])
        return T.StructType(
            [T.StructField(n, spark_type(d)) for n, d in info.declared.items()]
        )

    def reader(self, schema: T.StructType) -> SqliteReader:
        return SqliteReader(dict(self.options), schema)


@dataclass
class KeyRange(InputPartition):
    """Rows with ``low <= split column < high``; None leaves an end open."""

    low: object
    high: object


class SqliteReader(DataSourceReader):
    def __init__(self, options: dict[str, str], schema: T.StructType) -> None:
        self.path = options["path"]
        self.table = options["table"]
        self.n_partitions = int(options.get("partitions", DEFAULT_PARTITIONS))
        self.schema = schema
        info = table_info(self.path, self.table)
        self.split = "rowid" if info.has_rowid else quoted(info.key[0])
        self.by_rowid = info.has_rowid
        self.conditions: list[str] = []
        self.values: list[object] = []

    def pushFilters(self, filters):
        types = {f.name: f.dataType for f in self.schema.fields}
        for f in filters:
            sign = _COMPARISONS.get(type(f))
            column = ".".join(getattr(f, "attribute", ()))
            value = getattr(f, "value", None)
            if sign is None or column not in types:
                continue
            name = quoted(column)
            if isinstance(types[column], T.StringType) and isinstance(value, str):
                plain, storage = f"{name} COLLATE BINARY {sign} ?", "'text'"
            elif isinstance(types[column], (T.LongType, T.DoubleType)) and isinstance(
                value, (int, float)
            ):
                plain, storage = f"{name} {sign} ?", "'integer', 'real'"
            else:
                continue
            # Cells of another storage class are converted first, so Spark decides.
            self.conditions.append(f"({plain} OR typeof({name}) NOT IN ({storage}))")
            self.values.append(value)
        return filters

    def partitions(self) -> list[KeyRange]:
        with closing(connect(self.path)) as db:
            cuts = self._rowid_cuts(db) if self.by_rowid else self._key_cuts(db)
        ends = [None, *cuts, None]
        return [KeyRange(low, high) for low, high in zip(ends, ends[1:])]

    def _rowid_cuts(self, db: sqlite3.Connection) -> list[int]:
        low, high = db.execute(
            f"SELECT min(rowid), max(rowid) FROM {quoted(self.table)}"
        ).fetchone()
        if low is None:
            return []
        step = max(1, -(-(high - low + 1) // self.n_partitions))
        return list(range(low + step, high + 1, step))

    def _key_cuts(self, db: sqlite3.Connection) -> list[object]:
        table = quoted(self.table)
        total = db.execute(f"SELECT count(*) FROM {table}").fetchone()[0]
        step = max(1, -(-total // self.n_partitions))
        cuts = [
            db.execute(
                f"SELECT {self.split} FROM {table} ORDER BY {self.split} LIMIT 1 OFFSET ?", (at,)
            ).fetchone()[0]
            for at in range(step, total, step)
        ]
        return list(dict.fromkeys(cuts))

    def read(self, partition: KeyRange) -> Iterator[pa.RecordBatch]:
        conditions, values = list(self.conditions), list(self.values)
        if partition.low is not None:
            conditions.append(f"{self.split} >= ?")
            values.append(partition.low)
        if partition.high is not None:
            conditions.append(f"{self.split} < ?")
            values.append(partition.high)
        columns = ", ".join(quoted(f.name) for f in self.schema.fields)
        query = f"SELECT {columns} FROM {quoted(self.table)}"
        if conditions:
            query += " WHERE " + " AND ".join(conditions)
        schema = to_arrow_schema(self.schema)
        convert = [cell_converter(f.dataType) for f in self.schema.fields]
        with closing(connect(self.path)) as db:
            cursor = db.execute(query, values)
            while rows := cursor.fetchmany(BATCH_ROWS):
                arrays = [
                    pa.array([None if v is None else fit(v) for v in cells], field.type)
                    for fit, cells, field in zip(convert, zip(*rows), schema)
                ]
                yield pa.RecordBatch.from_arrays(arrays, schema=schema)


def cell_converter(kind: T.DataType) -> Callable:
    """Stored cell (int, float, text or bytes) -> value of a column type."""
    for spark_kind, convert in _CONVERTERS:
        if isinstance(kind, spark_kind):
            return convert(kind) if spark_kind is T.DecimalType else convert
    raise TypeError(f"no SQLite column maps to {kind.simpleString()}")


def _boolean(cell) -> bool:
    return text_is_true(cell) if isinstance(cell, str) else bool(cell)


def _binary(cell) -> bytes:
    if isinstance(cell, (int, float)):
        raise ValueError(f"a number does not fit a binary column: {cell!r}")
    return cell.encode("utf-8") if isinstance(cell, str) else bytes(cell)


def _text(cell) -> str:
    if isinstance(cell, bytes):
        raise ValueError("bytes do not fit a text column")
    return str(cell)


def _integer(cell) -> int:
    return round(cell) if isinstance(cell, float) else int(cell)


def _timestamp(cell) -> dt.datetime:
    return dt.datetime.fromisoformat(_iso(cell)).replace(tzinfo=None)


def _date(cell) -> dt.date:
    return _timestamp(cell).date()


def _iso(cell) -> str:
    if not isinstance(cell, str):
        raise ValueError(f"a time column holds {cell!r}")
    return cell.strip()


def _decimal(kind: T.DecimalType) -> Callable:
    step = Decimal(1).scaleb(-kind.scale)

    def convert(cell) -> Decimal:
        number = Decimal(str(cell))
        with_scale = number.quantize(step, rounding="ROUND_HALF_UP")
        return with_scale

    return convert


_CONVERTERS = (
    (T.BooleanType, _boolean),
    (T.BinaryType, _binary),
    (T.StringType, _text),
    (T.LongType, _integer),
    (T.DoubleType, float),
    (T.TimestampNTZType, _timestamp),
    (T.DateType, _date),
    (T.DecimalType, _decimal),
)

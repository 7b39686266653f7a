"""A target table in an external database, reached over JDBC.

Spark computes the change set; only those rows travel. They are appended to a
staging table in parallel, and one transaction in the database then adds missing
columns, deletes the pruned keys and merges the rest, in that order, so a row that
moved to a new key does not clash with its old self. The watermark goes to a state
file after that transaction: a run that dies in between repeats rows, which changes
nothing.

The target offers what a run needs of any target (``pointer``, ``load``, ``stage``,
``commit``); unique keys of the table are taken from the spec.
"""

from __future__ import annotations

import uuid
from collections.abc import Collection, Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.functions.declared_types import sql_type_name
from tablesync.operators.classify import OP, PRUNE
from tablesync.operators.merge import apply_changes
from tablesync.sources.snapshot import Pointer
from tablesync.sources.state import StateFile
from tablesync.spec import TableSpec


def sql_name(name: str) -> str:
    return ".".join('"' + part.replace('"', '""') + '"' for part in name.split("."))


def _on(key: Sequence[str]) -> str:
    return " AND ".join(f"t.{sql_name(c)} = s.{sql_name(c)}" for c in key)


def add_column_statement(table: str, column: T.StructField) -> str:
    return (
        f"ALTER TABLE {sql_name(table)} ADD COLUMN IF NOT EXISTS "
        f"{sql_name(column.name)} {sql_type_name(column.dataType)}"
    )


def delete_statement(table: str, staging: str, key: Sequence[str]) -> str:
    return (
        f"DELETE FROM {sql_name(table)} AS t WHERE EXISTS "
        f"(SELECT 1 FROM {sql_name(staging)} AS s WHERE s.{sql_name(OP)} = '{PRUNE}' AND {_on(key)})"
    )


def merge_statement(table: str, staging: str, key: Sequence[str], columns: Sequence[str]) -> str:
    """``columns`` are the columns the source supplies; others keep value or default."""
    names = [sql_name(c) for c in columns]
    updates = [f"{sql_name(c)} = s.{sql_name(c)}" for c in columns if c not in key]
    matched = f" WHEN MATCHED THEN UPDATE SET {', '.join(updates)}" if updates else ""
    return (
        f"MERGE INTO {sql_name(table)} AS t "
        f"USING (SELECT * FROM {sql_name(staging)} WHERE {sql_name(OP)} <> '{PRUNE}') AS s ON {_on(key)}"
        f"{matched} WHEN NOT MATCHED THEN INSERT ({', '.join(names)}) "
        f"VALUES ({', '.join('s.' + n for n in names)})"
    )


@dataclass(frozen=True)
class Staged:
    """What ``commit`` will send to the database."""

    live: tuple[str, ...]
    changes: DataFrame
    columns: tuple[str, ...]


class RelationalTarget:
    def __init__(
        self,
        spark: SparkSession,
        spec: TableSpec,
        url: str,
        table: str | None = None,
        properties: Mapping[str, str] | None = None,
        read_options: Mapping[str, str] | None = None,
        state: StateFile | None = None,
        write_tasks: int | None = None,
    ) -> None:
        """``read_options`` should split the read (see ``readers.jdbc_options``).

        ``write_tasks`` is how many connections write at once, if the database needs a limit;
        rows are dealt out anew for it, so the stages before keep their own parallelism.
        """
        self.spark, self.spec, self.url = spark, spec, url
        self.table = table or spec.name
        self.properties = dict(properties or {})
        self.read_options = dict(read_options or {})
        self.state = state
        self.write_tasks = write_tasks
        self._staged: Staged | None = None

    # -- what a run needs of a target --------------------------------------------

    def exists(self) -> bool:
        return True  # reading a missing table fails by itself

    def pointer(self) -> Pointer:
        return Pointer(
            version=0,
            schema=self._read().schema,
            key=self.spec.key,
            unique_keys=self.spec.unique_keys,
            identity=self.spec.identity,
            buckets=1,
            live=(self.table,),
            watermark=self.state.saved(self.spec.name) if self.state else None,
        )

    def load(self, pointer: Pointer | None = None, buckets: list[int] | None = None) -> DataFrame:
        """Rows of the table; those of a staged version with its changes applied."""
        rows = self._read()
        if pointer is None:
            return rows
        new = [f for f in pointer.schema.fields if f.name not in rows.columns]
        rows = rows.withColumns({f.name: F.lit(None).cast(f.dataType) for f in new})
        if self._staged is not None and pointer.live == self._staged.live:
            rows = apply_changes(rows, self._staged.changes, pointer.key)
        return rows

    rows = load

    def stage(
        self,
        old: Pointer,
        schema: T.StructType,
        changes: DataFrame,
        ops: Collection[str],
        columns: Sequence[str],
    ) -> Pointer:
        live = old.live
        if ops:
            live = (f"{self.table}__{uuid.uuid4().hex}",)
            self._staged = Staged(live, changes, tuple(columns))
        return replace(old, version=old.version + 1, schema=schema, live=live)

    def commit(self, pointer: Pointer) -> None:
        known = set(self._read().columns)
        statements = [
            add_column_statement(self.table, f) for f in pointer.schema if f.name not in known
        ]
        staged, self._staged = self._staged, None
        if staged is None or staged.live != pointer.live:
            if statements:
                self._transaction(statements)
        else:
            (staging,) = staged.live
            self._write_staging(staged.changes.select(OP, *staged.columns), staging)
            try:
                statements.append(delete_statement(self.table, staging, pointer.key))
                statements.append(
                    merge_statement(self.table, staging, pointer.key, staged.columns)
                )
                self._transaction(statements)
            finally:
                self._transaction([f"DROP TABLE {sql_name(staging)}"])
        if self.state and pointer.watermark:
            self.state.set(self.spec.name, pointer.watermark)

    # -- the database --------------------------------------------------------------

    def _read(self) -> DataFrame:
        reader = self.spark.read.format("jdbc").option("preferTimestampNTZ", "true")
        reader = reader.options(**self.properties, **self.read_options)
        return reader.option("url", self.url).option("dbtable", sql_name(self.table)).load()

    def _write_staging(self, rows: DataFrame, staging: str) -> None:
        writer = (rows.repartition(self.write_tasks) if self.write_tasks else rows).write.format("jdbc").mode("overwrite")
        writer = writer.options(**self.properties)
        writer.option("url", self.url).option("dbtable", sql_name(staging)).save()

    def _transaction(self, statements: Sequence[str]) -> None:
        jvm = self.spark._jvm
        properties = jvm.java.util.Properties()
        for name, value in self.properties.items():
            properties.setProperty(name, value)
        db = jvm.java.sql.DriverManager.getConnection(self.url, properties)
        try:
            db.setAutoCommit(False)
            statement = db.createStatement()
            for text in statements:
                statement.execute(text)
            db.commit()
        except BaseException:
            db.rollback()
            raise
        finally:
            db.close()

"""A stored target whose base folders are bucketed tables of Spark's own writer.

A run compares its whole source with the whole target by key. Where the target is bucketed
and sorted by that key, Spark reads it in place, and only the source is exchanged. Folders
stay plain Parquet that any session can open: what makes them bucketed tables is a catalogue
entry, which each session adds for itself, so no shared catalogue is needed.

Choose ``buckets`` no smaller than ``spark.sql.shuffle.partitions``, else Spark prefers to
deal the target out anew. A run that inserts adds a base folder; ``compact`` makes one of
them again.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.sources.snapshot import BUCKET, Pointer, SnapshotTarget, bucket_of


class BucketedTarget(SnapshotTarget):
    """Like ``SnapshotTarget``, with one file a bucket and base folder."""

    _key: tuple[str, ...] = ()

    def using(self, spark) -> BucketedTarget:
        return BucketedTarget(spark, self.root, self.buckets, self.files_per_bucket)

    def rows(self, pointer: Pointer | None = None, buckets: list[int] | None = None) -> DataFrame:
        pointer = pointer or self.pointer()
        if pointer is not None:
            self._key, self.buckets = pointer.key, pointer.buckets
        return super().rows(pointer, buckets)

    def _read(self, folders: Sequence[str], schema: T.StructType) -> DataFrame:
        if not folders:
            return super()._read(folders, schema)
        tables = [self.spark.table(self._registered(folder, schema)) for folder in folders]
        rows = reduce(DataFrame.unionByName, tables)
        return rows.withColumn(BUCKET, bucket_of(self._key, self.buckets))

    def _registered(self, folder: str, schema: T.StructType) -> str:
        """Name of the catalogue entry of a folder read with a schema."""
        name = self._table(folder, schema)
        if not self.spark.catalog.tableExists(name):
            columns = self.spark._jsparkSession.parseDataType(schema.json()).toDDL()
            keys = ", ".join(f"`{c}`" for c in self._key)
            path = self._path(folder).replace("'", "\\'")
            self.spark.sql(
                f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({keys}) "
                f"SORTED BY ({keys}) INTO {self.buckets} BUCKETS LOCATION '{path}'"
            )
        return name

    def _table(self, folder: str, schema: T.StructType) -> str:
        text = f"{self._path(folder)} {schema.json()}"
        return f"tablesync_{hashlib.sha256(text.encode()).hexdigest()[:32]}"

    def _write(self, rows: DataFrame, old: Pointer, version: int) -> str:
        """One exchange by key, then one sorted file for each bucket."""
        self._key, self.buckets = old.key, old.buckets
        folder = f"{version:012d}-{uuid.uuid4().hex[:12]}"
        laid_out = rows.repartition(old.buckets, *old.key)
        name = f"tablesync_{uuid.uuid4().hex}"
        writer = laid_out.write.bucketBy(old.buckets, *old.key).sortBy(*old.key)
        writer.format("parquet").option("path", self._path(folder)).saveAsTable(name)
        self.spark.sql(f"DROP TABLE {name}")  # the entry alone: the folder is not the catalogue's
        return folder

    def expire(self, keep: int = 2) -> list[str]:
        dropped = super().expire(keep)
        for table in self.spark.catalog.listTables():
            if table.name.startswith("tablesync_") and any(f in self._location(table.name) for f in dropped):
                self.spark.sql(f"DROP TABLE {table.name}")
        return dropped

    def _location(self, name: str) -> str:
        rows = self.spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where(F.col("col_name") == "Location")
        return "".join(r["data_type"] for r in rows.collect())

"""A target table as versioned Parquet folders with one small pointer per version.

Rows are laid out in ``buckets`` by the hash Spark itself uses to partition by key, so
the exchange that lays a load out leaves each task inside one bucket. A run writes what
it changes and no more: new rows become a further base folder, updated and pruned rows a
delta folder, which readers merge over the base by key, newest version first. ``compact``
folds the deltas into a new base; it is an operation of its own and never part of a sync.
Then the run creates the next pointer file; that single rename publishes rows, added
columns, watermark and stream batch together. Readers hold the old version until then, a
failed run leaves it live, and a second writer of the same version fails.

Layout:  <root>/data/__folder=<version>-<attempt>/__bucket=<b>/*.parquet   (base)
         <root>/data/__folder=<version>-<attempt>/*.parquet                (delta)
         <root>/pointer/<version>.json

Every attempt has a folder of its own, so writers never touch each other's files.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Collection, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.operators.classify import INSERT, OP, PRUNE
from tablesync.operators.watermark import Watermark
from tablesync.session import SharedFiles
from tablesync.spec import TableSpec, check_columns, plain_name, safe_name

FOLDER = "__folder"
BUCKET = "__bucket"
VERSION = "__version"


@dataclass(frozen=True)
class Pointer:
    """What one version consists of.

    ``live`` lists the base folders, ``deltas`` the change sets over them, oldest first.
    ``batches`` has the last batch of each stream, ``high_water`` the key maxima if known.
    """

    version: int
    schema: T.StructType
    key: tuple[str, ...]
    unique_keys: tuple[tuple[str, ...], ...]
    identity: tuple[str, ...]
    buckets: int
    live: tuple[str, ...] = ()
    deltas: tuple[str, ...] = ()
    watermark: Watermark | None = None
    batches: dict[str, int] = field(default_factory=dict)
    high_water: dict[str, int] | None = None

    def next_with(self, **changes) -> Pointer:
        """The following version with the same rows and some fields set."""
        return replace(self, version=self.version + 1, **changes)

    def to_json(self) -> str:
        return json.dumps(
            {
                "version": self.version,
                "schema": self.schema.jsonValue(),
                "key": self.key,
                "unique_keys": self.unique_keys,
                "identity": self.identity,
                "buckets": self.buckets,
                "live": self.live,
                "deltas": self.deltas,
                "watermark": self.watermark.as_dict() if self.watermark else None,
                "batches": self.batches,
                "high_water": self.high_water,
            }
        )

    @classmethod
    def from_json(cls, text: str) -> Pointer:
        d = json.loads(text)
        return cls(
            version=d["version"],
            schema=T.StructType.fromJson(d["schema"]),
            key=tuple(d["key"]),
            unique_keys=tuple(tuple(u) for u in d["unique_keys"]),
            identity=tuple(d["identity"]),
            buckets=d["buckets"],
            live=tuple(d["live"]),
            deltas=tuple(d["deltas"]),
            watermark=Watermark.from_dict(d["watermark"]),
            batches=d["batches"],
            high_water=d["high_water"],
        )


def bucket_of(key: tuple[str, ...], buckets: int) -> Column:
    """Same hash as Spark's hash partitioning: partition p of n*buckets is in p % buckets."""
    return F.pmod(F.hash(*key), F.lit(buckets))


class SnapshotTarget:
    """``buckets`` times ``files_per_bucket`` is the number of tasks that write a base.

    Both are chosen when the table is created; a bucket file should hold a few
    hundred megabytes, so 100 TB wants some thousand buckets of tens of files.
    """

    def __init__(
        self, spark: SparkSession, root: str, buckets: int = 64, files_per_bucket: int = 1
    ) -> None:
        self.spark = spark
        self.root = root.rstrip("/")
        self.buckets = buckets
        self.files_per_bucket = files_per_bucket
        self.files = SharedFiles(spark, self.root)

    def using(self, spark: SparkSession) -> SnapshotTarget:
        """The same table seen from another session."""
        return SnapshotTarget(spark, self.root, self.buckets, self.files_per_bucket)

    # -- reading ---------------------------------------------------------------

    def pointer(self) -> Pointer | None:
        names = [n for n in self.files.names("pointer") if n.endswith(".json")]
        if not names:
            return None
        return Pointer.from_json(self.files.read_text(f"pointer/{max(names)}"))

    def exists(self) -> bool:
        return self.pointer() is not None

    def load(self, pointer: Pointer | None = None, buckets: list[int] | None = None) -> DataFrame:
        """Rows of a version (the newest by default), or of some of its buckets."""
        rows = self.rows(pointer, buckets)
        names = [plain_name(c) for c in rows.columns]
        return rows if names == rows.columns else rows.toDF(*names)

    def rows(self, pointer: Pointer | None = None, buckets: list[int] | None = None) -> DataFrame:
        """The same under the names they are stored with, which are safe in column paths.

        Files written before a column was added lack it and read as NULL.
        """
        pointer = pointer or self.pointer()
        if pointer is None:
            raise ValueError(f"target table does not exist: {self.root}")
        rows = self._read(pointer.live, pointer.schema)
        if buckets is not None:
            rows = rows.where(F.col(BUCKET).isin(buckets)) if pointer.live else rows
        rows = rows.select(*pointer.schema.names)
        if not pointer.deltas:
            return rows
        newest = self._newest(pointer)
        if buckets is not None:
            newest = newest.where(bucket_of(pointer.key, pointer.buckets).isin(buckets))
        kept = rows.join(newest.select(*pointer.key), list(pointer.key), "left_anti")
        changed = newest.where(F.col(OP) != PRUNE)
        return kept.select(*pointer.schema.names).unionByName(changed.select(*pointer.schema.names))

    def _read(self, folders: Sequence[str], schema: T.StructType) -> DataFrame:
        """Whole folders, each listed once; buckets are partitions that filters prune."""
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self._open(folders, [*schema.fields, T.StructField(BUCKET, T.IntegerType())])

    def _open(self, folders: Sequence[str], fields: list[T.StructField]) -> DataFrame:
        reader = self.spark.read.schema(T.StructType(fields)).option("basePath", f"{self.root}/data")
        return reader.parquet(*[self._path(folder) for folder in folders])

    def _path(self, folder: str) -> str:
        return f"{self.root}/data/{FOLDER}={folder}"

    def _newest(self, pointer: Pointer) -> DataFrame:
        """The last change of each key that changed since the base was written."""
        extra = [T.StructField(OP, T.StringType()), T.StructField(VERSION, T.LongType())]
        changes = self._open(pointer.deltas, [*pointer.schema.fields, *extra])
        if len(pointer.deltas) == 1:
            return changes
        rest = [c for c in (OP, *pointer.schema.names) if c not in pointer.key]
        last = changes.groupBy(*pointer.key).agg(
            F.max_by(F.struct(*rest), F.col(VERSION)).alias("__row")
        )
        return last.select(*pointer.key, *[F.col("__row").getField(c).alias(c) for c in rest])

    # -- writing ---------------------------------------------------------------

    def create(self, spec: TableSpec, schema: T.StructType) -> Pointer:
        """Publish an empty table."""
        pointer = self.new_pointer(spec, schema)
        self.commit(pointer)
        return pointer

    def new_pointer(self, spec: TableSpec, schema: T.StructType) -> Pointer:
        check_columns(schema)
        spec = spec.safe()
        nullable = T.StructType([T.StructField(safe_name(f.name), f.dataType, True) for f in schema])
        return Pointer(0, nullable, spec.key, spec.unique_keys, spec.identity, self.buckets)

    def stage(
        self,
        old: Pointer,
        schema: T.StructType,
        changes: DataFrame,
        ops: Collection[str],
        columns: Sequence[str],
    ) -> Pointer:
        """Write a change set; publish nothing yet.

        ``ops`` names what it holds. New keys go to the base while no delta could name
        them too; everything else is a delta. A change set holds whole rows, so the
        columns the source supplies do not matter here.
        """
        version, live, deltas = old.version + 1, old.live, old.deltas
        to_base = {INSERT} & set(ops) if not deltas else set()
        if to_base:
            new = changes.where(F.col(OP) == INSERT).select(*schema.names)
            live = (*live, self._write(new, old, version))
        if set(ops) - to_base:
            rest = changes.where(F.col(OP) != INSERT) if to_base else changes
            deltas = (*deltas, self._write_delta(rest, version))
        return replace(old, version=version, schema=schema, live=live, deltas=deltas)

    def compact(self) -> int:
        """Publish the same rows as one base without deltas; returns the version."""
        old = self.pointer()
        if old is None:
            raise ValueError(f"target table does not exist: {self.root}")
        if not old.deltas and len(old.live) < 2:
            return old.version
        live = (self._write(self.rows(old), old, old.version + 1),)
        self.commit(old.next_with(live=live, deltas=()))
        return old.version + 1

    def stage_first(self, old: Pointer, schema: T.StructType, rows: DataFrame) -> Pointer:
        """Fill an empty table: no join, one exchange into the bucket layout."""
        version = old.version + 1
        return replace(old, version=version, schema=schema, live=(self._write(rows, old, version),))

    def _partitions(self, pointer: Pointer) -> int:
        # A multiple of the bucket count keeps every task inside one bucket.
        return pointer.buckets * self.files_per_bucket

    def _write(self, rows: DataFrame, old: Pointer, version: int) -> str:
        """Write base rows into a folder of their own, one exchange into the layout."""
        folder = f"{version:012d}-{uuid.uuid4().hex[:12]}"
        laid_out = rows.repartition(self._partitions(old), *old.key)
        laid_out = laid_out.withColumn(BUCKET, bucket_of(old.key, old.buckets))
        # The write sorts by bucket anyway; the key on top keeps files small and skippable.
        laid_out = laid_out.sortWithinPartitions(BUCKET, *old.key)
        laid_out.write.partitionBy(BUCKET).parquet(self._path(folder))
        return folder

    def _write_delta(self, changes: DataFrame, version: int) -> str:
        """Write a change set in files of the size the session's settings advise."""
        folder = f"{version:012d}-{uuid.uuid4().hex[:12]}"
        rows = changes.withColumn(VERSION, F.lit(version).cast("long")).hint("rebalance")
        rows.write.parquet(self._path(folder))
        return folder

    def commit(self, pointer: Pointer) -> None:
        self.files.write_text(f"pointer/{pointer.version:012d}.json", pointer.to_json(), False)

    def expire(self, keep: int = 2) -> list[str]:
        """Delete data folders that none of the last ``keep`` versions use.

        Returns the folders deleted. Never run it while a sync is writing.
        """
        names = sorted(n for n in self.files.names("pointer") if n.endswith(".json"))
        recent = [Pointer.from_json(self.files.read_text(f"pointer/{n}")) for n in names[-keep:]]
        used = {f for p in recent for f in (*p.live, *p.deltas)}
        there = {name.removeprefix(f"{FOLDER}=") for name in self.files.names("data")}
        dropped = sorted(there - used)
        for folder in dropped:
            self.files.delete(f"data/{FOLDER}={folder}")
        for name in names[:-keep]:
            self.files.delete(f"pointer/{name}")
        return dropped

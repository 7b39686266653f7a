"""The shared folder of a session and the tables written there to cut lineage."""

from __future__ import annotations

import atexit
import logging
import uuid

from pyspark.sql import DataFrame, SparkSession

log = logging.getLogger(__name__)

CHECKPOINT_DIR = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by the cluster.

    Only a local session without the setting gets a folder of its own, in its warehouse.
    """
    path = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getConf().get(CHECKPOINT_DIR)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder shared by all executors")
        path = f"{spark.conf.get('spark.sql.warehouse.dir')}/scratch"
        spark.conf.set(CHECKPOINT_DIR, path)
    return path.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/tablesync/{label}-{uuid.uuid4().hex}"


_LIVE: list[Scratch] = []


@atexit.register
def _clear_all() -> None:
    for scratch in list(_LIVE):
        try:
            scratch.clear()
        except Exception as error:  # the session, or the cluster, may be gone by now
            log.debug("left behind: %s (%s)", scratch.paths, error)


class Scratch:
    """Tables of one run, written to the shared folder and dropped with ``clear``.

    Tables that a lazy result still reads cannot be dropped by the run itself; what is
    left of them goes when the program ends.

    A written table survives executor loss, is computed once however often it is
    read, and gives the planner its true size for broadcast decisions.
    """

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.paths: list[str] = []

    def write(self, df: DataFrame, label: str) -> DataFrame:
        path = self.path(label)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def path(self, label: str) -> str:
        """A folder that goes with the others."""
        if not self.paths:
            _LIVE.append(self)
        self.paths.append(scratch_path(self.spark, label))
        return self.paths[-1]

    def drop(self, path: str) -> None:
        """Delete one table that nothing reads any more."""
        SharedFiles(self.spark, path).delete()
        self.paths.remove(path)

    def clear(self) -> None:
        for path in list(self.paths):
            self.drop(path)
        if self in _LIVE:
            _LIVE.remove(self)


class SharedFiles:
    """Small text files and folders on whatever file system a path belongs to."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self._jvm = spark._jvm
        self._gateway = spark.sparkContext._gateway
        self._conf = spark._jsc.hadoopConfiguration()
        self.root = root.rstrip("/")
        self._fs = self._path().getFileSystem(self._conf)

    def _path(self, name: str = ""):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def exists(self, name: str = "") -> bool:
        return self._fs.exists(self._path(name))

    def names(self, name: str = "") -> list[str]:
        if not self.exists(name):
            return []
        return [status.getPath().getName() for status in self._fs.listStatus(self._path(name))]

    def read_text(self, name: str) -> str:
        stream = self._fs.open(self._path(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write_text(self, name: str, text: str, overwrite: bool) -> None:
        """Write beside the final name, then rename: readers never see half a file.

        Without ``overwrite`` an existing file makes the rename fail, which is how
        a second writer of the same version is stopped.
        """
        draft = f"{name}.{uuid.uuid4().hex}.tmp"
        stream = self._fs.create(self._path(draft), True)
        try:
            stream.write(bytearray(text, "utf-8"))
        finally:
            stream.close()
        rename = getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename")
        flags = self._gateway.new_array(rename, 1 if overwrite else 0)
        if overwrite:
            flags[0] = rename.OVERWRITE
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            self._path().toUri(), self._conf
        )
        context.rename(self._path(draft), self._path(name), flags)

    def delete(self, name: str = "") -> None:
        self._fs.delete(self._path(name), True)

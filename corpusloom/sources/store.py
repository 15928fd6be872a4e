"""Snapshot tables: each commit is a new folder, and an atomic pointer file names the current one."""

from __future__ import annotations

import time
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

POINTER, LOCK = "_CURRENT", "_LOCK"


class Locked(RuntimeError):
    """Another run holds the store."""


class Pointed:
    """A folder of any file system that Spark writes to, in which a pointer file names what is current, and one writer at a time has the lock."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def text_of(self, name: str) -> str | None:
        """The text of a small file below the folder."""
        p = self._path(f"{self.path}/{name}")
        if not self._fs.exists(p):
            return None
        stream = self._fs.open(p)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def current(self) -> str | None:
        name = self.text_of(POINTER)
        return None if name is None else name.strip()

    def put_text(self, name: str, text: str) -> None:
        """Write a small file; what was there is replaced by an atomic rename."""
        temp, final = self._path(f"{self.path}/.{uuid.uuid4().hex}"), self._path(f"{self.path}/{name}")
        out = self._fs.create(temp, True)
        out.write(bytearray(text.encode()))
        out.close()
        sc = self.spark.sparkContext
        options = sc._gateway.new_array(sc._jvm.org.apache.hadoop.fs.Options.Rename, 1)
        options[0] = sc._jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        sc._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), sc._jsc.hadoopConfiguration()).rename(temp, final, options)

    @contextmanager
    def lock(self):
        """One writer at a time: the lock file is created or the run stops."""
        p = self._path(f"{self.path}/{LOCK}")
        self._fs.mkdirs(self._path(self.path))
        if not self._fs.createNewFile(p):
            raise Locked(self.path)
        try:
            yield self
        finally:
            self._fs.delete(p, False)


def unreadable(e: Exception) -> bool:
    """Is it a file that is not Parquet, or is not there? Spark raises several kinds."""
    return "Parquet" in str(e) or "parquet" in str(e) or "PATH_NOT_FOUND" in str(e)


class SnapshotStore(Pointed):
    """A table of whole snapshots."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType | str):
        super().__init__(spark, path)
        self.schema = schema

    def read(self) -> DataFrame:
        """The current snapshot; empty with the table's schema before the first commit."""
        name = self.current()
        if name is None:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/{name}")

    def commit(self, df: DataFrame, sort: list[str] | None = None, version: str | None = None) -> str:
        """Write a snapshot and make it the current one; a version that is current already is not written again."""
        name = version or f"v-{int(time.time() * 1000)}-{uuid.uuid4().hex[:8]}"
        if version is not None and self.current() == name:
            return name
        (df.sortWithinPartitions(*sort) if sort else df).write.mode("overwrite").parquet(f"{self.path}/{name}")
        self.put_text(POINTER, name)
        return name

    def quarantine(self) -> str | None:
        """Set the current snapshot aside (it is kept under another name) and start empty."""
        name = self.current()
        if name is None:
            return None
        aside = f"{name}.corrupt-{int(time.time())}"
        self._fs.rename(self._path(f"{self.path}/{name}"), self._path(f"{self.path}/{aside}"))
        self._fs.delete(self._path(f"{self.path}/{POINTER}"), False)
        return aside

    def read_or_quarantine(self) -> DataFrame:
        """The snapshot if it can be read; else it is set aside and the table is empty."""
        try:
            df = self.read()
            df.count()  # reads the footers of all files
            return df
        except Exception as e:
            if not unreadable(e):
                raise
            self.quarantine()
            return self.spark.createDataFrame([], self.schema)

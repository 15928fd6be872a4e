"""Tables on the way: written once in the folder that driver and executors share, removed when nobody reads them any more."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: the session's spark.checkpoint.dir.

    Only a local master, whose executors are threads of the driver, gets a folder of our own where none is named.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if named:
        return named
    given = sc._jsc.sc().getCheckpointDir()
    if given.isEmpty():
        if not re.match(r"local(\[|\Z)", sc.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and the executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="corpusloom-"))
        given = sc._jsc.sc().getCheckpointDir()
    return given.get()


def _file_system(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def stored(df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
    """Write df once as Parquet in the shared folder and read it back: its lineage is cut, and lost executors cost nothing.

    rows: about how many rows it has, if that is known; few rows are not spread over many files. What nobody needs any more is given to
    `discard`; the rest goes when the driver ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/corpusloom/{name}-{uuid.uuid4().hex}"
    if rows is not None and rows < int(spark.conf.get("spark.sql.shuffle.partitions")) * ROWS_A_FILE:
        df = df.coalesce(max(1, -(-rows // ROWS_A_FILE)))
    df.write.parquet(path)
    at, fs = _file_system(spark, path)
    fs.deleteOnExit(at)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


#: Rows of a stored table below which another file is not worth it.
ROWS_A_FILE = 50_000


def discard(*tables: DataFrame) -> None:
    """Remove tables that `stored` wrote and that no plan reads any more."""
    for df in tables:
        at, fs = _file_system(df.sparkSession, df._stored_at)
        fs.delete(at, True)
        fs.cancelDeleteOnExit(at)


@contextmanager
def tidy(spark: SparkSession) -> Iterator[None]:
    """While an operator runs its own jobs, their shuffle files go as soon as each job has written its result."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


#: Bytes of an Arrow batch between Spark and a Python worker.
BATCH_BYTES = 4 << 20


def small_batches(df: DataFrame) -> DataFrame:
    """Sees to it that the session sends batches of at most BATCH_BYTES (or one row) to Python workers, so that long texts do not add
    up to batches of thousands; a smaller setting stays."""
    key, conf = "spark.sql.execution.arrow.maxBytesPerBatch", df.sparkSession.conf
    given = conf.get(key, "64m").lower()
    unit = given.rstrip("b").lstrip("0123456789")
    if int(given.rstrip("bkmgt") or -1) * {"": 1, "k": 1 << 10, "m": 1 << 20, "g": 1 << 30}.get(unit, 1 << 40) > BATCH_BYTES or given.startswith("-"):
        conf.set(key, str(BATCH_BYTES))
    return df


@contextmanager
def many_files(spark: SparkSession) -> Iterator[None]:
    """While jobs read very many small files: thousands of them are one task, as opening one is not reckoned like reading 4 MB. Small numbers still go to all cores."""
    key = "spark.sql.files.openCostInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, str(1 << 16))
    try:
        yield
    finally:
        spark.conf.set(key, before)

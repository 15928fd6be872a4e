"""Shared plumbing of the training-data operators."""

from __future__ import annotations

import ctypes
import gc
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.scratch import BATCH_BYTES, discard, shared_dir, small_batches, stored, tidy

__all__ = ["BATCH_BYTES", "WORD", "WORD_SQL", "crc_mod", "discard", "release", "shared_dir", "shuffle_partitions", "small_batches", "stored", "table", "tidy"]

#: A word is a maximal run of anything but ASCII white space.
WORD = re.compile("[^\x20\x09-\x0d]+")
#: The same as a Java / RE2 pattern, for expressions.
WORD_SQL = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_mod(doc_id: Column, m: int) -> Column:
    """crc32 of the id as text, modulo m (null id: null)."""
    return F.crc32(doc_id.cast("string").cast("binary")) % m


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


#: Bytes that a task has handled, below which its end is not worth a clean-up.
LITTLE = 8 << 20


def release(handled: int = LITTLE) -> None:
    """Give memory back at the end of a task: the worker process outlives it, and holds what Arrow and malloc keep for later."""
    import pyarrow as pa

    if handled < LITTLE:
        return
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass

"""Unattended incremental runs: a stream of feed rows folded into a keyed table, batch by batch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from ..operators.upsert import ranges_of, snapshot
from ..sources.keyed import KeyedStore


def upsert_stream(
    feed: DataFrame, store: KeyedStore, checkpoint: str, key: str, seq: str, at: str, hash_col: str, site: Sequence[str], carried: Sequence[str] = ()
) -> None:
    """Process what is available and stop; an external scheduler decides when to run again.

    Each micro-batch is one upsert, which reads the buckets of its keys and writes their new rows only. The batch number names the version that it
    commits, so a batch that is replayed after a failure is not applied twice.
    """

    def fold(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        stored = store.beside(batch) if store.current() else None
        store.commit(snapshot(batch, key, seq, at, hash_col, site, carried, stored, ranges_of(batch, key), untouched=False), name=f"batch-{batch_id}")
        batch.unpersist()

    with store.lock():
        query = feed.writeStream.foreachBatch(fold).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()
        if query.exception() is not None:
            raise query.exception()
        store.compact()

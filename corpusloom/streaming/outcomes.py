"""Outcomes of a feed as a stream: what each row does to its key, with the keys' last hashes as state of the engine."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.upsert import INSERTED, UNCHANGED, UPDATED

#: What is kept of a key: its last hash and where that stood in the feed.
STATE = "hash string, seq long"
#: The outcome of a key that was forgotten, at the time of which nobody had seen it for so long.
FORGOTTEN = "forgotten"


def with_outcomes(feed: DataFrame, key: str, seq: str, hash_col: str, at: str | None = None, idle: str | None = None) -> DataFrame:
    """A streaming feed → key, seq, outcome, in append mode; the same outcomes as `upsert.outcomes` gives for all rows at once.

    Rows of a key are ordered by seq within a micro-batch, which the source's trigger options bound; a row at or before the last one handled is a replay and
    gives nothing. seq: a long that grows from batch to batch, as a feed's does; equal hashes, also two nulls, are unchanged.
    at, idle: a key without a row for so long, by the event time in at, is forgotten with an outcome of its own (and would be inserted anew); a timer of the
    engine does this when the watermark passes, whether rows come or not.
    """
    kinds = {f.name: f.dataType.simpleString() for f in feed.schema}
    rows = feed.select(F.col(key).alias("key"), F.col(seq).cast("long").alias("seq"), F.col(hash_col).cast("string").alias("hash"), (F.col(at) if at else F.lit(None).cast("timestamp")).alias("at"))
    rows = rows.withWatermark("at", idle) if idle else rows
    pause = pd.Timedelta(idle).value // 1_000_000 if idle else 0

    def step(of: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            _, last = state.get
            state.remove()
            yield pd.DataFrame({"key": [of[0]], "seq": [last], "outcome": [FORGOTTEN]})
            return
        own = pd.concat(list(parts)).sort_values("seq", kind="stable")
        known = state.exists
        hash_, last = state.get if known else (None, None)
        own = own[own["seq"] > last] if known else own
        if own.empty:
            return
        outcomes = []
        for h in own["hash"]:
            h = None if pd.isna(h) else h
            outcomes.append(INSERTED if not known else UNCHANGED if h == hash_ else UPDATED)
            known, hash_ = True, h
        state.update((hash_, int(own["seq"].iloc[-1])))
        if idle:
            latest = own["at"].max()
            state.setTimeoutTimestamp(max(int(latest.value // 1_000_000) + pause, state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame({"key": own["key"], "seq": own["seq"], "outcome": outcomes})

    timeout = GroupStateTimeout.EventTimeTimeout if idle else GroupStateTimeout.NoTimeout
    out = rows.groupBy("key").applyInPandasWithState(step, f"key {kinds[key]}, seq long, outcome string", STATE, "append", timeout)
    return out.select(F.col("key").alias(key), F.col("seq").alias(seq), "outcome")


def write_outcomes(outcomes: DataFrame, path: str, checkpoint: str) -> None:
    """Write what is available and stop. The checkpoint holds the state, so that the next call goes on, and a batch that was lost is done again once."""
    query = outcomes.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()

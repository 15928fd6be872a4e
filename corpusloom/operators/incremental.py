"""What changed since the last run, piece by piece, and what has to leave the index."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Piece → its hash in records and state, and its chunk count in the state (the metadata card is one chunk).
PIECES = {
    "metadata": ("content_hash", None),
    "judgment_pdf": ("judgment_pdf_sha256", "judgment_chunk_count"),
    "sc_judgment_pdf": ("sc_judgment_pdf_sha256", "sc_judgment_chunk_count"),
}


def changed_pieces(records: DataFrame, state: DataFrame, hashes: Sequence[str], key: str = "id") -> DataFrame:
    """records ⟕ state → key, one boolean <hash>_changed per hash (NULL equals NULL), and is_new.

    Only keys and hashes are shuffled; the join stands before any chunking or embedding.
    """
    s = state.select(F.col(key), *(F.col(h).alias("_s_" + h) for h in hashes), F.lit(True).alias("_known"))
    joined = records.select(key, *hashes).join(s, key, "left")
    return joined.select(key, *((~F.col(h).eqNullSafe(F.col("_s_" + h))).alias(h + "_changed") for h in hashes), F.col("_known").isNull().alias("is_new"))


def pending_documents(records: DataFrame, state: DataFrame) -> DataFrame:
    """(record_id, kind, sha256) of the documents to convert: their hash is known and differs from the state."""
    known = state.select("id", *(F.col(h).alias("_s_" + h) for h, _ in PIECES.values()))
    joined = records.join(known, "id", "left")
    kinds = [F.struct(F.lit(k).alias("kind"), F.col(h).alias("sha256"), F.col("_s_" + h).alias("old")) for k, (h, n) in PIECES.items() if n]
    rows = joined.select(F.col("id").alias("record_id"), F.explode(F.array(*kinds)).alias("p")).select("record_id", "p.*")
    return rows.where(F.col("sha256").isNotNull() & ~F.col("sha256").eqNullSafe(F.col("old"))).drop("old")


def trailing_chunks(index: DataFrame, counts: DataFrame, keys: Sequence[str] = ("record_id", "chunk_type")) -> DataFrame:
    """Index rows at or beyond the new count of their document: (keys, n_chunks) → what a shrunk document leaves behind."""
    return index.join(counts.select(*keys, "n_chunks"), list(keys)).where(F.col("chunk_index") >= F.col("n_chunks")).drop("n_chunks")


def replaced(index: DataFrame, fresh: DataFrame, dropped: DataFrame | None = None, key: str = "chunk_id") -> DataFrame:
    """Insert or replace by key, without the dropped rows."""
    kept = index.join(fresh.select(key), key, "left_anti")
    if dropped is not None:
        kept = kept.join(dropped.select(key), key, "left_anti")
    return kept.unionByName(fresh)


def vanished(index: DataFrame, records: DataFrame) -> DataFrame:
    """Index rows of documents whose record has lost its file (an explicit tombstone pass, off by default)."""
    kinds = [F.struct(F.lit(k).alias("chunk_type"), F.col(h).alias("sha")) for k, (h, n) in PIECES.items() if n]
    live = records.select(F.col("id").alias("record_id"), F.explode(F.array(*kinds)).alias("p")).where("p.sha IS NOT NULL").select("record_id", "p.chunk_type")
    return index.where("chunk_type <> 'metadata'").join(live, ["record_id", "chunk_type"], "left_anti")


def next_state(records: DataFrame, state: DataFrame, committed: DataFrame) -> DataFrame:
    """State after a run. committed: (record_id, chunk_type, n_chunks) of the pieces that went into the index, empty ones too.

    A piece takes its record's hash only if it was committed; any other keeps its old hash and count, so that a document whose
    text is not there yet, or whose conversion failed, is tried again by the next run. States of records that are gone stay.
    """
    done = committed.groupBy(F.col("record_id").alias("id")).agg(*(F.max(F.when(F.col("chunk_type") == k, F.col("n_chunks"))).cast("int").alias("_n_" + k) for k in PIECES))
    hashes, counts = [h for h, _ in PIECES.values()], [c for _, c in PIECES.values() if c]
    old = state.select("id", *(F.col(c).alias("_s_" + c) for c in (*hashes, *counts)))
    both = records.select("id", *hashes).join(done, "id", "left").join(old, "id", "full_outer")
    new = {k: F.col("_n_" + k).isNotNull() for k in PIECES}
    return both.select(
        "id",
        *(F.when(new[k], F.col(h)).otherwise(F.col("_s_" + h)).alias(h) for k, (h, _) in PIECES.items()),
        *(F.coalesce("_n_" + k, "_s_" + c).alias(c) for k, (_, c) in PIECES.items() if c),
    )


def run_counters(records: DataFrame, committed: DataFrame, failed: DataFrame, uploaded: DataFrame) -> DataFrame:
    """One row: records seen, pieces committed by kind, links that are new for the first kind of document, records that nothing was done
    for, records with an error. committed: (record_id, chunk_type); failed, uploaded: (record_id); repeated rows count once."""
    by_record = committed.groupBy("record_id").agg(*(F.count_if(F.col("chunk_type") == k).alias("_" + k) for k in PIECES))
    flag = lambda df, name: df.select("record_id").distinct().withColumn(name, F.lit(True))
    rows = records.select(F.col("id").alias("record_id")).join(by_record, "record_id", "left").join(flag(failed, "_failed"), "record_id", "left").join(flag(uploaded, "_uploaded"), "record_id", "left")
    done = sum((F.coalesce("_" + k, F.lit(0)) for k in PIECES), F.lit(0)) > 0
    return rows.agg(
        F.count("*").alias("records_seen"),
        *(F.count_if(F.col("_" + k) > 0).alias(k + "_ingested") for k in PIECES),
        F.count_if("_uploaded").alias("gdrive_uploaded"),
        F.count_if(~done & F.col("_failed").isNull()).alias("unchanged"),
        F.count_if("_failed").alias("errors"),
    )


def outcome_rows(records: DataFrame, state: DataFrame, committed: DataFrame, failed: DataFrame, uploaded: DataFrame) -> DataFrame:
    """One row a record: its new state, and what the run did for it: done_<kind>, failed, uploaded. Arguments as in `next_state` and `run_counters`.

    The rows whose done_<kind> is true anywhere are what changes in the state; `counters_of` counts the run from the same rows.
    """
    new = next_state(records, state, committed)
    done = committed.groupBy(F.col("record_id").alias("id")).agg(*(F.count_if(F.col("chunk_type") == k).alias("_d_" + k) for k in PIECES))
    flag = lambda df, name: df.select(F.col("record_id").alias("id")).distinct().withColumn(name, F.lit(True))
    rows = records.select("id").join(new, "id", "left").join(done, "id", "left").join(flag(failed, "failed"), "id", "left").join(flag(uploaded, "uploaded"), "id", "left")
    no = F.lit(False)
    return rows.select(*new.columns, *((F.coalesce("_d_" + k, F.lit(0)) > 0).alias("done_" + k) for k in PIECES), F.coalesce("failed", no).alias("failed"), F.coalesce("uploaded", no).alias("uploaded"))


def any_done() -> Column:
    return reduce(Column.__or__, [F.col("done_" + k) for k in PIECES])


def counters_of() -> list[Column]:
    """The counters of `run_counters` as aggregates over `outcome_rows`: to be observed while these are written."""
    return [
        F.count("*").alias("records_seen"),
        *(F.count_if("done_" + k).alias(k + "_ingested") for k in PIECES),
        F.count_if("uploaded").alias("gdrive_uploaded"),
        F.count_if(~any_done() & ~F.col("failed")).alias("unchanged"),
        F.count_if("failed").alias("errors"),
    ]

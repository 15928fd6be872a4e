"""End-to-end plans: ingest a run, answer a question."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..config import Settings
from ..embedding import Answerer, Embedder, Extractive, HashedWords, embedding_column
from ..functions.text import blank_to_null
from ..operators.chunking import chunk_texts, document_chunks, metadata_chunks
from ..operators.incremental import any_done, changed_pieces, counters_of, next_state, outcome_rows, pending_documents, replaced, run_counters, trailing_chunks, vanished
from ..operators.parallel_packing import chunk_long_texts
from ..operators.retrieval import checked_top_k, chunk_type_filter, sources, top_k
from ..sources.keyed import KeyedStore
from ..sources.scratch import discard, stored


def linked_records(records: DataFrame, links: DataFrame) -> DataFrame:
    """records with the links of their documents where they have none: links (sha256, view_url) of what was published."""
    for kind in ("judgment", "sc_judgment"):
        url = f"{kind}_gdrive_view_url"
        own = links.groupBy(F.col("sha256").alias("_sha")).agg(F.min("view_url").alias("_url"))
        records = records.join(own, F.col(f"{kind}_pdf_sha256") == F.col("_sha"), "left").withColumn(url, F.coalesce(blank_to_null(F.col(url)), "_url")).drop("_sha", "_url")
    return records


def _parts(
    records: DataFrame, texts: DataFrame, index: DataFrame, state: DataFrame, run_ts: Column, settings: Settings, embedder: Embedder | None, links: DataFrame | None, tombstones: bool, keep: Callable[[DataFrame], DataFrame] = lambda df: df,
    chunker: Callable[..., DataFrame] = chunk_texts,
) -> dict[str, DataFrame]:
    """What one run finds: the records with links, fresh chunks, dropped ones, committed pieces, failures, new links. keep: is given the fresh
    chunks, from which the rest is counted. chunker: see `document_chunks`."""
    embedder = embedder or HashedWords(settings.embedding_dim)
    before = records
    records = linked_records(records, links) if links is not None else records
    error = F.col("error") if "error" in texts.columns else F.lit(None).cast("string")
    changed = changed_pieces(records, state, ["content_hash"]).where("content_hash_changed").select("id")
    meta = metadata_chunks(records.join(changed, "id", "left_semi"))
    pending = pending_documents(records, state)
    asked = texts.select("record_id", "kind", "text", error.alias("error")).join(pending.select("record_id", "kind"), ["record_id", "kind"], "left_semi")
    docs = asked.where("error IS NULL AND text IS NOT NULL")
    body = document_chunks(docs, settings.chunk_words, settings.overlap_words, chunker)
    fresh = keep(meta.unionByName(body).withColumn("embedding", embedding_column(embedder, F.col("text"))).withColumn("ingested_at", run_ts))
    counts = fresh.where("chunk_type <> 'metadata'").groupBy("record_id", "chunk_type").agg(F.count("*").alias("n_chunks"))
    emptied = docs.select("record_id", F.col("kind").alias("chunk_type")).distinct().join(counts, ["record_id", "chunk_type"], "left").select("record_id", "chunk_type", F.coalesce("n_chunks", F.lit(0)).alias("n_chunks"))
    committed = emptied.unionByName(changed.select(F.col("id").alias("record_id"), F.lit("metadata").alias("chunk_type"), F.lit(1).cast("long").alias("n_chunks")))
    dropped = trailing_chunks(index, emptied)
    dropped = dropped.unionByName(vanished(index, records)) if tombstones else dropped
    was, now = (df.select(F.col("id").alias("record_id"), blank_to_null(F.col("judgment_gdrive_view_url")).alias("url")) for df in (before, records))
    uploaded = now.where("url IS NOT NULL").join(was.where("url IS NOT NULL"), "record_id", "left_anti")
    return {"records": records, "fresh": fresh, "dropped": dropped, "committed": committed, "failed": asked.where("error IS NOT NULL"), "uploaded": uploaded}


def ingest(
    records: DataFrame, texts: DataFrame, index: DataFrame, state: DataFrame, run_ts: Column, settings: Settings = Settings(), embedder: Embedder | None = None, links: DataFrame | None = None, tombstones: bool = False
) -> dict[str, DataFrame]:
    """One incremental run → the new index and state, the records with their links, and counters.

    records: the store; texts (record_id, kind, text and, if conversions are reported, error): converted documents; index: chunks with embedding and
    ingested_at; links: see `linked_records`. Only changed pieces are chunked and embedded; a second run over the same input changes
    nothing. The state advances piece by piece, for what was committed: a document without a text, or with an error, is pending again
    in the next run, and its record's other pieces are not held up. tombstones: chunks of documents that are gone leave the index.
    """
    p = _parts(records, texts, index, state, run_ts, settings, embedder, links, tombstones)
    stats = run_counters(p["records"], p["committed"], p["failed"], p["uploaded"])
    return {"index": replaced(index, p["fresh"], p["dropped"]), "state": next_state(p["records"], state, p["committed"]), "records": p["records"], "fresh": p["fresh"], "dropped": p["dropped"], "stats": stats}


def ingest_into(stores: dict[str, KeyedStore], texts: DataFrame, run_ts: Column, settings: Settings = Settings(), embedder: Embedder | None = None, links: DataFrame | None = None, tombstones: bool = False) -> dict:
    """`ingest` over the stores (records, index, state, dead), each part evaluated once; the counters, which are observed while the outcome of each record is written.

    Fresh chunks are embedded and written once; the index, the state and the records get what changed. The state comes after the index, so a run that
    is lost in between is done again, with the same chunks. What failed is kept in dead until its text is there.
    """
    records, index, state = (stores[k].read() for k in ("records", "index", "state"))
    kept: list[DataFrame] = []

    def keep(df: DataFrame) -> DataFrame:
        kept.append(stored(df, "fresh-chunks"))
        return kept[0]

    p = _parts(records, texts, index, state, run_ts, settings, embedder, links, tombstones, keep, chunk_long_texts)
    stores["index"].commit(p["fresh"], p["dropped"])
    if links is not None:
        names = [f.name for f in stores["records"].schema]
        old = records.select("id", *(F.col(c).alias("_" + c) for c in names if c.endswith("_view_url")))
        same = [F.col(c).eqNullSafe(F.col("_" + c)) for c in names if c.endswith("_view_url")]
        stores["records"].commit(p["records"].join(old, "id").where(~reduce(Column.__and__, same)).select(*names))
    seen = Observation(f"ingest-{uuid.uuid4().hex}")
    rows = stored(outcome_rows(p["records"], state, p["committed"], p["failed"], p["uploaded"]).observe(seen, *counters_of()), "outcomes")
    stores["state"].commit(rows.where(any_done()).select(*(f.name for f in stores["state"].schema)))
    item = F.concat_ws("/", "kind", "record_id").alias("item")
    done = p["committed"].select(F.lit("conversion").alias("step"), F.concat_ws("/", "chunk_type", "record_id").alias("item"))
    stores["dead"].commit(p["failed"].select(F.lit("conversion").alias("step"), item, "error", run_ts.alias("failed_at")).dropDuplicates(["item"]), done)
    discard(rows, *kept)
    return seen.get


def retrieve(index: DataFrame, records: DataFrame, question: str, k: int | None = None, chunk_type: str | None = None, settings: Settings = Settings(), embedder: Embedder | None = None) -> DataFrame:
    """The k best chunks for a question, numbered, with the record's current attributes joined at query time."""
    if not question:
        raise ValueError("question must not be empty")
    k = checked_top_k(settings.top_k if k is None else k, settings.max_top_k)
    keep = chunk_type_filter(chunk_type)
    embedder = embedder or HashedWords(settings.embedding_dim)
    hits = top_k(index.where(keep), embedder.embed([question])[0].tolist(), k)
    attributes = records.select(F.col("id").alias("record_id"), "case_info", "year", "category", "decision_date", "judgment_pdf_url", "sc_judgment_pdf_url")
    link = F.when(F.col("chunk_type") == "judgment_pdf", F.col("judgment_pdf_url")).when(F.col("chunk_type") == "sc_judgment_pdf", F.col("sc_judgment_pdf_url")).otherwise(F.lit(settings.base_url))
    return hits.join(attributes, "record_id", "left").withColumn("source_url", link)


def answer(hits: DataFrame, question: str, answerer: Answerer | None = None) -> dict:
    """The reply and its sources; hits are at most the k rows of one question."""
    rows = [r.asDict() for r in hits.orderBy("rank").collect()]
    cited = [r.asDict() for r in sources(hits).orderBy("citation").collect()]
    return {"answer": (answerer or Extractive()).answer(question, rows), "sources": cited}

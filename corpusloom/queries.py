"""The registered queries of the ingestion and retrieval operators over the driver's tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .embedding import PlainPages, extracted, published
from .functions import arrays, hashing, text, vectors
from .operators import audit, chunking, incremental, maintained, merkle, migrate, parallel_packing, pruned, retrieval, summary, upsert
from .plans.service import convert_documents
from .sources.downloads import write_files
from .sources.files import binary_files, page_texts, text_listing, to_convert, whole_texts
from .sources.html import anchors, listing_records, page_shortfalls
from .sources.json_array import read_json_array, split_bytes
from .sources.keyed import KeyedStore
from .sources.layout import BucketedTable
from .sources.scratch import many_files, shared_dir, small_batches, stored
from .streaming.ingest import upsert_stream
from .streaming.outcomes import with_outcomes, write_outcomes

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def labelled(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", *columns).join(table(spark, sf_dir, "labels"), "doc_id", "left")


# Hashes, cards, identifiers


@query
def content_hash(spark, sf_dir):
    fields = ("text", "lang", "source", "n_chars", "quality", "toxic")
    return labelled(spark, sf_dir, *fields[:4]).select("doc_id", hashing.content_hash(*map(F.col, fields)).alias("content_hash"))


@query
def metadata_card(spark, sf_dir):
    card = text.metadata_card(*map(F.col, ("source", "n_chars", "lang", "quality", "toxic")), F.lit(""), F.lit(None), F.col("text"))
    return labelled(spark, sf_dir, "source", "n_chars", "lang", "text").select("doc_id", card.alias("card"), hashing.chunk_hash(card).alias("chunk_hash"))


@query
def chunk_uuid(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", hashing.uuid5(F.concat(F.col("doc_id").cast("string"), F.lit("::metadata"))).alias("chunk_uuid"))


# Chunks


@query
def chunk_hard_split(spark, sf_dir):
    chunks = chunking.hard_split(table(spark, sf_dir, "documents").select("doc_id", "text"), "text", 380, 60)
    return chunks.select("doc_id", "chunk_index", F.size(F.split("text", " ")).alias("n_words"), "chunk_hash")


@query
def chunk_pack(spark, sf_dir):
    chunks = chunking.chunk_texts(table(spark, sf_dir, "documents").select("doc_id", "text"), "text", 380, 60, r"\n")
    return chunks.select("doc_id", "chunk_index", F.size(F.split("text", " ")).alias("n_words"), "chunk_hash")


@query
def chunk_pack_blocks(spark, sf_dir):
    """A hundred documents each as one text, of many hundred lines, whose blocks of 400 lines are packed side by side."""
    joined = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("doc_id", "text"))), lambda x: x["text"]), "\n")
    texts = table(spark, sf_dir, "documents").groupBy(F.floor(F.col("doc_id") / 100).alias("hundred")).agg(joined.alias("text"))
    chunks = parallel_packing.chunk_long_texts(texts.select(F.col("hundred").alias("doc_id"), "text"), "text", 380, 60, r"\n", block=400)
    return chunks.select("doc_id", "chunk_index", F.size(F.split("text", " ")).alias("n_words"), "chunk_hash")


@query
def snippet(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.snippet(F.col("text")).alias("snippet"))


@query
def context_block(spark, sf_dir):
    """The three longest documents of each language as one cited context."""
    from pyspark.sql import Window

    w = Window.partitionBy("lang").orderBy(F.desc("n_chars"), "doc_id")
    hits = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars").withColumn("rank", F.row_number().over(w)).where("rank <= 3")
    hits = hits.join(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")
    return retrieval.context_blocks(hits, "lang", "rank", "doc_id", "source", "text")


@query
def page_concat(spark, sf_dir):
    """Documents as pages of records of five; a page of poor quality has no text of its own but an OCR text."""
    pages = labelled(spark, sf_dir, "text", "source").select(F.floor(F.col("doc_id") / 5).alias("record"), (F.col("doc_id") % 5).alias("page"), F.when(F.coalesce("quality", F.lit(1)) == 1, F.col("text")).otherwise(F.lit("  ")).alias("own"), "source")
    return page_texts(pages, "record", "page", F.col("own"), F.col("source")).select("record", F.sha2("text", 256).alias("text_sha"), "any_ocr")


# Upserts and incremental runs


@query
def upsert_outcomes(spark, sf_dir):
    feed = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    return upsert.outcomes(feed, "user_id", "event_id", "event_type", ranges=upsert.ranges_of(feed, "user_id")).select("event_id", "user_id", "outcome")


def _feed(events: DataFrame) -> DataFrame:
    return events.select("user_id", "event_id", F.col("ts").alias("at"), "event_type", "value", F.col("props").alias("path"))


@query
def upsert_snapshot(spark, sf_dir):
    feed = _feed(table(spark, sf_dir, "events"))
    return upsert.snapshot(feed, "user_id", "event_id", "at", "event_type", ["event_type", "value"], ["path"], ranges=upsert.ranges_of(feed, "user_id"))


@query
def stream_ingest(spark, sf_dir):
    """The same snapshot from a stream of the file, folded batch by batch into a store."""
    events = table(spark, sf_dir, "events")
    root = f"{shared_dir(spark)}/corpusloom/stream-{uuid.uuid4().hex}"
    stream = _feed(spark.readStream.schema(events.schema).parquet(f"{sf_dir}/events.parquet*"))  # a pattern: a plain path would have to be a folder
    kind = {f.name: f.dataType for f in stream.schema}
    names = {"user_id": "user_id", "event_type": "event_type", "value": "value", "path": "path", "first_seen_at": "at", "last_seen_at": "at", "updated_at": "at"}
    store = KeyedStore(spark, f"{root}/snapshot", T.StructType([T.StructField(name, kind[of]) for name, of in names.items()]), "user_id")
    upsert_stream(stream, store, f"{root}/checkpoint", "user_id", "event_id", "at", "event_type", ["event_type", "value"], ["path"])
    return store.read()


@query
def stream_outcomes(spark, sf_dir):
    """The outcomes of the events as a stream in three batches, ten days each; the query is started anew for the last one, and goes on where it was."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts")
    at = f"{shared_dir(spark)}/corpusloom/outcomes-{uuid.uuid4().hex}"
    for k in range(3):
        events.where(F.least(F.floor((F.dayofmonth("ts") - 1) / 10), F.lit(2)) == k).write.mode("append").parquet(f"{at}/feed")
        if k:
            stream = spark.readStream.schema(events.schema).parquet(f"{at}/feed")
            write_outcomes(with_outcomes(stream, "user_id", "event_id", "event_type"), f"{at}/out", f"{at}/checkpoint")
    return spark.read.parquet(f"{at}/out").select("event_id", "user_id", "outcome")


@query
def store_versions(spark, sf_dir):
    """The keyed store after each of three batches of events, ten days each: a user's last event replaces the row, a logout deletes it. Between the
    batches worn buckets are rewritten; every version is still read as it was."""
    events = _feed(table(spark, sf_dir, "events")).select("user_id", "event_id", "event_type", "value", F.least(F.floor((F.dayofmonth("at") - 1) / 10), F.lit(2)).alias("batch"))
    store = KeyedStore(spark, f"{shared_dir(spark)}/corpusloom/versions-{uuid.uuid4().hex}", events.drop("batch").schema, "user_id")
    states = []
    for k in range(3):
        last = upsert.last_per_key(events.where(F.col("batch") == k), "user_id", F.col("event_id"))
        version = store.commit(last.where("event_type <> 'logout'"), last.where("event_type = 'logout'"))
        states.append(store.read(version).withColumn("batch", F.lit(k)))
        store.compact()
    return states[0].union(states[1]).union(states[2])


@query
def maintained_totals(spark, sf_dir):
    """Users and the sum of their values by their last event, kept through three batches of events: each folds in what it changed."""
    cents = F.round(F.col("value") * 100).cast("long").alias("cents")
    events = _feed(table(spark, sf_dir, "events")).select("user_id", "event_id", "event_type", cents, F.least(F.floor((F.dayofmonth("at") - 1) / 10), F.lit(2)).alias("batch"))
    at = f"{shared_dir(spark)}/corpusloom/totals-{uuid.uuid4().hex}"
    schema = events.drop("batch").schema
    store, totals = KeyedStore(spark, f"{at}/users", schema, "user_id"), maintained.totals_store(spark, f"{at}/totals", schema, ["event_type"], ["cents"])
    for k in range(3):
        last = upsert.last_per_key(events.where(F.col("batch") == k), "user_id", F.col("event_id")).drop("batch")
        store.commit(last.where("event_type <> 'logout'"), last.where("event_type = 'logout'"))
        maintained.follow(store, totals, ["event_type"], ["cents"])
        store.compact()
    maintained.follow(store, totals, ["event_type"], ["cents"])
    return totals.read()


@query
def last_record(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "value")
    return upsert.last_per_key(events, "user_id", F.col("event_id"))


@query
def sorted_store(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.year("o_orderdate").alias("year"))
    return summary.sorted_rank(orders, ["year", "o_orderkey"], int(spark.conf.get("spark.sql.shuffle.partitions"))).select("o_orderkey", "year", "rank")


def _states(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Records, and an earlier state of the labelled ones: stale where the label says quality 0."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("sha"), "lang").join(table(spark, sf_dir, "labels"), "doc_id", "left")  # hashed before they are moved
    records = docs.select("doc_id", F.col("sha").alias("text_sha"), hashing.content_hash(F.col("lang"), F.col("quality")).alias("meta_sha"))
    known = docs.where("quality IS NOT NULL")
    state = known.select(
        "doc_id", F.when(F.col("quality") == 1, F.col("sha")).alias("text_sha"), F.when(F.col("toxic") == 1, F.lit("old")).otherwise(hashing.content_hash(F.col("lang"), F.col("quality"))).alias("meta_sha")
    )
    return records, state


@query
def incremental_diff(spark, sf_dir):
    records, state = _states(spark, sf_dir)
    return incremental.changed_pieces(records, state, ["text_sha", "meta_sha"], "doc_id")


@query
def copartitioned_diff(spark, sf_dir):
    """The same comparison of tables that are bucketed by the id, records in partitions: the join has no exchange."""
    records, state = _states(spark, sf_dir)
    records = records.join(table(spark, sf_dir, "documents").select("doc_id", "lang"), "doc_id")
    run = uuid.uuid4().hex
    at = f"{shared_dir(spark)}/corpusloom/layout-{run}"
    stored_records = BucketedTable(spark, f"records_{run}", f"{at}/records", records.schema, "doc_id", "lang")
    stored_state = BucketedTable(spark, f"state_{run}", f"{at}/state", state.schema, "doc_id")
    stored_records.overwrite(records)
    stored_state.overwrite(state)
    return incremental.changed_pieces(stored_records.read(), stored_state.read(), ["text_sha", "meta_sha"], "doc_id")


@query
def merkle_diff(spark, sf_dir):
    """The documents and an altered copy of them, stored by key ranges: what was added, removed or changed, from the ranges whose hashes differ."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    part = F.col("doc_id") % 1000
    altered = docs.where(~part.between(20, 24)).withColumn("text", F.when(part < 10, F.concat("text", F.lit("!"))).otherwise(F.col("text")))
    altered = altered.unionByName(docs.where(part.between(30, 34)).withColumn("doc_id", -F.col("doc_id")))
    at = f"{shared_dir(spark)}/corpusloom/merkle-{uuid.uuid4().hex}"
    bounds = merkle.range_bounds(docs, "doc_id")
    merkle.write_ranges(docs, "doc_id", f"{at}/old", bounds)
    merkle.write_ranges(altered, "doc_id", f"{at}/new", bounds)
    return merkle.changes(spark, f"{at}/old", f"{at}/new", "doc_id", docs.schema)


@query
def shrink_delete(spark, sf_dir):
    """Chunks of the finer cut that the coarser one leaves behind. How many the coarser one has follows from the number of words, so nothing is
    cut twice, and only what is left behind is hashed."""
    cut = arrays.bound(text.words(F.col("text")), lambda w: F.struct(chunking.window_count(w, 760, 60).alias("n"), chunking.windows(w, 380, 60).alias("chunks")))
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("record_id"), cut.alias("cut"))
    rows = docs.select("record_id", "cut.n", F.posexplode("cut.chunks").alias("chunk_index", "text"))
    return rows.where(F.col("chunk_index") >= F.col("n")).select("record_id", "chunk_index", hashing.chunk_hash(F.col("text")).alias("chunk_hash"))


def _chunk_rows(docs: DataFrame, target: int) -> DataFrame:
    rows = chunking.hard_split(docs.select(F.col("doc_id").cast("string").alias("record_id"), F.lit("judgment_pdf").alias("chunk_type"), "text"), "text", target, 60)
    return rows.select(F.concat_ws("::", "record_id", "chunk_type", F.col("chunk_index").cast("string")).alias("chunk_id"), "record_id", "chunk_type", "chunk_index", "chunk_hash")


@query
def index_upsert(spark, sf_dir):
    """Documents of good quality come anew, cut coarser: their chunks replace the old ones, and the old ones beyond go."""
    docs = labelled(spark, sf_dir, "text")
    index, fresh = _chunk_rows(docs, 380), _chunk_rows(docs.where("quality = 1"), 760)
    counts = fresh.groupBy("record_id", "chunk_type").agg(F.count("*").alias("n_chunks"))
    return incremental.replaced(index, fresh, incremental.trailing_chunks(index, counts)).select("chunk_id", "chunk_hash")


@query
def vanished_chunks(spark, sf_dir):
    """Chunks of the documents whose record has no file any more."""
    docs, (records, _) = table(spark, sf_dir, "documents"), _ingested(spark, sf_dir)
    return incremental.vanished(_chunk_rows(docs, 380), records).select("chunk_id")


def _ingested(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Records with a card and up to two documents, and the state of an earlier run that knew the labelled ones."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("text_sha"), "lang", "source", "n_chars").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    card, sha = hashing.content_hash(F.col("lang"), F.col("quality")), F.when(F.col("lang") != "es", F.col("text_sha"))
    key = F.col("doc_id").cast("string").alias("id")
    records = docs.select(key, card.alias("content_hash"), sha.alias("judgment_pdf_sha256"), F.when(F.col("toxic") == 1, F.sha2("source", 256)).alias("sc_judgment_pdf_sha256"), "n_chars", "quality")
    good, none = F.col("quality") == 1, F.lit(None)
    state = docs.where("quality IS NOT NULL").select(
        key, F.when(F.col("toxic") == 1, F.lit("old")).otherwise(card).alias("content_hash"), F.when(good, sha).alias("judgment_pdf_sha256"), none.cast("string").alias("sc_judgment_pdf_sha256"),
        F.when(good, 9).alias("judgment_chunk_count"), none.cast("int").alias("sc_judgment_chunk_count"),
    )
    return records, state


def _committed(records: DataFrame, state: DataFrame) -> DataFrame:
    """What a run put into the index: changed cards, and pending documents whose text is there (an even number of characters)."""
    cards = incremental.changed_pieces(records, state, ["content_hash"]).where("content_hash_changed").select(F.col("id").alias("record_id"), F.lit("metadata").alias("chunk_type"), F.lit(1).cast("long").alias("n_chunks"))
    texts = records.where("n_chars % 2 = 0").select(F.col("id").alias("record_id"), F.col("n_chars").alias("n_chunks"))
    docs = incremental.pending_documents(records, state).join(texts, "record_id").select("record_id", F.col("kind").alias("chunk_type"), "n_chunks")
    return cards.union(docs)


@query
def chunk_filter(spark, sf_dir):
    """Chunks of exactly one type, of an index that holds cards and both kinds of documents."""
    docs = labelled(spark, sf_dir, "text")
    kind = F.when(F.col("toxic") == 1, "sc_judgment_pdf").otherwise("judgment_pdf")
    chunks = _chunk_rows(docs, 380).join(docs.select(F.col("doc_id").cast("string").alias("record_id"), kind.alias("kind")), "record_id").withColumn("chunk_type", F.col("kind"))
    cards = docs.select(F.col("doc_id").cast("string").alias("record_id"), F.lit("metadata").alias("chunk_type"), F.lit(0).alias("chunk_index"))
    index = chunks.select("record_id", "chunk_type", "chunk_index").unionByName(cards)
    return index.where(retrieval.chunk_type_filter("judgment_pdf"))


@query
def stale_texts(spark, sf_dir):
    """Orders as files and their line items as texts: what is newer than its text, or has none, is to be converted."""
    key, kind = F.col("o_orderkey").cast("string"), F.lit("judgment_pdf").alias("kind")
    orders = table(spark, sf_dir, "orders").select(key.alias("record_id"), kind, key.alias("path"), (F.col("o_orderkey") % 10).alias("length"), F.col("o_orderdate").alias("modificationTime"))
    lines = table(spark, sf_dir, "lineitem").where("l_linenumber = 1").select(F.col("l_orderkey").cast("string").alias("record_id"), kind, F.timestamp_add("DAY", F.lit(-60), "l_shipdate").alias("modificationTime"))
    return to_convert(orders.select("record_id", "kind", "path"), orders.select("path", "length", "modificationTime"), lines).select("record_id", "kind")


@query
def published_links(spark, sf_dir):
    """One link for each content: the cached one where the document was known, else one made from its hash."""
    files = labelled(spark, sf_dir, "text").select(F.sha2("text", 256).alias("sha256"), F.concat(F.col("doc_id").cast("string"), F.lit(".pdf")).alias("name"), "quality")
    cache = files.where("quality = 1").groupBy("sha256").agg(F.lit("known").alias("file_id"), F.lit("https://old.example/x").alias("view_url"), F.min("name").alias("name"))
    return published(files.select("sha256", "name"), cache, "https://files.example")


class LinePages:
    """An extractor to try the plan with: the lines of a text are its pages, and a text without a sentence's end is broken."""

    def pages(self, content: bytes) -> list[str]:
        if b"." not in content:
            raise ValueError("broken")
        return content.decode().split("\n")


@query
def extract_pages(spark, sf_dir):
    """Files to pages; a broken file is a row with its error, and no failed task."""
    files = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("path"), F.col("text").cast("binary").alias("content"))
    return extracted(files, LinePages()).select("path", "page", F.sha2("text", 256).alias("text_sha"), "error")


@query
def converted_texts(spark, sf_dir):
    """Pages written as files of two pages each, converted to text files, and these read back; and which of them another run would convert."""
    at = f"{shared_dir(spark)}/corpusloom/convert-{uuid.uuid4().hex}"
    key, kind = F.col("page_id").cast("string"), F.lit("judgment_pdf")
    made = table(spark, sf_dir, "pages").select(key.alias("record_id"), kind.alias("kind"), F.concat(F.lit("files/"), key, F.lit(".pdf")).alias("path"), F.concat(F.lit("%PDF-1.4\n"), "url", F.lit("\f"), "html").alias("content"))
    write_files(small_batches(made), at).count()
    documents = made.select("record_id", "kind", "path")
    with many_files(spark):
        files = binary_files(spark, f"{at}/files").select(F.regexp_extract("path", r"([^/]+/[^/]+)$", 1).alias("path"), "length", "modificationTime", "content")
        done = convert_documents(documents, files.select("path", "content"), f"{at}/texts", PlainPages())
        again = to_convert(documents, files.select("path", "length", "modificationTime"), text_listing(spark, f"{at}/texts"))
        again = stored(again.select("record_id", F.lit(True).alias("again")), "again")
        texts = whole_texts(spark, f"{at}/texts").select(F.regexp_extract("path", r"([^/]+)\.md$", 1).alias("record_id"), F.sha2("text", 256).alias("text_sha"))
        texts = stored(texts, "text-hashes")
    return done.select("record_id", "error").join(texts, "record_id", "left").join(again, "record_id", "left").withColumn("again", F.coalesce("again", F.lit(False)))


@query
def pending_documents(spark, sf_dir):
    return incremental.pending_documents(*_ingested(spark, sf_dir))


@query
def ingest_state(spark, sf_dir):
    """The state after a run: piece by piece, for what was committed."""
    records, state = _ingested(spark, sf_dir)
    return incremental.next_state(records, state, _committed(records, state))


@query
def ingest_counters(spark, sf_dir):
    """The seven counters of that run; conversions fail where the number of characters divides by 7, and poor ones got a link."""
    records, state = _ingested(spark, sf_dir)
    of = lambda where: records.where(where).select(F.col("id").alias("record_id"))
    return incremental.run_counters(records, _committed(records, state), of("n_chars % 7 = 0"), of("quality = 0"))


@query
def observed_counters(spark, sf_dir):
    """The same counters, observed while the outcome of each record is written."""
    records, state = _ingested(spark, sf_dir)
    of = lambda where: records.where(where).select(F.col("id").alias("record_id"))
    seen = Observation(f"run-{uuid.uuid4().hex}")
    rows = incremental.outcome_rows(records, state, _committed(records, state), of("n_chars % 7 = 0"), of("quality = 0")).observe(seen, *incremental.counters_of())
    rows.write.parquet(f"{shared_dir(spark)}/corpusloom/outcomes-{uuid.uuid4().hex}")
    return spark.createDataFrame([tuple(seen.get.values())], ", ".join(f"{c} long" for c in seen.get))


@query
def run_summary(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", F.dayofmonth("ts").alias("day"))
    fed = upsert.outcomes(events, "user_id", "event_id", "event_type", ranges=upsert.ranges_of(events, "user_id"))
    counters = summary.yearly_counters(fed, "day", "outcome", ["inserted", "updated", "unchanged"])
    out = summary.run_summary(counters.withColumn("failed", F.col("inserted") == 0), "day", "failed")
    return out.withColumn("failed", F.array_join("failed", ","))


@query
def tracked_counts(spark, sf_dir):
    """How many records, indexed vectors and states there are."""
    tables = [table(spark, sf_dir, t).agg(F.lit(t).alias("store"), F.count("*").alias("n")) for t in ("documents", "embeddings", "labels")]
    return tables[0].union(tables[1]).union(tables[2])


@query
def daily_counters(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumn("day", F.to_date("ts").cast("string"))
    names = ["view", "click", "purchase", "login", "logout"]
    return summary.yearly_counters(events, "day", "event_type", names).select("day", "parsed", "click", "purchase", "view")


@query
def content_cache(spark, sf_dir):
    return upsert.content_owner(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id", F.sha2("text", 256))


# Retrieval


def _questions(vectors: DataFrame) -> DataFrame:
    """Every row whose id divides by 50 is a question to all rows."""
    return vectors.where("vec_id % 50 = 0").select(F.col("vec_id").alias("question_id"), F.col("embedding").alias("question_embedding"), F.col("label").alias("question_label"))


@query
def knn_topk(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    return retrieval.top_k_batch(vectors, _questions(vectors), 5)


@query
def knn_filtered(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    return retrieval.top_k_batch(vectors, _questions(vectors), 5, same=("label", "question_label"))


@query
def knn_pruned(spark, sf_dir):
    """The same answers by pivots and the triangle inequality."""
    vectors = table(spark, sf_dir, "embeddings")
    return pruned.top_k_pruned(pruned.pivot_index(vectors), _questions(vectors), 5)


@query
def knn_coded(spark, sf_dir):
    """The same answers from codes of a byte a dimension, with full vectors for candidates only."""
    vectors = table(spark, sf_dir, "embeddings")
    return pruned.top_k_coded(pruned.coded_index(vectors), vectors, _questions(vectors), 5)


@query
def cited_sources(spark, sf_dir):
    """The answers' documents as numbered sources with snippets."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("vec_id"), text.snippet(F.col("text"), 280).alias("snippet"), F.col("source").alias("source_url"))  # whole texts do not travel
    hits = knn_topk(spark, sf_dir).join(docs, "vec_id").withColumns({"record_id": F.col("vec_id"), "chunk_type": F.lit("judgment_pdf")})
    return retrieval.sources(hits, keep=("question_id",))


@query
def l2_normalize(spark, sf_dir):
    """Vectors of other lengths, normalized."""
    longer = F.transform("embedding", lambda x: x.cast("double") * (F.col("label") + 2))
    unit = table(spark, sf_dir, "embeddings").select("vec_id", vectors.l2_normalized(longer).alias("unit"))
    return unit.select("vec_id", F.round(vectors.norm(F.col("unit")), 5).alias("norm"), F.col("unit")[0].alias("first"))


# Sources


@query
def html_anchors(spark, sf_dir):
    return anchors(table(spark, sf_dir, "pages").select("page_id", "html")).select("page_id", "position", "href")


@query
def url_resolve(spark, sf_dir):
    found = anchors(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return found.select("page_id", "position", text.resolved_url(F.col("url"), F.col("href")).alias("resolved"))


@query
def listing_table(spark, sf_dir):
    """Listing pages of a customer's orders each, written as markup and parsed back into records."""
    cell = lambda c: F.concat(F.lit("<td> "), c, F.lit(" </td>"))
    link = F.concat(F.lit('<td><a href="/app//files/'), F.col("o_orderkey").cast("string"), F.lit('.pdf">PDF</a></td>'))
    cells = [cell(F.col("o_orderkey").cast("string")), cell(F.col("o_orderpriority")), cell(F.lit("a <b>bold</b> remark")), cell(F.lit("")), cell(F.lit("n/a"))]
    cells += [cell(F.date_format("o_orderdate", "dd/MM/yyyy")), cell(F.col("o_orderstatus")), cell(F.lit("Civil"))]
    orders = table(spark, sf_dir, "orders").withColumn("row", F.concat(F.lit("<tr>"), *cells, link, F.lit("</tr>")))
    # A page has the rows of one customer and at most so many order numbers: a customer with very many orders is many pages.
    rows = orders.groupBy("o_custkey", F.floor(F.col("o_orderkey") / 4096)).agg(F.array_join(F.sort_array(F.collect_list("row")), "\n").alias("rows"))
    pages = rows.select(F.col("o_custkey").alias("year"), F.concat(F.lit("<table id=employee_list><tr><th>Sr</th></tr>"), "rows", F.lit("</table>")).alias("html"))
    return listing_records(pages).select("id", "serial_no", "case_info", "remarks", "neutral_citation", "other_citation", "decision_date", "sc_status", "judgment_pdf_url", "sc_judgment_pdf_url", "content_hash")


@query
def page_shortfall(spark, sf_dir):
    """A page for each customer that names more entries than were parsed, for two customers of three."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("year"))
    counts = orders.groupBy("year").agg(F.count("*").alias("n"))
    pages = counts.select("year", F.concat(F.lit("<p>Showing 1 to 25 of <b>"), (F.col("n") + F.col("year") % 3).cast("string"), F.lit("</b> entries</p>")).alias("html"))
    return page_shortfalls(pages, orders)


@query
def json_array(spark, sf_dir):
    """The events written as one JSON array in one file, with brackets and quotes inside strings, and read back in splits: of 64 KB, of a large file no more than a few for each core."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", F.concat("props", F.lit(' }],[{ "\\" é')).alias("props"))
    path = f"{shared_dir(spark)}/corpusloom/array-{uuid.uuid4().hex}"
    line = lambda of: spark.range(1).select(F.lit(of).alias("value"))
    rows = events.select(F.concat(F.lit(","), F.to_json(F.struct(*events.columns))).alias("value"))
    line('[{"event_type": "head"}').union(rows).union(line("]")).coalesce(1).write.text(path)  # one file is what is read
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, split_bytes(spark, path, 1 << 16))
    try:
        return read_json_array(spark, path, events.schema).where("event_id IS NOT NULL").select(*events.columns)
    finally:
        spark.conf.set(key, before)


@query
def safe_filename(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", text.safe_filename(F.col("url")).alias("filename"))


@query
def path_collision(spark, sf_dir):
    named = table(spark, sf_dir, "pages").select("page_id", text.safe_filename(F.col("url")).alias("path"))
    owners = audit.path_owners(named, "page_id", ["path"])
    return named.join(owners, "path").select("page_id", "owner_id", audit.destination(F.col("page_id"), F.col("path"), F.col("owner_id")).alias("destination"))


@query
def total_hint(spark, sf_dir):
    shown = F.concat(F.lit("Showing 1 to 25 OF "), F.format_number(F.floor("o_totalprice").cast("long"), 0), F.lit(" Entries of 7 entries"))
    return table(spark, sf_dir, "orders").select("o_orderkey", text.total_hint(F.when(F.col("o_orderstatus") == "P", F.lit("no total")).otherwise(shown)).alias("hint"))


@query
def date_normalize(spark, sf_dir):
    d = F.col("o_orderdate")
    raw = (
        F.when(F.col("o_orderpriority").startswith("1"), F.date_format(d, "dd/MM/yyyy"))
        .when(F.col("o_orderpriority").startswith("2"), F.date_format(d, "d-M-yyyy"))
        .when(F.col("o_orderpriority").startswith("3"), F.date_format(d, "yyyy-MM-dd"))
        .when(F.col("o_orderpriority").startswith("4"), F.concat(F.lit(" "), F.date_format(d, "dd.MM.yyyy"), F.lit(" ")))
        .otherwise(F.when(F.col("o_orderstatus") == "F", F.lit("Judgment AWAITED")).otherwise(F.concat(F.date_format(d, "yyyy"), F.lit(" term"))))
    )
    rows = table(spark, sf_dir, "orders").select("o_orderkey", raw.alias("raw"))
    return rows.select("o_orderkey", text.normalized_date(F.col("raw")).alias("iso"), text.typed_date(F.col("raw")).cast("string").alias("day"))


# Reports


@query
def reconcile(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return audit.reconciled(docs, labels.where("quality = 1").select("doc_id"), ["doc_id"]).groupBy("status").agg(F.count("*").alias("n"))


@query
def orphan_text(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return docs.select("doc_id", "lang").join(labels.select("doc_id"), "doc_id", "left_anti")


@query
def totals_check(spark, sf_dir):
    orders, lines = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    site = orders.groupBy(F.year("o_orderdate").alias("year")).agg((F.count("*") * 4).alias("site_total"))
    parsed = lines.groupBy(F.year("l_shipdate").alias("year")).agg(F.count("*").alias("n"))
    return audit.totals_check(site, parsed, "year")


@query
def totals_gap(spark, sf_dir):
    """The gap over all years whose total is known."""
    orders, lines = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    site = orders.groupBy(F.year("o_orderdate").alias("year")).agg(F.count("*").alias("n")).select("year", F.when(F.col("year") % 3 != 0, F.col("n") * 4).alias("site_total"))
    parsed = lines.groupBy(F.year("l_shipdate").alias("year")).agg(F.count("*").alias("n"))
    return audit.gap_sums(audit.totals_check(site, parsed, "year"))


def _files(spark, sf_dir) -> DataFrame:
    docs = labelled(spark, sf_dir, "text", "lang", "source")
    path = F.when(F.col("quality").isNotNull(), F.concat("source", F.lit("/"), F.col("doc_id").cast("string"), F.when(F.col("toxic") == 1, "").otherwise(".pdf")))
    content = F.when(F.col("lang") == "es", F.lit(None)).when(F.col("quality") == 1, F.concat(F.lit("%PDF-1.4\n"), "text")).otherwise(F.col("text"))
    return docs.select("doc_id", path.alias("path"), content.alias("content"), F.when(F.col("lang") == "en", F.lit("known")).alias("sha"))


@query
def magic_check(spark, sf_dir):
    return _files(spark, sf_dir).select("doc_id", text.looks_like_pdf(F.col("content")).alias("is_pdf"))


@query
def audit_actions(spark, sf_dir):
    actions = _files(spark, sf_dir).select("doc_id", "path", audit.audit_action(F.col("path"), F.col("content"), F.col("sha")).alias("action"))
    return actions.where("action IS NOT NULL")


@query
def cleared_counts(spark, sf_dir):
    return audit.cleared_count(audit_actions(spark, sf_dir))


@query
def audit_repair(spark, sf_dir):
    fixed = audit.repaired(_files(spark, sf_dir), "path", "sha", F.col("content"))
    return fixed.select("doc_id", "path", "sha")


@query
def set_field(spark, sf_dir):
    patches = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max(F.when(F.col("toxic") == 1, F.lit("flagged"))).alias("source"))
    return upsert.set_fields(table(spark, sf_dir, "documents").select("doc_id", "lang", "source"), patches, "doc_id", ["source"])


@query
def migrate_legacy(spark, sf_dir):
    name = F.concat(F.col("o_orderkey").cast("string"), F.lit(".pdf"))
    old = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("id"),
        F.col("o_orderpriority").alias("case_info"),
        F.when(F.col("o_orderstatus") == "F", F.lit(None)).otherwise(F.concat(F.lit("https://x.example/"), name)).alias("remote_pdf_url"),
        F.when(F.col("o_orderstatus") == "P", F.lit(None)).otherwise(F.concat(F.lit("C:\\data\\pdf\\"), name)).alias("local_pdf_path"),
    )
    files = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("length")).select(F.concat(F.col("l_orderkey").cast("string"), F.lit(".pdf")).alias("name"), (F.col("length") - 1).alias("length"), F.sha2(F.col("l_orderkey").cast("string"), 256).alias("sha256"))
    return migrate.migrated(old, files).select("id", "judgment_pdf_url", "judgment_local_pdf_path", "judgment_pdf_sha256", "content_hash", "schema_version", "outcome")


@query
def migration_counts(spark, sf_dir):
    return migrate_legacy(spark, sf_dir).groupBy("outcome").agg(F.count("*").alias("n"))


@query
def inspect_ids(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars"), table(spark, sf_dir, "labels")
    asked = spark.createDataFrame([(i,) for i in (0, 3, 17, 42, 999_999_999)], "doc_id long")
    return audit.inspected(asked, docs, labels, "doc_id")

"""One scrape: listing pages into the record store, year by year, and their documents into files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import Settings
from ..functions.text import safe_filename
from ..operators.audit import destination, path_owners
from ..operators.upsert import outcomes, snapshot
from ..schemas import CARRIED, HASHED, RECORD
from ..sources.html import listing_records
from ..sources.keyed import KeyedStore
from ..sources.scratch import discard, stored

#: Kind of document → prefix of its fields in a record, folder of its files (fixed values).
KINDS = {"judgment_pdf": ("judgment", "judgments"), "sc_judgment_pdf": ("sc_judgment", "sc_judgments")}

#: Counters of a year.
COUNTERS = ("parsed", "inserted", "updated", "unchanged", "pdf_ok", "pdf_failed", "sc_pdf_ok", "sc_pdf_failed")

Fetch = Callable[[DataFrame], DataFrame]


def document_paths(rows: DataFrame) -> DataFrame:
    """Records → record_id, kind, url, path, sha256 of both documents."""
    each = [F.struct(F.lit(k).alias("kind"), F.col(f"{field}_pdf_url").alias("url"), F.col(f"{field}_local_pdf_path").alias("path"), F.col(f"{field}_pdf_sha256").alias("sha256")) for k, (field, _) in KINDS.items()]
    return rows.select(F.col("id").alias("record_id"), F.explode(F.array(*each)).alias("d")).select("record_id", "d.*")


def wanted_documents(rows: DataFrame, records: DataFrame) -> DataFrame:
    """rows of listings → record_id, kind, url, path of their documents. A path that another record owns, in the store or by a lesser id
    among the rows, is prefixed with the record's id."""
    folder = F.create_map(*(F.lit(x) for k, (_, d) in KINDS.items() for x in (k, d)))
    each = document_paths(rows).where("url IS NOT NULL").groupBy("record_id", "kind").agg(F.min("url").alias("url"))
    named = each.select("record_id", "kind", "url", F.concat(folder[F.col("kind")], F.lit("/")).alias("dir"), safe_filename(F.col("url")).alias("name"))
    named = named.withColumn("path", F.concat("dir", "name"))
    known = path_owners(records, "id", ["judgment_local_pdf_path", "sc_judgment_local_pdf_path"])
    first = named.groupBy("path").agg(F.min("record_id").alias("first"))
    both = named.join(known, "path", "left").join(first, "path")
    return both.select("record_id", "kind", "url", F.concat("dir", destination(F.col("record_id"), F.col("name"), F.coalesce("owner_id", "first"))).alias("path"))


def with_documents(rows: DataFrame, fetched: DataFrame) -> DataFrame:
    """rows with path and hash of the documents that were fetched: fetched (record_id, kind, path, sha256)."""
    for kind, (field, _) in KINDS.items():
        own = fetched.where(F.col("kind") == kind).select(F.col("record_id").alias("id"), F.col("path").alias(f"{field}_local_pdf_path"), F.col("sha256").alias(f"{field}_pdf_sha256"))
        rows = rows.join(own, "id", "left")
    return rows


def scrape_year(page: DataFrame, year: int, store: KeyedStore, run_ts: Column, settings: Settings = Settings(), fetch: Fetch | None = None, dead: KeyedStore | None = None) -> dict:
    """One year's page (year, html; a null page: it could not be fetched) into the store, and its counters.

    fetch: wanted documents → (record_id, kind, path, sha256, error). The store gets a commit with this year's rows alone, so a later
    year that fails loses nothing. dead: keeps what failed, a page that cannot be parsed or a document that was not fetched, until it
    succeeds. A page that cannot be parsed is a failed year.
    """
    stats = {"year": year} | dict.fromkeys(COUNTERS, 0) | {"failed": False}
    if page.where("html IS NULL").head() is not None or page.head() is None:
        return stats | {"failed": True}
    parsed = stored(listing_records(page, settings, errors=True).withColumn("seq", F.col("serial_no").cast("long")), "listing")
    rows = parsed.where("error IS NULL").drop("error")
    pages = parsed.where("error IS NOT NULL").select(F.lit("page").alias("step"), F.lit(str(year)).alias("item"), "error")
    blank = {c: F.lit(None).cast("string") for c in CARRIED}
    known = store.current() is not None
    new, got = rows, None
    if fetch is not None:
        got = stored(fetch(wanted_documents(rows.withColumns(blank), store.read())), "fetched")
        new = with_documents(rows, got)
        for kind, name in (("judgment_pdf", "pdf"), ("sc_judgment_pdf", "sc_pdf")):
            own = got.where(F.col("kind") == kind).agg(F.count("sha256").alias("ok"), F.count_if(F.col("sha256").isNull()).alias("failed")).head()
            stats |= {f"{name}_ok": own["ok"], f"{name}_failed": own["failed"]}
    new = new.withColumns({c: x for c, x in blank.items() if c not in new.columns}).withColumn("run_ts", run_ts)
    before = store.beside(new) if known else None
    for r in outcomes(new, "id", "seq", "content_hash", before).groupBy("outcome").count().collect():  # three rows at most
        stats[r["outcome"]] = r["count"]
    merged = snapshot(new, "id", "seq", "run_ts", "content_hash", ["serial_no", "year", *HASHED, "content_hash"], CARRIED, before, untouched=False)
    store.commit(merged.withColumn("schema_version", F.lit(settings.schema_version)).select(*RECORD.names))
    stats["parsed"] = rows.count()
    if dead is not None:
        step, item = F.col("kind").alias("step"), F.col("record_id").alias("item")
        lost = pages if got is None else pages.unionByName(got.where("error IS NOT NULL").select(step, item, "error"))
        done = new.select(F.lit("page").alias("step"), F.lit(str(year)).alias("item")).limit(1)
        done = done if got is None else done.unionByName(got.where("error IS NULL").select(step, item))
        dead.commit(lost.dropDuplicates(["step", "item"]).withColumn("failed_at", run_ts), done)
    stats["failed"] = pages.head() is not None
    discard(parsed, *([got] if got is not None else []))
    return stats

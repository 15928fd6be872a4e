"""python -m corpusloom COMMAND: reports and runs over a store of snapshots."""

from __future__ import annotations

import argparse
import datetime as dt
import json
import logging

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .config import Settings
from .embedding import loaded
from .logs import setup_logging
from .operators.audit import action_by_facts, cleared_count, file_facts, gap_sums, inspected, path_owners, reconciled, repaired_by_facts, totals_check
from .operators.migrate import migrated
from .operators.summary import run_summary
from .operators.upsert import set_fields
from .plans.pipeline import answer, ingest_into, retrieve
from .plans.schedule import run_daily
from .plans.scrape import COUNTERS, KINDS, document_paths, scrape_year
from .plans.service import convert_documents, publish_files, run_job, suspicious_pages
from .schemas import CHUNK, DEAD, RECORD, STATE, UPLOAD_CACHE
from .sources.downloads import downloaded, removed, renamed, write_files
from .sources.files import binary_files, file_hashes, read_legacy, read_records_or_quarantine, text_listing, to_convert, whole_texts
from .sources.html import page_shortfalls
from .sources.keyed import KeyedStore
from .sources.listing_source import ListingSource
from .sources.scratch import stored
from .sources.store import Pointed

log = logging.getLogger(__name__)
INDEX = CHUNK + ", embedding array<float>, ingested_at timestamp"
#: Store → schema and key.
STORES = {"records": (RECORD, "id"), "index": (INDEX, "chunk_id"), "state": (STATE, "id"), "published": (UPLOAD_CACHE, "sha256"), "dead": (DEAD, ["step", "item"])}


def stores(spark: SparkSession, root: str) -> dict[str, KeyedStore]:
    return {k: KeyedStore(spark, f"{root}/{k}", *of) for k, of in STORES.items()}


def job_lock(spark: SparkSession, root: str):
    """One writing command at a time, whichever it is."""
    return Pointed(spark, f"{root}/job").lock()


def run_time(args) -> Column:
    """The run's time stamp: as given, else the present."""
    return F.to_timestamp(F.lit(args.run_ts or dt.datetime.now(dt.timezone.utc).isoformat()))


def listing_pages(spark: SparkSession, args, settings: Settings) -> DataFrame:
    """(year, html), fetched or read once: a folder of HTML files with a year in each name, or the network."""
    if args.pages:
        pages = whole_texts(spark, args.pages).select(F.regexp_extract("path", r"(\d{4})", 1).cast("int").alias("year"), F.col("text").alias("html"))
    else:
        spark.dataSource.register(ListingSource)
        years = args.years or list(settings.years)
        pages = spark.read.format("listing").option("url", settings.base_url).option("years", ",".join(map(str, years))).option("spacing", settings.request_spacing_s).load()
    return stored(pages.where(F.col("year").isin(args.years)) if args.years else pages, "listing-pages")


def scrape(spark: SparkSession, args, settings: Settings) -> list[dict]:
    with job_lock(spark, args.root):
        return _scrape(spark, args, settings)


def _scrape(spark: SparkSession, args, settings: Settings) -> list[dict]:
    """Listing pages and, if asked for, their documents into the record store. Each year is a commit of its own; one that fails is
    reported and the next goes on. Pages without any record are kept for inspection."""
    pages = listing_pages(spark, args, settings)
    s = stores(spark, args.root)
    store = s["records"]
    store.read_or_quarantine()
    fetch = (lambda wanted: downloaded(wanted, args.files)) if args.download else None
    done, run_ts = [], run_time(args)
    for year in sorted(r["year"] for r in pages.select("year").distinct().collect()):  # one row a year of the listing
        try:
            done.append(scrape_year(pages.where(F.col("year") == year), year, store, run_ts, settings, fetch, s["dead"]))
        except Exception:  # a year that fails must not hold up the others
            log.exception("year %s", year)
            done.append({"year": year, "failed": True})
    tidied(store, s["dead"])
    records = store.read()
    odd = suspicious_pages(pages, records)
    write_files(odd.select(F.concat(F.lit("year-"), F.col("year").cast("string"), F.lit(".html")).alias("path"), F.col("html").alias("content")), f"{args.root}/debug").collect()
    rows = spark.createDataFrame([(d["year"], *(d.get(k, 0) for k in COUNTERS), d["failed"]) for d in done], ", ".join(["year int", *(f"{k} long" for k in COUNTERS), "failed boolean"]))
    out = [r.asDict() for r in run_summary(rows, "year", "failed").collect()]
    return out + [r.asDict() for r in page_shortfalls(pages, records).collect()]


def tidied(*touched: KeyedStore) -> None:
    """Rewrite the buckets of which much has changed, and drop what only versions before the last two read."""
    for store in touched:
        store.compact()
        store.vacuum()


def run_ingest(spark: SparkSession, args, settings: Settings) -> list[dict]:
    with job_lock(spark, args.root):
        return _ingest(spark, args, settings)


def _texts(spark: SparkSession, args) -> DataFrame:
    """Converted documents: a Parquet table, or the folder of text files."""
    if args.texts:
        texts = spark.read.parquet(args.texts)
        return texts.select("record_id", "kind", "text", *(["error"] if "error" in texts.columns else []))
    files = whole_texts(spark, args.text_files)
    return files.select(F.regexp_extract("path", r"([^/]+)\.md$", 1).alias("record_id"), F.regexp_extract("path", r"([^/]+)/[^/]+$", 1).alias("kind"), "text")


def _ingest(spark: SparkSession, args, settings: Settings) -> list[dict]:
    """Changed records and texts into the index; with --publish, copies of new files are made and linked first."""
    s = stores(spark, args.root)
    for store in s.values():
        store.read_or_quarantine()
    links = None
    if args.publish:
        files = binary_files(spark, args.files).where("length > 0").select(_relative().alias("path"), "content")
        links = publish_files(s["records"].read(), files, s["published"], args.publish)
    stats = ingest_into(s, _texts(spark, args), run_time(args), settings, links=links, tombstones=args.tombstones)
    tidied(*s.values())
    return [stats]


def ask(spark: SparkSession, args, settings: Settings) -> list[dict]:
    s = stores(spark, args.root)
    hits = retrieve(s["index"].read(), s["records"].read(), args.question, args.top_k, args.chunk_type, settings)
    return [answer(hits, args.question)]


def _relative(path: str = "path"):
    """The last two segments: the folder of a kind and the file's name, as records have them."""
    return F.regexp_extract(path, r"([^/]+/[^/]+)$", 1)


def audit(spark: SparkSession, args, settings: Settings) -> list[dict]:
    """What records' files and texts need. With --repair it is done: files are deleted or renamed, records cleared, renamed or given
    their hash, texts without a file deleted."""
    store = stores(spark, args.root)["records"]
    records = store.read()
    facts = stored(binary_files(spark, args.files).select(_relative().alias("rel"), F.col("path").alias("file"), file_facts(F.col("content")).alias("facts")), "file-facts")
    fields = {f"{field}_local_pdf_path": f"{field}_pdf_sha256" for field, _ in KINDS.values()}
    found = None
    for path, sha in fields.items():
        j = records.join(facts, F.col(path) == F.col("rel"), "left")
        rows = j.select("id", F.col(path).alias("path"), action_by_facts(F.col(path), F.col("facts"), F.col(sha)).alias("action"), "file").where("action IS NOT NULL")
        found = rows if found is None else found.union(rows)
    if args.text_files:
        gone = document_paths(records).where("path IS NULL").select("record_id", "kind")
        orphans = text_listing(spark, args.text_files).withColumnRenamed("path", "file").join(gone, ["record_id", "kind"])
        found = found.union(orphans.select(F.col("record_id").alias("id"), _relative("file").alias("path"), F.lit("DELETE orphaned markdown (no backing PDF)").alias("action"), "file"))
    found = stored(found, "findings")
    if args.repair:
        with job_lock(spark, args.root):
            fixed = records.join(found.select("id").distinct(), "id", "left_semi")
            for path, sha in fields.items():
                own = fixed.join(facts.select("rel", "facts"), F.col(path) == F.col("rel"), "left")
                fixed = repaired_by_facts(own, path, sha, F.col("facts")).drop("rel", "facts")
            fixed = stored(fixed, "repaired")  # before any file goes
            found.foreach(_apply)
            store.commit(fixed.select(*RECORD.names))
            tidied(store)
    counts = cleared_count(found.where(~F.col("action").contains("markdown"))).head()
    rows = [r.asDict() for r in found.orderBy("id", "path").drop("file").limit(args.limit).collect()]
    return [*rows, {"checked": records.count(), "findings": found.count(), "cleared": counts["n_cleared"], "repaired": bool(args.repair)}]


def _apply(row) -> None:
    """Carry out one finding on its file; a repeated one does nothing."""
    if row["file"] is None:
        return
    path = row["file"]
    if row["action"].startswith("DELETE"):
        removed(path)
    elif row["action"].startswith("RENAME"):
        try:
            renamed(path, path + ".pdf")
        except FileNotFoundError:  # done by an earlier attempt of the task
            pass


def reconcile(spark: SparkSession, args, settings: Settings) -> list[dict]:
    """Both documents of each record: is its file there, is its text? Counts, and the first of each kind of gap."""
    records = stores(spark, args.root)["records"].read()
    named = document_paths(records).where("path IS NOT NULL OR sha256 IS NOT NULL")
    if args.files:
        there = binary_files(spark, args.files).where("length > 0").select(_relative().alias("path"))
        named = named.join(there, "path", "left_semi")
    else:
        named = named.where("sha256 IS NOT NULL")
    texts = spark.read.parquet(args.texts) if args.texts else text_listing(spark, args.text_files)
    done = stored(reconciled(named, texts, ["record_id", "kind"]), "reconciled")
    owners = path_owners(records, "id", ["judgment_local_pdf_path", "sc_judgment_local_pdf_path"])
    counts = done.groupBy("status").count().union(owners.agg(F.lit("owned_paths"), F.count("*")))
    gaps = [r.asDict() for status in ("orphan_text", "missing_text") for r in done.where(F.col("status") == status).orderBy("record_id", "kind").limit(args.limit).collect()]
    return [r.asDict() for r in counts.collect()] + [{"first": gaps}] * bool(gaps)


def convert(spark: SparkSession, args, settings: Settings) -> list[dict]:
    """Make the texts that are not there or older than their file, and report them; --list only names them. A file that fails is tried
    again by the next run."""
    s = stores(spark, args.root)
    files = binary_files(spark, args.files)
    wanted = to_convert(document_paths(s["records"].read()).where("path IS NOT NULL").select("record_id", "kind", "path"), files.select(_relative().alias("path"), "length", "modificationTime"), text_listing(spark, args.text_files))
    if args.list:
        return [r.asDict() for r in wanted.orderBy("record_id", "kind").limit(args.limit).collect()]
    with job_lock(spark, args.root):
        wanted = stored(wanted, "to-convert")
        recognizer = loaded(args.recognizer) if args.recognizer else None
        done = stored(convert_documents(wanted, files.where("length > 0").select(_relative().alias("path"), "content"), args.text_files, loaded(args.extractor), recognizer), "conversions")
        item = F.concat_ws("/", "kind", "record_id").alias("item")
        failed = done.where("error IS NOT NULL").select(F.lit("conversion").alias("step"), item, "error", run_time(args).alias("failed_at"))
        s["dead"].commit(failed, done.where("error IS NULL").select(F.lit("conversion").alias("step"), item))
        tidied(s["dead"])
    counts = done.agg(F.count_if(F.col("error").isNull()).alias("converted"), F.count_if("any_ocr").alias("with_ocr"), F.count("error").alias("failed")).head()
    return [r.asDict() for r in done.where("error IS NOT NULL").orderBy("record_id", "kind").limit(args.limit).collect()] + [counts.asDict()]


def failures(spark: SparkSession, args, settings: Settings) -> list[dict]:
    """What failed and has not succeeded since."""
    return [r.asDict() for r in stores(spark, args.root)["dead"].read().orderBy("step", "item").limit(args.limit).collect()]


def export(spark: SparkSession, args, settings: Settings) -> list[dict]:
    """All records as JSON lines in order of year and serial number, files in order; null fields are written."""
    records = stores(spark, args.root)["records"].read()
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    records.repartitionByRange(width, "year", "serial_no").sortWithinPartitions("year", "serial_no", "id").write.mode("overwrite").option("ignoreNullFields", False).json(args.to)
    return [{"exported": spark.read.schema(RECORD).json(args.to).count()}]


def restore(spark: SparkSession, args, settings: Settings) -> list[dict]:
    """The record store anew, from a JSON array in one .json file, which is set aside if it is broken, or from a folder of JSON lines as `export` writes them."""
    store = stores(spark, args.root)["records"]
    with job_lock(spark, args.root):
        rows = read_records_or_quarantine(spark, args.source, RECORD) if args.source.endswith(".json") else spark.read.schema(RECORD).option("mode", "FAILFAST").json(args.source)
        store.replace(rows)
    return [{"restored": store.read().count()}]


def totals(spark: SparkSession, args, settings: Settings) -> list[dict]:
    records = stores(spark, args.root)["records"].read()
    site = spark.read.option("header", True).schema("year int, site_total long").csv(args.totals)
    checked = totals_check(site, records.groupBy("year").agg(F.count("*").alias("n")), "year")
    return [r.asDict() for r in checked.orderBy("year").collect()] + [{"all": r.asDict()} for r in gap_sums(checked).collect()]


def schedule(spark: SparkSession, args, settings: Settings) -> list[dict]:
    """The daily job, scrape and then ingest, at --at hours:minutes UTC until it is stopped."""
    hour, minute = map(int, args.at.split(":"))
    job = lambda: run_job(lambda: _scrape(spark, args, settings)[0], lambda: _ingest(spark, args, settings)[0], Pointed(spark, f"{args.root}/job"))
    return [{"runs": run_daily(job, hour, minute, rounds=args.rounds)}]


def set_field(spark: SparkSession, args, settings: Settings) -> list[dict]:
    """Patch one field of one record; without --value it becomes null."""
    store = stores(spark, args.root)["records"]
    with job_lock(spark, args.root):
        records = store.read().where(F.col("id") == args.ids[0])
        patch = spark.createDataFrame([(args.ids[0], args.value)], "id string, value string").select("id", F.col("value").cast(records.schema[args.field].dataType).alias(args.field))
        store.commit(set_fields(records, patch, "id", [args.field], nulls=True).select(*RECORD.names))
    return [{"patched": store.read().where(F.col("id") == args.ids[0]).count()}]


def inspect(spark: SparkSession, args, settings: Settings) -> list[dict]:
    s = stores(spark, args.root)
    state = s["state"].read().select("id", "judgment_chunk_count", "sc_judgment_chunk_count")
    ids = spark.createDataFrame([(i,) for i in args.ids], "id string")
    rows = inspected(ids, s["records"].read(), state)
    if args.files:
        there = binary_files(spark, args.files).where("length > 0").select(_relative().alias("rel"))
        for field, _ in KINDS.values():
            rows = rows.join(there, F.col(f"{field}_local_pdf_path") == F.col("rel"), "left").withColumn(f"{field}_file", F.col("rel").isNotNull()).drop("rel")
    return [r.asDict() for r in rows.collect()]  # the asked ids


def migrate(spark: SparkSession, args, settings: Settings) -> list[dict]:
    old = read_legacy(spark, args.legacy, RECORD)
    out = migrated(old, file_hashes(spark, args.files), schema_version=settings.schema_version)
    store = stores(spark, args.root)["records"]
    given = set(out.columns)
    with job_lock(spark, args.root):
        store.replace(out.select(*(F.col(f.name).cast(f.dataType) if f.name in given else F.lit(None).cast(f.dataType).alias(f.name) for f in RECORD)))
    return [r.asDict() for r in out.groupBy("outcome").count().collect()]


COMMANDS = {f.__name__.removeprefix("run_"): f for f in (scrape, run_ingest, ask, audit, reconcile, convert, failures, export, restore, totals, inspect, migrate, schedule, set_field)}


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="corpusloom", description=__doc__)
    p.add_argument("command", choices=sorted(COMMANDS))
    p.add_argument("--root", required=True, help="folder of the stores")
    p.add_argument("--pages", help="folder of saved listing pages, a year in each name")
    p.add_argument("--years", type=int, nargs="*")
    p.add_argument("--texts", help="Parquet of record_id, kind, text")
    p.add_argument("--files", help="folder of downloaded files")
    p.add_argument("--text-files", help="folder of converted texts: kind/record_id.md")
    p.add_argument("--download", action="store_true", help="scrape: fetch the documents into --files too")
    p.add_argument("--repair", action="store_true", help="audit: carry out the findings")
    p.add_argument("--tombstones", action="store_true", help="ingest: drop the chunks of documents that are gone")
    p.add_argument("--at", default="02:00", help="schedule: time of day, UTC")
    p.add_argument("--rounds", type=int, help="schedule: looks at the clock, for ever if not given")
    p.add_argument("--field")
    p.add_argument("--value")
    p.add_argument("--log", help="folder of the rotating log file")
    p.add_argument("--legacy", help="JSON array of legacy records")
    p.add_argument("--totals", help="CSV of year, site_total")
    p.add_argument("--ids", nargs="*", default=[])
    p.add_argument("--question")
    p.add_argument("--top-k", type=int)
    p.add_argument("--chunk-type")
    p.add_argument("--run-ts", help="the run's time stamp; the present if not given")
    p.add_argument("--publish", help="ingest: folder for copies of the documents, which are linked")
    p.add_argument("--list", action="store_true", help="convert: name the documents only")
    p.add_argument("--extractor", default="corpusloom.embedding:PlainPages", help="convert: module:Class with pages(content)")
    p.add_argument("--recognizer", help="convert: module:Class with text(content, page), for pages without text")
    p.add_argument("--source", help="restore: JSON array file, or folder of JSON lines")
    p.add_argument("--to", help="export: folder of JSON lines")
    p.add_argument("--limit", type=int, default=20)
    args = p.parse_args(argv)
    if args.log:
        setup_logging(args.log)
    spark = SparkSession.builder.appName("corpusloom").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    for row in COMMANDS[args.command](spark, args, Settings.from_env()):
        print(json.dumps(row, default=str, ensure_ascii=False))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())

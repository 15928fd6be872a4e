"""What a server or scheduler calls: health, status, one run of the job, one question."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Settings
from ..embedding import Answerer, Embedder, PdfExtractor, Recognizer, extracted, published, with_ocr
from ..sources.downloads import publish_copies, write_texts
from ..sources.files import page_texts
from ..sources.keyed import KeyedStore
from ..sources.scratch import many_files, stored
from ..sources.store import Pointed
from .pipeline import answer, retrieve
from .scrape import document_paths


def health(stores: dict[str, Pointed]) -> dict:
    return {"status": "ok", "stores": {name: s.current() is not None for name, s in stores.items()}}


def ingest_status(stores: dict[str, KeyedStore]) -> dict:
    """Records, tracked states and indexed chunks (counts of snapshots; no data leaves the executors)."""
    return {name: s.read().count() for name, s in stores.items()}


@dataclass
class JobResult:
    stats: dict = field(default_factory=dict)
    errors: dict = field(default_factory=dict)

    @property
    def ok(self) -> bool:
        return not self.errors


def run_job(scrape: Callable[[], dict], ingest: Callable[[], dict], store: Pointed) -> JobResult:
    """Scrape, then ingest, under one lock for both. A failed scrape is reported and keeps the ingestion from running; nothing raises
    but a lock that another run holds."""
    out = JobResult()
    with store.lock():
        for name, step in (("scrape", scrape), ("ingest", ingest)):
            try:
                out.stats[name] = step()
            except Exception as e:  # a job reports whatever a step raises
                out.errors[name] = f"{type(e).__name__}: {e}"
                break
    return out


def convert_documents(wanted: DataFrame, files: DataFrame, folder: str, extractor: PdfExtractor, recognizer: Recognizer | None = None) -> DataFrame:
    """wanted (record_id, kind, path) with files (path, content) → record_id, kind, any_ocr, error; the texts are written as folder/kind/record_id.md.

    Each file is read and extracted once, by the task that reads it; a page without a text of its own is recognised, if there is a recogniser. A file that
    fails is a row with its error, and has no text. Running it again for the same documents writes the same files.
    """
    own = files.join(wanted.select("path").distinct(), "path", "left_semi")
    with many_files(files.sparkSession):
        pages = stored(extracted(own, extractor), "pages")
    read = pages.where("error IS NULL")
    read = with_ocr(read, own, recognizer) if recognizer else read.withColumn("ocr_text", F.lit(None).cast("string"))
    texts = page_texts(read, "path", "page", F.col("text"), F.col("ocr_text"))
    named = stored(wanted.join(texts, "path"), "converted")
    write_texts(named, folder).count()
    good = named.select("record_id", "kind", "any_ocr", F.lit(None).cast("string").alias("error"))
    return good.unionByName(wanted.join(pages.where("error IS NOT NULL").select("path", "error"), "path").select("record_id", "kind", F.lit(False).alias("any_ocr"), "error"))


def publish_files(records: DataFrame, files: DataFrame, cache: KeyedStore, folder: str) -> DataFrame:
    """records' documents with files (path, content) → links (sha256, view_url), after one copy of each content that the cache does not know was
    written to folder. The cache gets what is new, so a second run copies nothing."""
    paths = document_paths(records).where("path IS NOT NULL AND sha256 IS NOT NULL").select("path", "sha256", F.element_at(F.split("path", "/"), -1).alias("name"))
    known = cache.read()
    new = paths.join(known.select("sha256"), "sha256", "left_anti")
    publish_copies(new.join(files.select("path", "content"), "path").select("sha256", "content"), folder).count()
    there = new.join(files.select("path"), "path", "left_semi")
    cache.commit(published(there, known, folder).join(known.select("sha256"), "sha256", "left_anti"))
    return cache.read().select("sha256", "view_url")


def chat(stores: dict[str, Pointed], question: str, top_k: int | None = None, chunk_type: str | None = None, settings: Settings = Settings(), embedder: Embedder | None = None, answerer: Answerer | None = None) -> dict:
    """The reply to a question and its sources; ValueError for a request out of bounds."""
    hits = retrieve(stores["index"].read(), stores["records"].read(), question, top_k, chunk_type, settings, embedder)
    return answer(hits, question, answerer)


def suspicious_pages(pages: DataFrame, records: DataFrame) -> DataFrame:
    """Pages (year, html) that gave no record: what to keep for inspection."""
    return pages.join(records.select("year").distinct(), "year", "left_anti")


def vector_check(index: DataFrame, dim: int) -> dict:
    """Dimension of a sampled vector against the expected one, and how many rows have another."""
    row = index.agg(F.count("*").alias("rows"), F.count_if(F.size("embedding") != dim).alias("other")).head()
    return {"rows": row["rows"], "other_dimension": row["other"], "ok": not row["other"]}


def as_dict(result: JobResult) -> dict:
    return asdict(result) | {"ok": result.ok}

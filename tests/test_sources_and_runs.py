import datetime as dt
import hashlib
import urllib.error

import pytest
from pyspark.sql import functions as F

from corpusloom import embedding
from corpusloom.config import Settings
from corpusloom.logs import setup_logging
from corpusloom.plans import schedule, scrape
from corpusloom.plans.pipeline import answer, ingest, retrieve
from corpusloom.schemas import CHUNK, RECORD, STATE
from corpusloom.sources import downloads, files, html
from corpusloom.sources.client import Client
from corpusloom.sources.listing_source import RobotsGate, fetch
from corpusloom.sources.keyed import KeyedStore
from corpusloom.sources.store import Locked, SnapshotStore
from corpusloom.streaming.ingest import upsert_stream

ONE = """<p>Showing 1 to 2 of 3 entries</p><table id="employee_list"><tr><th>Sr</th></tr><tr>
<td>1</td><td>W.P 1 <b>A</b>  Vs B</td><td>r</td><td></td><td>2025 X 1</td><td>24/12/2025</td><td> </td><td>Civil</td><td><a href="/app//files/foo.pdf">Get</a></td></tr>
<tr><td>01</td><td>c</td><td></td><td></td><td></td><td>Judgment awaited</td><td>Upheld <a href="https://o/sc_bar.pdf">SC Judgment</a></td><td></td><td><a href="bar.pdf">Get</a></td></tr>
<tr><td>\u00b2</td><td>x</td><td></td><td></td><td></td><td></td><td></td><td></td><td></td></tr><tr><td>short</td></tr></table>"""


def test_listing(spark):
    pages = spark.createDataFrame([(2025, ONE), (2024, "<p>nothing</p>"), (2023, None)], "year int, html string")
    rows = {r.id: r for r in html.listing_records(pages).collect()}
    assert set(rows) == {"REC_2025_1", "REC_2025_01"}
    a, b = rows["REC_2025_1"], rows["REC_2025_01"]
    assert (a.case_info, a.sc_status, a.decision_date, a.judgment_pdf_url, a.sc_judgment_pdf_url) == ("W.P 1 A Vs B", None, "2025-12-24", "https://listing.example.org/app//files/foo.pdf", None)
    assert (b.serial_no, b.sc_status, b.decision_date, b.sc_judgment_pdf_url, b.judgment_pdf_url) == (1, "Upheld SC Judgment", None, "https://o/sc_bar.pdf", "https://listing.example.org/app/bar.pdf")
    assert [tuple(r) for r in html.page_shortfalls(pages, html.listing_records(pages)).collect()] == [(2025, 3, 2)]


def test_second_link_in_another_cell():
    cells = "".join(f"<td>{'<a href=k.pdf>k</a>' if i == 3 else i}</td>" for i in range(9))
    assert html.listing_cells(f"<table id=t><tr>{cells}</tr></table>", "t")[0][9] == "k.pdf"


def test_anchors(spark):
    df = spark.createDataFrame([(1, '<a href=" /x ">a <b>b</b></a><a name=n>c</a><p>d</p><a href=y>'), (2, None)], "id int, html string")
    assert [tuple(r) for r in html.anchors(df).collect()] == [(1, 1, "/x", "a b"), (1, 2, "y", "")]


def test_store_commits_locks_and_quarantines(spark, tmp_path):
    store = SnapshotStore(spark, f"file://{tmp_path}/s", "id string, n int")
    assert store.read().count() == 0 and store.current() is None
    one = spark.createDataFrame([("a", 1)], "id string, n int")
    first = store.commit(one)
    assert store.current() == first and store.read().collect()[0].id == "a"
    store.commit(store.read().withColumn("n", F.lit(2)), version="batch-1")
    assert store.read().head().n == 2 and store.commit(one, version="batch-1") == "batch-1" and store.read().head().n == 2
    with store.lock():
        with pytest.raises(Locked):
            with store.lock():
                pass
    with store.lock():
        pass
    for f in (tmp_path / "s" / "batch-1").glob("*"):
        f.unlink() if f.name.startswith(".") else f.write_bytes(b"{not parquet")
    assert store.read_or_quarantine().count() == 0 and store.current() is None
    assert len(list((tmp_path / "s").glob("*corrupt*"))) == 1


def test_json_records_last_wins(spark, tmp_path):
    (tmp_path / "r.json").write_text('[{"id": "a", "year": 1}, {"id": "a", "year": 2}]')
    assert [(r.id, r.year) for r in files.read_records(spark, str(tmp_path / "r.json"), RECORD).collect()] == [("a", 2)]
    (tmp_path / "bad.json").write_text("{not valid json")
    with pytest.raises(Exception):
        files.read_records(spark, str(tmp_path / "bad.json"), RECORD).collect()


def test_files(spark, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "a.pdf").write_bytes(b"%PDF-1.4")
    (tmp_path / "b.pdf").write_bytes(b"<html>")
    rows = {r.name: r for r in files.file_hashes(spark, str(tmp_path), "*.pdf").collect()}
    assert rows["a.pdf"].is_pdf and not rows["b.pdf"].is_pdf and rows["b.pdf"].length == 6
    assert files.file_listing(spark, str(tmp_path), "*.pdf").count() == 2
    pages = spark.createDataFrame([("r", 2, "two", None), ("r", 1, "", "ocr one"), ("r", 3, "", "")], "id string, n int, t string, o string")
    row = files.page_texts(pages, "id", "n", F.col("t"), F.col("o")).head()
    assert (row.text, row.any_ocr) == ("ocr one\n\ntwo", True)


class Page:
    def __init__(self, body):
        self.body = body

    def __enter__(self):
        return self

    def __exit__(self, *_):
        pass

    def read(self):
        return self.body


def test_fetch_retries_and_robots():
    waits, calls = [], []

    def flaky(request, timeout):
        calls.append(request)
        if len(calls) < 3:
            raise urllib.error.URLError("down")
        return Page(b"ok")

    assert fetch("u", 1, 5, 2.0, flaky, waits.append) == b"ok" and waits == [2.0, 4.0]

    def down(*_, **__):
        raise urllib.error.URLError("down")

    assert fetch("u", 1, 2, 1.0, down, lambda s: None) is None
    assert RobotsGate("http://h/", "bot", down).allows("http://h/x")
    gate = RobotsGate("http://h/", "bot", lambda *_, **__: Page(b"User-agent: *\nDisallow: /no\nCrawl-delay: 9"))
    assert not gate.allows("http://h/no/1") and gate.allows("http://h/yes") and gate.delay(3.0) == 9.0


COUNTERS = dict.fromkeys(("records_seen", "metadata_ingested", "judgment_pdf_ingested", "sc_judgment_pdf_ingested", "gdrive_uploaded", "unchanged", "errors"), 0)


def records_and_texts(spark):
    r = {f.name: None for f in RECORD} | {"schema_version": 2, "year": 2025, "serial_no": 1}
    rows = [r | {"id": "A", "case_info": "tax appeal", "content_hash": "h1", "judgment_pdf_sha256": "s1"}, r | {"id": "B", "case_info": "land dispute", "content_hash": "h2"}]
    records = spark.createDataFrame([tuple(x[f.name] for f in RECORD) for x in rows], RECORD)
    texts = spark.createDataFrame([("A", "judgment_pdf", "\n\n".join(["income tax " * 200, "refund of customs duty " * 60]))], "record_id string, kind string, text string")
    return records, texts


def test_ingest_is_idempotent_and_retrieves(spark, tmp_path):
    records, texts = records_and_texts(spark)
    index = spark.createDataFrame([], CHUNK + ", embedding array<float>, ingested_at timestamp")
    state = spark.createDataFrame([], STATE)
    out = ingest(records, texts, index, state, F.lit(dt.datetime(2025, 1, 1)))
    out["index"].write.parquet(str(tmp_path / "i"))
    out["state"].write.parquet(str(tmp_path / "s"))
    index, state = spark.read.parquet(str(tmp_path / "i")), spark.read.parquet(str(tmp_path / "s"))
    assert out["stats"].head().asDict() == COUNTERS | {"records_seen": 2, "metadata_ingested": 2, "judgment_pdf_ingested": 1} and index.where("chunk_type = 'metadata'").count() == 2 and index.count() == 5
    again = ingest(records, texts, index, state, F.lit(dt.datetime(2025, 1, 2)))
    assert again["fresh"].count() == 0 and again["stats"].head().asDict() == COUNTERS | {"records_seen": 2, "unchanged": 2}
    assert sorted(map(str, again["index"].collect())) == sorted(map(str, index.collect()))
    assert sorted(map(tuple, again["state"].collect())) == sorted(map(tuple, state.collect()))
    # A shorter document leaves no trailing chunks.
    short = texts.withColumn("text", F.lit("income tax only"))
    newer = records.withColumn("judgment_pdf_sha256", F.when(F.col("id") == "A", "s2"))
    shrunk = ingest(newer, short, index, state, F.lit(dt.datetime(2025, 1, 3)))
    assert shrunk["index"].where("chunk_type = 'judgment_pdf'").count() == 1 and shrunk["dropped"].count() == 2
    hits = retrieve(index, records, "customs duty refund", 2)
    assert hits.where("rank = 1").head().record_id == "A"
    reply = answer(hits, "customs duty refund")
    assert [s["citation"] for s in reply["sources"]] == [1, 2] and "[1]" in reply["answer"]
    assert answer(retrieve(index.where("false"), records, "x"), "x")["answer"] == embedding.NO_CONTEXT
    with pytest.raises(ValueError):
        retrieve(index, records, "")


def test_a_document_that_failed_is_tried_again(spark, tmp_path):
    records, texts = records_and_texts(spark)
    index = spark.createDataFrame([], CHUNK + ", embedding array<float>, ingested_at timestamp")
    state = spark.createDataFrame([], STATE)

    def run(k, records, texts, index, state, **more):
        out = ingest(records, texts, index, state, F.lit(dt.datetime(2025, 1, k)), **more)
        for name in ("index", "state", "records"):
            out[name].write.parquet(str(tmp_path / f"{name}{k}"))
        return *(spark.read.parquet(str(tmp_path / f"{n}{k}")) for n in ("index", "state", "records")), out["stats"].head().asDict()

    # No text yet: the card goes in, the document stays pending. Then a failed conversion, then a good one.
    index, state, _, stats = run(1, records, texts.where("false"), index, state)
    assert stats == COUNTERS | {"records_seen": 2, "metadata_ingested": 2}
    assert {r.id: (r.content_hash, r.judgment_pdf_sha256) for r in state.collect()} == {"A": ("h1", None), "B": ("h2", None)}
    failed = texts.withColumns({"text": F.lit(None).cast("string"), "error": F.lit("broken")})
    index, state, _, stats = run(2, records, failed, index, state)
    assert stats == COUNTERS | {"records_seen": 2, "unchanged": 1, "errors": 1} and index.count() == 2
    index, state, _, stats = run(3, records, texts, index, state)
    assert stats == COUNTERS | {"records_seen": 2, "judgment_pdf_ingested": 1, "unchanged": 1} and index.count() == 5
    assert [(r.judgment_pdf_sha256, r.judgment_chunk_count) for r in state.orderBy("id").collect()] == [("s1", 3), (None, None)]
    # A second document that comes late is one more piece; links are new once; a document that is gone leaves only if asked.
    late = records.withColumn("sc_judgment_pdf_sha256", F.when(F.col("id") == "A", "s9"))
    links = spark.createDataFrame([("s1", "http://h/s1")], "sha256 string, view_url string")
    more = texts.union(spark.createDataFrame([("A", "sc_judgment_pdf", "upheld")], texts.schema))
    index, state, linked, stats = run(4, late, more, index, state, links=links)
    assert stats == COUNTERS | {"records_seen": 2, "sc_judgment_pdf_ingested": 1, "gdrive_uploaded": 1, "unchanged": 1}
    assert index.count() == 6 and linked.where("judgment_gdrive_view_url = 'http://h/s1'").count() == 1
    *_, stats = run(5, linked, more, index, state, links=links)
    assert stats == COUNTERS | {"records_seen": 2, "unchanged": 2}
    gone = records.withColumn("judgment_pdf_sha256", F.lit(None).cast("string"))
    assert run(6, gone, more, index, state)[0].count() == 6 and run(7, gone, more, index, state, tombstones=True)[0].count() == 2


def test_stream_equals_batch_and_replays(spark, tmp_path):
    from corpusloom.operators.upsert import snapshot

    feed = spark.range(200).select((F.col("id") % 17).cast("string").alias("k"), F.col("id").alias("seq"), F.timestamp_seconds("id").alias("at"), (F.col("id") % 5).cast("string").alias("h"), F.when(F.col("id") % 3 == 0, F.col("id").cast("string")).alias("p"))
    feed.where("seq < 100").coalesce(1).write.parquet(str(tmp_path / "in"))
    whole = snapshot(feed, "k", "seq", "at", "h", ["h"], ["p"])
    store = KeyedStore(spark, f"file://{tmp_path}/out", whole.schema, "k")

    def run():
        upsert_stream(spark.readStream.schema(feed.schema).parquet(str(tmp_path / "in")), store, str(tmp_path / "ck"), "k", "seq", "at", "h", ["h"], ["p"])

    run()
    feed.where("seq >= 100").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    run()
    assert sorted(map(tuple, store.read().collect())) == sorted(map(tuple, whole.collect()))
    run()
    assert store._version(None)["name"] == "batch-1"


def test_embedder_publisher_extractor(spark):
    v = embedding.HashedWords(16).embed(["a b", "A  b", ""])
    assert (v[0] == v[1]).all() and v[2].sum() == 0
    files_ = spark.createDataFrame([("s1", "x"), ("s1", "y"), ("s2", "z")], "sha256 string, name string")
    cache = spark.createDataFrame([("s2", "f", "old", "z")], "sha256 string, file_id string, view_url string, name string")
    got = {r.sha256: r.view_url for r in embedding.published(files_, cache, "http://h/").collect()}
    assert got == {"s1": "http://h/s1", "s2": "old"}

    class Extractor:
        def pages(self, content):
            if content == b"bad":
                raise ValueError("broken")
            return ["p1", "p2"]

    rows = spark.createDataFrame([("a", b"ok"), ("b", b"bad")], "path string, content binary")
    assert sorted((r.path, r.page, r.error) for r in embedding.extracted(rows, Extractor()).collect()) == [("a", 1, None), ("a", 2, None), ("b", 0, "ValueError: broken")]


def test_settings(monkeypatch):
    monkeypatch.setenv("CORPUSLOOM_CHUNK_WORDS", "100")
    s = Settings.from_env()
    assert s.chunk_words == 100 and s.overlap_words == 60 and 2026 in s.years


def test_a_serial_that_no_int_holds(spark):
    cells = "<td>99999999999</td>" + "<td>x</td>" * 8
    rows = html.listing_records(spark.createDataFrame([(2020, f"<table id=employee_list><tr>{cells}</tr></table>")], "year int, html string")).collect()
    assert [(r.id, r.serial_no) for r in rows] == [("REC_2020_99999999999", None)]


class Body:
    """A response whose body may break off."""

    def __init__(self, *blocks):
        self.blocks = list(blocks)

    def read(self, n=None):
        block = self.blocks.pop(0) if self.blocks else b""
        if isinstance(block, Exception):
            raise block
        return block

    def close(self):
        pass

    __enter__ = lambda self: self
    __exit__ = lambda self, *_: None


class Site:
    """Answers by URL, in order; robots.txt is empty. Keeps when it was asked for what."""

    def __init__(self, answers):
        self.answers, self.asked, self.now = answers, [], 0.0

    def open(self, request, timeout):
        url = request if isinstance(request, str) else request.full_url
        if url.endswith("robots.txt"):
            return Body(b"")
        self.asked.append((self.now, url))
        got = self.answers[url].pop(0)
        if isinstance(got, Exception):
            raise got
        return got

    def sleep(self, s):
        self.now += s

    def client(self, **more):
        return Client("http://h/", opener=self.open, sleep=self.sleep, clock=lambda: self.now, jitter=0.0, **more)


def test_client_spaces_retries_and_gives_up():
    down, gone = urllib.error.HTTPError("u", 503, "", {}, None), urllib.error.HTTPError("u", 404, "", {}, None)
    site = Site({"http://h/a": [down, Body(b"x")], "http://h/b": [gone, Body(b"never")], "http://h/c": [down] * 2, "http://h/": [Body(b"")]})
    c = site.client(retries=2)
    assert c.warm_up() and c.read("http://h/a") == b"x" and c.read("http://h/b") is None and c.read("http://h/c", {"y": 1}) is None
    times = [t for t, _ in site.asked]
    assert len(times) == 6 and all(b - a >= 3.0 for a, b in zip(times, times[1:]))


def test_downloads_are_whole_or_not_there(tmp_path):
    pdf = b"junk %PDF-1.4 body"
    site = Site({"http://h/1": [Body(pdf[:9], OSError("reset")), Body(pdf[:9], pdf[9:])], "http://h/2": [Body(b"<html>")], "http://h/3": [Body(OSError("reset")) for _ in range(4)], "http://h/4": []})
    c = site.client()
    path = lambda k: str(tmp_path / "d" / f"{k}.pdf")
    sha = hashlib.sha256(pdf).hexdigest()
    assert downloads.download(c, "http://h/1", path(1), site.sleep) == (sha, None) and (tmp_path / "d" / "1.pdf").read_bytes() == pdf
    assert downloads.download(c, "http://h/2", path(2), site.sleep) == (None, "not a PDF")
    assert downloads.download(c, "http://h/3", path(3), site.sleep) == (None, "OSError: reset")
    assert downloads.download(c, "http://h/1", path(1), site.sleep) == (sha, None)  # not asked again: it has no more answers
    (tmp_path / "d" / "4.pdf").write_bytes(b"")
    site.answers["http://h/4"] = [Body(pdf)]
    assert downloads.download(c, "http://h/4", path(4), site.sleep) == (sha, None)
    assert sorted(p.name for p in (tmp_path / "d").iterdir()) == ["1.pdf", "4.pdf"]


def stub_client(url):
    return Site({f"http://h/{n}.pdf": [Body(b"%PDF- " + n.encode())] for n in "ab"} | {"http://g/x.pdf": [Body(b"no")]}).client()


def test_documents_of_a_listing(spark, tmp_path):
    records, _ = records_and_texts(spark)
    owned = records.where("id = 'B'").withColumn("judgment_local_pdf_path", F.lit("judgments/a.pdf"))
    rows = records.where("id = 'A'").withColumns({"judgment_pdf_url": F.lit("http://h/a.pdf"), "sc_judgment_pdf_url": F.lit("http://g/x.pdf")})
    wanted = scrape.wanted_documents(rows, owned)
    assert {(r.kind, r.path) for r in wanted.collect()} == {("judgment_pdf", "judgments/A__a.pdf"), ("sc_judgment_pdf", "sc_judgments/x.pdf")}
    got = downloads.downloaded(wanted, str(tmp_path), stub_client, pause=0).collect()
    sha = hashlib.sha256(b"%PDF- a").hexdigest()
    assert {tuple(r) for r in got} == {("A", "judgment_pdf", "judgments/A__a.pdf", sha, None), ("A", "sc_judgment_pdf", None, None, "not a PDF")}
    assert (tmp_path / "judgments" / "A__a.pdf").exists() and not (tmp_path / "sc_judgments" / "x.pdf").exists()


def test_scrape_commits_year_by_year(spark, tmp_path):
    store = KeyedStore(spark, f"file://{tmp_path}/records", RECORD, "id")
    page = lambda html: spark.createDataFrame([(2025, html)], "year int, html string")
    fetch = lambda wanted: wanted.select("record_id", "kind", "path", F.when(F.col("path").contains("foo"), "sha").alias("sha256"), F.lit(None).cast("string").alias("error"))
    one = scrape.scrape_year(page(ONE), 2025, store, F.lit(dt.datetime(2025, 1, 1)), fetch=fetch)
    assert (one["parsed"], one["inserted"], one["pdf_ok"], one["pdf_failed"], one["sc_pdf_failed"], one["failed"]) == (2, 2, 1, 1, 1, False)
    again = scrape.scrape_year(page(ONE.replace("Vs B", "Vs C")), 2025, store, F.lit(dt.datetime(2025, 1, 2)))
    assert (again["updated"], again["unchanged"]) == (1, 1)
    r = store.read().where("id = 'REC_2025_1'").head()
    assert (r.judgment_local_pdf_path, r.judgment_pdf_sha256, r.case_info) == ("judgments/foo.pdf", "sha", "W.P 1 A Vs C")
    assert scrape.scrape_year(page(None), 2025, store, F.lit(dt.datetime(2025, 1, 3)))["failed"] and store.read().count() == 2


def test_files_written_and_published(spark, tmp_path):
    texts = spark.createDataFrame([("A", "judgment_pdf", "t\u00e9xt"), ("B", "judgment_pdf", None)], "record_id string, kind string, text string")
    assert downloads.write_texts(texts, str(tmp_path)).count() == 1 and (tmp_path / "judgment_pdf" / "A.md").read_text() == "t\u00e9xt"
    copies = spark.createDataFrame([("s", b"x"), ("s", b"x"), ("t", b"y")], "sha256 string, content binary")
    assert downloads.publish_copies(copies, str(tmp_path / "pub")).count() == 2 and (tmp_path / "pub" / "t").read_bytes() == b"y"
    assert {(r.record_id, r.kind) for r in files.text_listing(spark, str(tmp_path / "judgment_pdf")).collect()} == {("A", "judgment_pdf")}


def test_broken_store_is_set_aside(spark, tmp_path):
    for k, bad in enumerate(("{not valid json", '{"id": "a"}', "", "[{]")):
        path = tmp_path / f"r{k}.json"
        path.write_text(bad)
        assert files.read_records_or_quarantine(spark, str(path), RECORD).count() == 0
        assert not path.exists() and len(list(tmp_path.glob(f"r{k}.json.corrupt-*"))) == 1
    assert files.read_records_or_quarantine(spark, str(tmp_path / "none.json"), RECORD).count() == 0
    (tmp_path / "ok.json").write_text('[{"id": "a"}]')
    assert files.read_records_or_quarantine(spark, str(tmp_path / "ok.json"), RECORD).count() == 1


def test_log_goes_to_file_and_console(tmp_path, capsys):
    logger = setup_logging(str(tmp_path), "corpusloom-test")
    assert setup_logging(str(tmp_path), "corpusloom-test") is logger and len(logger.handlers) == 2
    logger.info("hello")
    assert "hello" in (tmp_path / "corpusloom-test.log").read_text()


def test_daily_schedule():
    at = lambda d, h, m=0: dt.datetime(2025, 1, d, h, m, tzinfo=dt.timezone.utc)
    assert schedule.is_due(at(2, 2, 5), at(1, 2), 2, 0) and not schedule.is_due(at(2, 2, 5), at(2, 2), 2, 0)
    assert not schedule.is_due(at(2, 3, 1), at(1, 2), 2, 0)  # beyond the grace: the next day
    assert schedule.is_due(at(9, 2, 59), at(1, 2), 2, 0)  # several missed slots are one run
    clock, ran = [at(1, 1)], []

    def job():
        ran.append(clock[0])
        raise RuntimeError("logged, not raised")

    def sleep(s):
        clock[0] += dt.timedelta(seconds=s)

    assert schedule.run_daily(job, 2, 0, lambda: clock[0], sleep, rounds=50, check_s=3600) == 3 and [t.hour for t in ran] == [2, 2, 2]


class Recognizer:
    def text(self, content, page):
        if content == b"bad":
            raise ValueError("unreadable")
        return f"{content.decode()} {page}"


def test_only_blank_pages_are_recognised(spark):
    pages = spark.createDataFrame([("a", 1, "own"), ("a", 2, "  "), ("b", 1, None), ("c", 0, None)], "path string, page int, text string")
    sources = spark.createDataFrame([("a", b"scan"), ("b", b"bad"), ("c", b"scan")], "path string, content binary")
    got = embedding.with_ocr(pages, sources, Recognizer())
    assert {(r.path, r.page): r.ocr_text for r in got.collect()} == {("a", 1): None, ("a", 2): "scan 2", ("b", 1): None, ("c", 0): None}
    texts = {r.path: (r.text, r.any_ocr) for r in files.page_texts(got, "path", "page", F.col("text"), F.col("ocr_text")).collect()}
    assert texts["a"] == ("own\n\nscan 2", True) and texts["b"] == ("", False)


def test_plain_markup_is_not_parsed_sign_by_sign(monkeypatch):
    """And gives what the parser gives, whatever the markup."""
    import random

    r, fed = random.Random(3), []
    parts = ["<table id=t>", '<TABLE ID="t">', "<tr>", "<td>", "<td> ", "</td>", " a  b ", "<a href=x.pdf>", '<a href=" /y " HREF="z">', "</a>", "<b>", "</ b>", "<td/>", "</table>", "<!-- c -->", "&amp;", "<script>", "</script>", "<a href>", "<", ">", "<td class='q'>", "</tr >", "é\n"]
    feed = html._Listing.feed
    for i in range(4_000):
        page = "<table id=t>" * (i % 2) + "".join(r.choice(parts[:12] if i % 3 else parts) for _ in range(r.randint(0, 60)))
        a, b = html._Listing("t"), html._Listing("t")
        html._fed(a, page)
        b.feed(page)
        b.close()
        assert (a.rows, a.text, a.depth) == (b.rows, b.text, b.depth), page
    monkeypatch.setattr(html._Listing, "feed", lambda self, x: fed.append(x) or feed(self, x))
    row = "<tr>" + "<td> x </td>" * 8 + '<td><a href="k.pdf">PDF</a></td></tr>'
    assert html.listing_cells(f"<table id=t>{row}</table>", "t")[0][8] == "k.pdf" and not fed


def test_pages_are_handed_on_in_small_batches(spark):
    """Neither a batch of files nor their pages add up to tens of megabytes in a worker."""

    class Pages:
        def pages(self, content):
            with open("/proc/self/statm") as f:
                return [f.read().split()[1], *content.decode().split("|")]

    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(256 << 20))
    try:
        files = spark.range(0, 600, 1, 1).select(F.col("id").cast("string").alias("path"), F.repeat(F.lit("x" * 99 + "|"), 1_000).cast("binary").alias("content"))
        got = embedding.extracted(files, Pages())
        assert int(spark.conf.get(key)) <= 4 << 20
        pages = got.cache()
        assert pages.count() == 600 * 1_002
        resident = [int(r.text) >> 8 for r in pages.where("page = 1").select("text").collect()]  # MB
        assert max(resident) - min(resident) < 100
    finally:
        spark.conf.set(key, before)


def test_many_small_files_are_few_tasks(spark, tmp_path):
    from corpusloom.sources import scratch

    for i in range(400):
        (tmp_path / f"{i}.md").write_text(f"text {i}")
    read = lambda: files.whole_texts(spark, str(tmp_path)).rdd.getNumPartitions()
    before = read()
    with scratch.many_files(spark):
        assert read() <= 2 * spark.sparkContext.defaultParallelism < before
    assert read() == before

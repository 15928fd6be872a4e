import hashlib
import random
import uuid
from urllib.parse import urljoin

from pyspark.sql import functions as F

from corpusloom.functions import hashing, text, vectors


def column(spark, values, c, kind="string"):
    df = spark.createDataFrame(list(enumerate(values)), f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(c(F.col("v"))).collect()]


def test_dates(spark):
    raw = ["24/12/2025", "Judgment awaited", "", None, "4-1-2025", "2025-01-04", " 04.01.2025 ", "31/02/2025", "2024 term", "AWAITED"]
    assert column(spark, raw, text.normalized_date) == ["2025-12-24", None, None, None, "2025-01-04", "2025-01-04", "2025-01-04", "31/02/2025", "2024 term", None]
    assert [None if d is None else d.isoformat() for d in column(spark, raw, text.typed_date)][6:9] == ["2025-01-04", None, None]


def test_total_hint(spark):
    raw = ["Showing 1 to 10 of 1,234 entries", "OF 7 ENTRIES", "no total", None, "of , entries"]
    assert column(spark, raw, text.total_hint) == [1234, 7, None, None, None]


def test_safe_filename(spark):
    urls = ["http://x/y/foo", "http://x/foo.pdf", "http://x/W.P%20No:1?.pdf", "http://x/", "http://x/a+b%2Fc.PDF?q=1#f", "http://x/50%.pdf", "http://x/" + "a" * 300]
    got = column(spark, urls, text.safe_filename)
    assert got[:6] == ["foo.pdf", "foo.pdf", "W.P No_1.pdf", "unnamed.pdf", "a+b_c.PDF", "50%.pdf"]
    assert got[6] == "a" * 200 + ".pdf"


def test_resolved_url(spark):
    base = "https://h.example/app/"
    hrefs = ["https://a/b.pdf", "/app//x.pdf", "x.pdf", "../y.pdf", "//h2/z", "?q=1", " s.pdf "]
    assert column(spark, hrefs, lambda c: text.resolved_url(F.lit(base), c)) == [urljoin(base, h.strip()) for h in hrefs]


def test_unicode_words(spark):
    raw = ["a\u00a0b\u2003c\x1cd\x85e", "", "  ", "x"]
    assert column(spark, raw, text.words) == [t.split() for t in raw]


def test_snippet_and_basename(spark):
    assert column(spark, ["x" * 280, "x" * 281], text.snippet) == ["x" * 280, "x" * 280 + "..."]
    assert column(spark, ["C:\\a\\b.pdf", "/a/c.pdf", "d"], text.basename) == ["b.pdf", "c.pdf", "d"]


def test_magic(spark):
    assert column(spark, [b"%PDF-1.4\n", b"<html>", b"", None, b"x" * 1000 + b"%PDF-", b"x" * 1024 + b"%PDF-"], text.looks_like_pdf, "binary") == [True, False, False, False, True, False]


def test_content_hash_renders_null(spark):
    row = spark.createDataFrame([("a", None, "")], "x string, y string, z string").select(hashing.content_hash(F.col("x"), F.col("y"), F.col("z"))).head()[0]
    assert row == hashlib.sha256(b"a|None|").hexdigest()


def test_uuid5(spark):
    names = ["REC_2025_1::metadata", "", "é"]
    assert column(spark, names, hashing.uuid5) == [str(uuid.uuid5(uuid.NAMESPACE_DNS, n)) for n in names]


def test_card(spark):
    c = text.metadata_card(*(F.lit(x) for x in (None, None, "", "2025-01-01", "n", None, "Upheld", "r")))
    assert spark.range(1).select(c).head()[0].split("\n")[:4] == ["Case: Unknown", "Year: None", "Category: Unspecified", "Decision date: 2025-01-01"]


def test_vectors(spark):
    df = spark.createDataFrame([([3.0, 4.0], [4.0, 3.0]), ([0.0, 0.0], [1.0, 0.0])], "a array<float>, b array<float>")
    rows = df.select(vectors.l2_normalized(F.col("a")), vectors.cosine(F.col("a"), F.col("b"))).collect()
    assert [round(x, 6) for x in rows[0][0]] == [0.6, 0.8] and abs(rows[0][1] - 0.96) < 1e-12
    assert rows[1][0] == [0.0, 0.0] and rows[1][1] is None


def test_references_resolve_like_the_library(spark):
    """Random bases and references, with dot segments, parameters, empty parts, odd schemes and white space; and no Python in the plan."""
    r = random.Random(7)
    pick = lambda *xs: r.choice(xs)
    path = lambda: "/".join(pick("a", "b.c", "..", ".", "", "...", "x;y", ";", "\u00e9", "%2F", "..;p", "a:b") for _ in range(r.randint(0, 6)))
    tail = lambda: pick("", "?", "?q=1", "?a/../b", "?;x") + pick("", "#", "#f", "#f?g")
    base = lambda: pick("http://", "https://", "HTTP://", "ftp://", "file://", "//", "", "mailto:", "ws://", "x-y:") + pick("h.example", "H.example:80", "", "u@h") + pick("", "/") + path() + tail()
    ref = lambda: pick("", "", "", "/", "//h2/", "//", "http://o/", "http:", "https://o", "mailto:", "?", "#", "./", "../", " ", " \t", "javascript:") + path() + tail()
    rows = [(base(), ref()) for _ in range(4000)] + [("http://h/a", None), (None, "b")]
    df = spark.createDataFrame(rows, "b string, h string").select("b", "h", text.resolved_url(F.col("b"), F.col("h")).alias("u"))
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString()
    assert [x.u for x in df.collect()] == [None if b is None or h is None else urljoin(b, h.strip()) for b, h in rows]
